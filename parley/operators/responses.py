"""Prompts for a language model and the answers it returns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley import schemas

SCORE_RANGE = (1, 10)


def render_prompts(calls: DataFrame, templates: Mapping[str, str], text: str = "text") -> DataFrame:
    """Each call with each template, `{}` replaced by the call's text. Templates travel in the plan."""
    entries = [F.struct(F.lit(name).alias("name"), F.lit(body).alias("body")) for name, body in templates.items()]
    rows = calls.withColumn("_template", F.explode(F.array(*entries)))
    prompt = F.replace(F.col("_template.body"), F.lit("{}"), F.col(text))
    return rows.withColumns({"template": F.col("_template.name"), "prompt": prompt}).drop("_template", text)


def parse_satisfaction(df: DataFrame, response: str = "response") -> DataFrame:
    """Score and reason of a JSON-like answer; `valid` tells a usable score from one to set aside.

    Answers that are no JSON are searched for the two fields.
    """
    parsed = F.from_json(F.col(response), schemas.SATISFACTION, {"mode": "PERMISSIVE"})
    score_text = F.regexp_extract(response, r"(?i)[\"']?score[\"']?\s*[:=]\s*[\"']?(-?\d+)", 1)
    reason_text = F.regexp_extract(response, r"(?i)[\"']?reason[\"']?\s*[:=]\s*[\"']([^\"']*)[\"']", 1)
    df = df.withColumn("_parsed", parsed)
    score = F.coalesce(F.col("_parsed.Score"), F.nullif(score_text, F.lit(""))).try_cast("int")
    df = df.withColumns({"score": score, "reason": F.coalesce("_parsed.Reason", F.nullif(reason_text, F.lit("")))})
    return df.withColumn("valid", F.coalesce(F.col("score").between(*SCORE_RANGE), F.lit(False))).drop("_parsed")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and the rest."""
    return df.filter("valid"), df.filter("not valid")
