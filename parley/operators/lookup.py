"""Joins of a large table with a reference table of unknown size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A reference table is broadcast only if it is proven to stay below this many rows and bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 64


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measures at most `max_rows` + 1 rows, each by its length as text; only the lengths are gathered."""
    lengths = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("bytes")).limit(max_rows + 1)
    found = lengths.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def lookup(rows: DataFrame, reference: DataFrame, key: str, spread: Column, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """Join `reference` to `rows` on `key`.

    A proven-small reference is broadcast, so the rows stay where they are. A larger one is
    joined by shuffle, with each reference row copied to `salts` salts and each row sent to
    the salt picked by `spread`, so that one frequent key is shared by many tasks.
    """
    if is_small(reference, max_rows):
        return rows.join(F.broadcast(reference), key, how)
    salted = reference.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return rows.join(salted, [key, "_salt"], how).drop("_salt")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null: a null key meets a null key. The keys of `left` stay."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    met = left.join(right, reduce(and_, (left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys)), how)
    return met.drop(*(f"_r_{k}" for k in keys))
