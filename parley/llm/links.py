"""URL filter: rules, and trust and distrust that spread over links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bounded, stored

ALLOW, BLOCK = "allow", "block"
#: Share of a host's weight that follows its links; the rest starts at the seeds again.
DAMPING = 0.85
#: Rounds between two looks at the change, the change (per page) that ends them, and the most rounds.
STEP, SETTLED, ROUNDS = 5, 1e-6, 60
#: A host is blocked if its distrust exceeds its trust by more than so much for each of its pages.
THRESHOLD = 0.5
#: Hosts that a page links to, in `href` attributes with a host of their own.
HREF = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/"'?#\s>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: of its host or a subdomain, with a path that starts like the rule's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def spread(hosts: DataFrame, links: DataFrame) -> DataFrame:
    """Trust and distrust of hosts: `host`, `pages`, `trust`, `distrust`.

    hosts: `host`, `pages`, `allowed`, `blocked` (pages); links: `source`, `target`, `n`. Trust starts at allowed
    pages and follows links forward: a personalised PageRank. Distrust starts at blocked pages and follows links
    back, to those who link there. Weight at a host without a way on stays there, so a host without links keeps what
    it starts with. Both run as one table over one join a round; only hosts with weight are in it.
    """
    seeds = stored(hosts.select("host", F.explode(F.create_map(F.lit("trust"), F.col("allowed"), F.lit("distrust"), F.col("blocked"))).alias("kind", "seed"))
                   .where("seed > 0").withColumn("seed", F.col("seed").cast("double")), "seeds")
    ways = (links.select(F.lit("trust").alias("kind"), F.col("source").alias("start"), F.col("target").alias("stop"), "n")
            .unionByName(links.select(F.lit("distrust").alias("kind"), F.col("target").alias("start"), F.col("source").alias("stop"), "n")))
    total = ways.groupBy("kind", "start").agg(F.sum("n").alias("all"))
    ways = stored(ways.join(total, ["kind", "start"]).select("kind", "start", "stop", (F.col("n") / F.col("all")).alias("share")), "ways")
    weight = seeds.withColumnRenamed("seed", "weight")
    for _ in range(0, ROUNDS, STEP):
        before = weight
        for _ in range(STEP):
            moved = (weight.withColumnRenamed("host", "start").join(ways, ["kind", "start"], "left")
                     .select("kind", F.coalesce("stop", "start").alias("host"), (F.col("weight") * F.coalesce("share", F.lit(1.0)) * DAMPING).alias("weight")))
            weight = (moved.unionByName(seeds.select("kind", "host", (F.col("seed") * (1 - DAMPING)).alias("weight")))
                      .groupBy("kind", "host").agg(F.sum("weight").alias("weight")))
        weight = stored(weight, "weight")
        apart = weight.unionByName(before.select("kind", "host", (-F.col("weight")).alias("weight")))
        change = apart.groupBy("kind", "host").agg(F.abs(F.sum("weight")).alias("by")).agg(F.sum("by")).first()[0]
        if (change or 0.0) <= SETTLED * max(1.0, seeds.agg(F.sum("seed")).first()[0] or 0.0):
            break
    wide = weight.groupBy("host").agg(*(F.sum(F.when(F.col("kind") == kind, F.col("weight"))).alias(kind) for kind in ("trust", "distrust")))
    return hosts.join(wide, "host", "left").select("host", "pages", *(F.coalesce(kind, F.lit(0.0)).alias(kind) for kind in ("trust", "distrust")))


def judge(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: id, `host`, `path`, `rule`, `verdict`, and the `trust` and `distrust` of its host per page.

    `rules` maps `host/path` to allow or block. A page that no rule fits takes the verdict of its host: block if
    distrust less trust, spread over the links in all pages, exceeds `THRESHOLD` a page, else allow. Links from a
    host to itself and links without a host count for nothing. The hosts' verdicts are broadcast if they are few,
    else joined.

    Null urls, and those without `://`, have an empty host and path, fit no rule and start or receive nothing; null
    pages have no links; repeated rows are judged alike and count as often as they occur; an empty table gives an
    empty result; further columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    chosen = [r for r, verdict in rules.items() if verdict == BLOCK]
    blocked = F.coalesce(F.col("rule").isin(chosen), F.lit(False))
    rows = rows.withColumn("ruled", F.when(F.col("rule").isNotNull(), F.when(blocked, F.lit(BLOCK)).otherwise(F.lit(ALLOW))))
    hosts = stored(rows.groupBy("host").agg(F.count("*").alias("pages"), F.count(F.when(F.col("ruled") == ALLOW, 1)).alias("allowed"),
                                            F.count(F.when(F.col("ruled") == BLOCK, 1)).alias("blocked")), "hosts")
    named = rows.where("host != ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("to"))
    links = stored(named.select(F.col("host").alias("source"), lower_ascii(F.col("to")).alias("target")).where("source != target")
                   .groupBy("source", "target").agg(F.count("*").alias("n")), "links")
    told = stored(spread(hosts.where("host != ''"), links), "told")
    scored = told.select("host", (F.col("trust") / F.col("pages")).alias("trust"), (F.col("distrust") / F.col("pages")).alias("distrust"))
    beyond = F.coalesce(F.col("distrust") - F.col("trust") > THRESHOLD, F.lit(False))
    verdict = F.coalesce("ruled", F.when(beyond, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return rows.drop("html").join(bounded(scored), "host", "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"),
        *(F.coalesce(kind, F.lit(0.0)).alias(kind) for kind in ("trust", "distrust")))
