"""WARC archives: written record by record, read in splits, and verified from the start of each file."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.llm.common import bounded, stored

MAGIC = "WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
#: Smaller payloads are always written in full.
LEAST_REVISIT = 1000
#: Fields of a record's header that the reader returns.
FIELDS = {"WARC-Type": "record_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to",
          "WARC-Payload-Digest": "digest", "X-Payload-Length": "payload_length", "WARC-Target-URI": "url"}
CHUNK = ("file string, block long, nth long, size long, head long, content long, payload_sha1 string, "
         + ", ".join(f"{name} string" for name in FIELDS.values()))
CHUNK_NAMES = [part.split()[0] for part in CHUNK.split(", ")]


def _field(name: str, value: Column) -> Column:
    """A header line, left out where the value is null; line ends in the value become blanks."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "), F.lit("\r\n")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write a record per row below `path`.

    Of rows with equal payloads of at least `LEAST_REVISIT` bytes the one with the largest id is a response, the
    others refer to it and carry no payload. Equality is that of SHA-1 and length. Null payloads count as empty, a
    null url is left out. Rows with a null id, and rows that repeat the largest id of their payload, are written as
    responses; further columns are ignored. Each record ends with two line ends, which Spark's text writer adds.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(payload_col, F.lit("")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    large = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("sha1", "size")
    again = stored(large.agg(F.count("*").alias("n"), F.max("id").alias("keep")).where("n > 1").drop("n"), "again")
    rows = rows.join(bounded(again), ["sha1", "size"], "left")
    revisit = F.coalesce((F.col("size") >= LEAST_REVISIT) & (F.col("id") < F.col("keep")), F.lit(False))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC), _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
        _field("WARC-Target-URI", F.col("url")), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("keep").cast("string"), F.lit(">")))),
        _field("X-Payload-Length", F.col("size").cast("string")),
        _field("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body)
    rows.select(record.alias("value")).write.option("lineSep", CLOSE).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic, in splits: what stands between, with its file and split."""
    found = spark.read.option("lineSep", MAGIC).text(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").cast("binary").alias("value"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, memoryview]]:
    """File, split, number in the split, and bytes; a task reads its splits one after the other."""
    at, nth = None, 0
    for batch in batches:
        for file, block, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value")):
            nth = nth + 1 if (file, block) == at else 0
            at = (file, block)
            yield file, block, nth, value.as_buffer()


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the bytes behind each magic say if they are a record: the length of its header and content, its fields."""
    close, length = CLOSE.encode(), re.compile(rb"(?im)^Content-Length: *([0-9]+)\r?$")
    line = re.compile(rb"(?m)^([A-Za-z-]+): *(.*?)\r?$")
    out: list[tuple] = []
    for file, block, nth, value in _numbered(batches):
        held = value.to_pybytes()
        end = held.find(close)
        header = held[:end] if end >= 0 else b""
        told = length.search(header)
        head, content = (end + len(close), int(told[1])) if told else (-1, -1)
        fields = {k.decode("ascii"): v.decode("utf-8", "replace") for k, v in line.findall(header)} if told else {}
        whole = told and head + content <= len(held)
        sha1 = hashlib.sha1(memoryview(held)[head:head + content]).hexdigest() if whole else None
        out.append((file, block, nth, len(held), head, content, sha1, *(fields.get(name) for name in FIELDS)))
        if len(out) == 10_000:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=CHUNK_NAMES), _schema(), preserve_index=False)
            out = []
    if out:
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=CHUNK_NAMES), _schema(), preserve_index=False)


def _schema() -> pa.Schema:
    return pa.schema([(n, pa.int64() if n in ("block", "nth", "size", "head", "content") else pa.string()) for n in CHUNK_NAMES])


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Of each candidate of a split, the first offset outside the split's candidates that its chain leads to."""
    group = group.sort_values("at")
    at, after = group["at"].to_numpy(), group["after"].to_numpy()
    to = np.minimum(np.searchsorted(at, after), len(at) - 1)
    inside = at[to] == after
    jump = np.where(inside, to, np.arange(len(at)))
    for _ in range(len(at).bit_length()):  # pointer jumping: each round doubles the steps
        jump = jump[jump]
    return pd.DataFrame({"file": group["file"], "block": group["block"], "at": at, "exit": after[jump]})


def _reached(key: tuple, group: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that the chains from its entries pass."""
    group = group.sort_values("at")
    at, after = group["at"].to_numpy(), group["after"].to_numpy()
    to = np.minimum(np.searchsorted(at, after), len(at) - 1)
    on = np.isin(at, entries["at"].to_numpy())
    jump = np.where(at[to] == after, to, -1) if len(at) else to
    for _ in range(len(at).bit_length()):
        hit = on & (jump >= 0)
        on[jump[hit]] = True
        jump = np.where(jump >= 0, jump[jump], -1)
    return pd.DataFrame({"file": group["file"][on], "block": group["block"][on], "at": at[on]})


def verified(chunks: DataFrame) -> DataFrame:
    """Offsets of all pieces and which of them are records: `at`, `after`, `record`.

    Every piece that reads as a record points at where the next one must start. Within a split pointer jumping
    finds where each chain leaves it; between the splits of a file, jumping over these few exits from offset 0 finds
    the entries that count; within each split the chains from its entries mark the records. A magic inside a payload
    is passed over, as no chain from the start of the file meets it.
    """
    spark = chunks.sparkSession
    width = len(MAGIC)
    blocks = chunks.groupBy("file", "block").agg(F.sum(F.col("size") + width).alias("span"))
    before = F.sum("span").over(Window.partitionBy("file").orderBy("block")) - F.col("span")
    blocks = blocks.select("file", "block", before.alias("base"))
    inside = F.sum(F.col("size") + width).over(Window.partitionBy("file", "block").orderBy("nth"))
    # A piece starts behind its magic; the first piece of a file stands before any magic and is empty.
    placed = (chunks.withColumn("upto", inside).join(blocks, ["file", "block"])
              .withColumn("at", F.col("base") + F.col("upto") - F.col("size") - 2 * width)
              .withColumn("after", F.when(F.col("head") >= 0, F.col("at") + width + F.col("head") + F.col("content") + len(CLOSE))))
    placed = stored(placed.drop("upto", "base").where("at >= 0"), "placed")
    narrow = placed.where("after is not null").select("file", "block", "at", "after")
    exits = stored(narrow.groupBy("file", "block").applyInPandas(_exits, "file string, block long, at long, exit long"), "exits")
    targets = exits.select("file", F.col("exit").alias("at")).distinct()
    hops = exits.join(targets, ["file", "at"], "left_semi").select("file", F.col("at").alias("from"), F.col("exit").alias("to"))
    hops = stored(hops.union(exits.where("at = 0").select("file", F.col("at").alias("from"), F.col("exit").alias("to"))).distinct(), "hops")
    entries = placed.where("at = 0 and after is not null").select("file", "at").distinct()
    count, grown = -1, entries.count()
    while grown > count:  # the exits reached so far double with each round
        count = grown
        step = entries.join(hops, (entries["file"] == hops["file"]) & (entries["at"] == hops["from"])).select(entries["file"], F.col("to").alias("at"))
        entries = stored(entries.union(step).distinct(), "entries")
        longer = hops.alias("a").join(hops.alias("b"), F.expr("a.file = b.file and a.to = b.from"), "left")
        hops = stored(longer.select("a.file", "a.from", F.coalesce("b.to", "a.to").alias("to")), "hops")
        grown = entries.count()
    records = (narrow.groupBy("file", "block").cogroup(exits.join(entries, ["file", "at"], "left_semi").groupBy("file", "block"))
               .applyInPandas(_reached, "file string, block long, at long"))
    return stored(placed.join(records.withColumn("record", F.lit(True)), ["file", "block", "at"], "left")
                  .withColumn("record", F.coalesce("record", F.lit(False))), "records")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record below `path`: `file`, `at`, `content`, the fields of its header and `payload_sha1` of the content read.

    Records whose payload holds the magic lie in several pieces; these pieces alone are read again and joined.
    An empty folder gives no rows; bytes that no chain from the start of their file reaches are not records.
    """
    chunks = stored(_pieces(spark, path).mapInArrow(_candidates, CHUNK), "chunks")
    pieces = verified(chunks)
    found = pieces.where("record")
    cut = found.where("payload_sha1 is null").select("file", F.col("at").alias("start"), F.col("after").alias("stop"))
    if cut.limit(1).count():
        wanted = stored(pieces.select("file", "block", "nth", "at", "head").join(cut, "file")
                        .where("at >= start and at < stop").select("file", "block", "nth", "at", "start", "stop", "head"), "wanted")

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for file, block, nth, value in _numbered(batches):
                yield pa.record_batch([pa.array([file]), pa.array([block]), pa.array([nth]), pa.array([value.to_pybytes()])], ["file", "block", "nth", "value"])

        def joined(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("at")
            held = MAGIC.encode().join(group["value"])
            first = group.iloc[0]
            size = int(first["stop"] - first["start"] - len(MAGIC) - first["head"] - len(CLOSE))
            body = held[int(first["head"]):int(first["head"]) + size]
            return pd.DataFrame({"file": [first["file"]], "at": [first["start"]], "sha1": [hashlib.sha1(body).hexdigest() if len(body) == size else None]})

        again = _pieces(spark, path).mapInArrow(numbered, "file string, block long, nth long, value binary").join(bounded(wanted), ["file", "block", "nth"])
        sums = again.groupBy("file", "start").applyInPandas(joined, "file string, at long, sha1 string")
        found = found.join(sums, ["file", "at"], "left").withColumn("payload_sha1", F.coalesce("payload_sha1", "sha1")).drop("sha1")
    return found.select("file", "at", "content", "payload_sha1", *FIELDS.values())


def round_trip(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the rows as archives below `path`, read them back, and tell of each record what it says:
    id, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`.

    Of a response, digest and length are those of the payload read, and the job fails if its header tells otherwise.
    """
    write_archives(pages, path, id_col, url_col, payload_col)
    found = read_archives(pages.sparkSession, path)
    kind = pages.schema[id_col].dataType
    told = F.expr("substring(digest, 6)")
    revisit = F.col("record_type") == "revisit"
    number = {name: F.expr(f"nullif(substring({name}, 11, length({name}) - 11), '')").cast(kind) for name in ("record_id", "refers_to")}
    same = (told == F.col("payload_sha1")) & (F.col("payload_length").cast("long") == F.col("content"))
    digest = F.when(revisit | same, told).otherwise(F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id"))))
    return found.select(number["record_id"].alias(id_col), F.when(revisit, F.col("payload_length").cast("long")).otherwise(F.col("content")).alias("payload_bytes"),
                        digest.alias("payload_digest"), "record_type", number["refers_to"].alias("refers_to"))
