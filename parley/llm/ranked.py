"""Ranked lexical search the other way round: documents stream through an index of the items that ask for them."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.bpe import slices
from parley.llm.common import ranges, small_batches, stored, text_of, utf8_batch

#: Documents listed for an item.
TOP = 10
#: Bytes of item text whose index is sent to every task; further items make further blocks.
INDEX_BYTES = 16 << 20
#: Bytes of one text whose terms are in memory at a time, and scores and postings that a task holds at a time.
WINDOW, CELLS = 4 << 20, 2_000_000
#: Parts in which the heaps of an item are merged before they are merged as one.
SALTS = 64
LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
#: In lower-cased UTF-8: digits, letters and all bytes of characters beyond ASCII.
TERM, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a text in UTF-8; only A-Z are lower-cased."""
    low, found, at = text.translate(LOWER), Counter(), 0
    while at < len(low):
        gap = GAP.search(low, at + WINDOW)
        end = gap.start() if gap else len(low)
        found.update(TERM.findall(low, at, end))
        at = end
    return found


def texts_in(column: pa.Array) -> list[bytes]:
    data, at = utf8_batch(column)
    raw, at = data.tobytes(), at.tolist()
    return [raw[lo:hi] for lo, hi in zip(at, at[1:])]


@dataclass
class Index:
    """Terms of a block of items: `number` of each term, and for each number the items that hold it and how often."""

    number: dict[bytes, int]
    begin: np.ndarray
    item: np.ndarray
    times: np.ndarray
    items: int

    @classmethod
    def of(cls, texts: list[bytes]) -> Index:
        number: dict[bytes, int] = {}
        found = [(number.setdefault(term, len(number)), i, n) for i, text in enumerate(texts) for term, n in term_counts(text).items()]
        told = np.array(sorted(found), np.int64).reshape(-1, 3)
        return cls(number, np.searchsorted(told[:, 0], np.arange(len(number) + 1)), told[:, 1], told[:, 2], len(texts))


def _matched(docs: DataFrame, index) -> DataFrame:
    """For every document `id`, its terms `n`, and the `terms` of the index in it with their occurrences `tf`."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number
        for big in batches:
            for batch in slices(big, "text"):
                sizes, terms, tfs = [], [], []
                for text in texts_in(batch.column("text")):
                    counts = term_counts(text)
                    own = [(number[t], n) for t, n in counts.items() if t in number]
                    sizes.append(sum(counts.values()))
                    terms.append([t for t, _ in own])
                    tfs.append([n for _, n in own])
                yield pa.record_batch([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                                      ["id", "n", "terms", "tf"])

    return docs.mapInArrow(match, f"id {docs.schema['id'].dataType.simpleString()}, n long, terms array<int>, tf array<long>")


class Heaps:
    """The best documents of each item so far: (score, has an id, minus the id), the worst of them first."""

    def __init__(self, index: Index, weight: np.ndarray, docs: int, length: int, top: int) -> None:
        self.index, self.weight, self.docs, self.length, self.top = index, weight, docs, max(length, 1), top
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(index.items)]
        self.least = np.ones(index.items, np.int64)

    def read(self, ids: list[int | None], sizes: list[int], begin: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> None:
        """Score some documents; document d has the terms begin[d] to begin[d + 1]."""
        index = self.index
        m = np.array([25 + 75 * n * self.docs // self.length for n in sizes], np.int64)
        doc = np.repeat(np.arange(len(ids)), np.diff(begin))
        worth = self.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        postings = index.begin[terms + 1] - index.begin[terms]
        at = ranges(index.begin[terms], postings)
        scores = np.zeros((len(ids), index.items), np.int64)
        np.add.at(scores.reshape(-1), np.repeat(doc * index.items, postings) + index.item[at], np.repeat(worth, postings) * index.times[at])
        for d, i in zip(*(x.tolist() for x in np.nonzero(scores >= self.least))):
            heap, entry = self.heaps[i], (int(scores[d, i]), ids[d] is not None, -(ids[d] or 0))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


def _scored(matched: DataFrame, index, weight, docs: int, length: int, top: int) -> DataFrame:
    """The best documents of each item in each task: `no`, `id`, `score`."""
    kind = matched.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.value, weight.value, docs, length, top)
        most = max(1, CELLS // max(index.value.items, 1))
        for batch in batches:
            ids, sizes, lists = batch.column("id").to_pylist(), batch.column("n").to_pylist(), batch.column("terms")
            begin = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            terms, tf = lists.flatten().to_numpy().astype(np.int64), batch.column("tf").flatten().to_numpy()
            work = np.concatenate([[0], np.cumsum(np.diff(index.value.begin)[terms])])[begin]
            lo = 0
            while lo < len(ids):
                hi = min(lo + most, max(lo + 1, int(np.searchsorted(work, work[lo] + CELLS, side="right")) - 1))
                heaps.read(ids[lo:hi], sizes[lo:hi], begin[lo:hi + 1] - begin[lo], terms[begin[lo]:begin[hi]], tf[begin[lo]:begin[hi]])
                lo = hi
        found = [(i, -minus if has else None, score) for i, heap in enumerate(heaps.heaps) for score, has, minus in heap]
        columns = list(zip(*found)) or [[], [], []]
        yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], batch_id), pa.array(columns[2], pa.int64())], ["no", "id", "score"])

    batch_id = pa.int32() if kind == "int" else pa.int64()
    return matched.mapInArrow(run, f"no long, id {kind}, score long")


def search(items: DataFrame, docs: DataFrame, top: int = TOP, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The `top` best documents of every item, those with a score above 0: item id, `rank`, id, `score`.

    The search is reversed: the items' terms form an inverted index, which is broadcast; every document's term counts
    stream through it once, and each task keeps a bounded heap for every item. The heaps are merged in two steps. Items
    of more than `INDEX_BYTES` of text are searched in blocks, each of them against all documents. The weight of a
    term and the scores are whole numbers: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 25 + (75 n N) div L, score =
    sum of w ((1e9 tf) div (1000 tf + 8 m)) over the item's terms with repeats.

    Equal scores rank by ascending id, null ids last. Null texts have no terms, as have empty ones: such items get no
    rows, such documents are in none, and N counts only documents with a term. Repeated rows of documents are
    documents of their own, repeated items are ranked each by itself. Ids of documents are whole numbers; a very long text is read in
    windows that end between terms. Empty tables give an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    asked = stored(items.select(F.col(item_col).alias("item"), text_of("text").alias("text"), F.monotonically_increasing_id().alias("row")), "items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first().n
    blocks = -(-size // INDEX_BYTES)
    found = None
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        index = Index.of(texts_in(held.column("text")))
        sent = spark.sparkContext.broadcast(index)
        matched = stored(_matched(rows, sent), "matched")
        told = matched.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        df = np.zeros(len(index.number), np.int64)
        counted = matched.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # a row for each term of the index
        df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * told.docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        names = spark.createDataFrame(pa.table({"no": pa.array(range(index.items), pa.int64()), "item": held.column("item")}),
                                      f"no long, item {asked.schema['item'].dataType.simpleString()}")
        best = _scored(matched, sent, spark.sparkContext.broadcast(weight), told.docs, told.length, top)
        best = best.withColumn("salt", F.spark_partition_id() % SALTS)
        for keys in (["no", "salt"], ["no"]):
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
            best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        best = best.join(F.broadcast(names), "no").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = asked.join(rows.limit(0), F.lit(False)).select(F.col("item").alias(item_col), F.lit(0).alias("rank"), F.col("id").alias(id_col), F.lit(0).cast("long").alias("score"))
    return found
