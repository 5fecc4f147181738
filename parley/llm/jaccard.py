"""Similarity join of word shingles: chosen paths through shared shingles lead to small buckets that are compared."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from parley.llm.bpe import slices
from parley.llm.classes import classes, components
from parley.llm.common import blank_words, bounded, let_go, mix, run_hashes, small_batches, stored, utf8_batch

#: Words of a shingle, and the similarity of a link.
WORDS, LEAST = 5, 0.8
#: Shingles that a set is expected to choose at each step of a path, and the steps.
CHOICES, LEVELS = 2.0, 2
#: Larger buckets are split by a further shingle; after the last step they are compared in blocks.
LIMIT, BLOCK = 2_000, 1_000
#: Share of linked pairs that meet in a bucket of some run.
RECALL = 0.999
#: Bytes of a sketch, and those that two sketches must share: pairs at LEAST miss it about once in 1500 times.
SKETCH, AGREE = 64, 41
#: Documents of a group whose sets are in a task at a time, twice.
SET_BLOCK = 500


def runs(choices: float = CHOICES, least: float = LEAST, recall: float = RECALL) -> int:
    """Runs until the target recall: two sets at `least` share choices * least branches a step, and the chance q that
    all branches end solves q = exp(-choices * least * (1 - q))."""
    q = 0.0
    for _ in range(200):
        q = math.exp(-choices * least * (1 - q))
    return math.ceil(math.log(1 - recall) / math.log(q))


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each text, one after the other, and where each text starts.

    Words lie between blanks. A text of fewer than WORDS words has one shingle of all of them; without words, none.
    """
    starts, ends, first = blank_words(data, at)
    words = run_hashes(data, starts, ends)
    n = np.diff(first)
    if not len(words):
        return words, np.zeros(len(n) + 1, np.int64)
    counts = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    full = np.zeros(len(words), np.uint64)
    for j in range(WORDS):
        full[:max(len(words) - j, 0)] += words[j:] * np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
    short = np.flatnonzero((n > 0) & (n < WORDS))
    full[first[short]] = run_hashes(words, first[short], first[short + 1])
    owner = np.repeat(np.arange(len(n)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    shingles = mix(full[first[owner] + inside])
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[fresh], np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(n)))])


def _odd(seed: int) -> np.uint64:
    """A 64-bit factor for each seed."""
    return mix(np.array([seed + 1], np.uint64))[0] | np.uint64(1)


def _paths(texts: DataFrame, count: int) -> DataFrame:
    """A row per class and run: `digest`, `run`, `size`, the chosen shingles of each step `t1`, `t2`, .., and on run 0 the `sketch`."""
    names = [f"t{k + 1}" for k in range(LEVELS)]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for big in batches:
            for batch in slices(big, "text"):
                shingles, at = shingle_sets(*utf8_batch(batch.column("text")))
                size = np.diff(at)
                has = np.flatnonzero(size)
                if not len(has):
                    continue
                owner = np.repeat(np.arange(len(size)), size)
                share = np.minimum(CHOICES / np.maximum(size, 1), 1.0)
                bar = np.where(share >= 1, np.iinfo(np.uint64).max, (share * 2.0 ** 63).astype(np.uint64) * np.uint64(2))[owner]
                sketch = np.empty((len(has), SKETCH), np.uint8)
                for k in range(SKETCH):
                    own = shingles * _odd(1000 + k)
                    own ^= own >> np.uint64(31)
                    own *= _odd(2000 + k)
                    low = np.minimum.reduceat(own, at[:-1][has])
                    sketch[:, k] = (low ^ (low >> np.uint64(16)) ^ (low >> np.uint64(32))).astype(np.uint8)
                digests, sizes = batch.column("digest").take(pa.array(has)), pa.array(size[has])
                for run in range(count):
                    lists = []
                    for level in range(LEVELS):
                        hit = np.flatnonzero(shingles * _odd(run * LEVELS + level) <= bar)
                        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[hit], minlength=len(size))[has])])
                        lists.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(shingles[hit].view(np.int64))))
                    told = pa.array([s.tobytes() for s in sketch], pa.binary()) if run == 0 else pa.nulls(len(has), pa.binary())
                    yield pa.record_batch([digests, pa.array(np.full(len(has), run, np.int32)), sizes, told, *lists], ["digest", "run", "size", "sketch", *names])

    return texts.select("digest", "text").mapInArrow(choose, "digest binary, run int, size long, sketch binary, " + ", ".join(f"{n} array<long>" for n in names))


def _buckets(paths: DataFrame) -> DataFrame:
    """Members of all buckets of at least two: `bucket`, `digest`, `n`. Only buckets over LIMIT go a step further."""
    rows = paths.select("digest", "run", F.explode("t1").alias("token")).select("digest", "run", F.xxhash64("run", "token").alias("bucket"))
    members = None
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        sized = stored(rows.join(sizes, "bucket"), f"buckets{level}")
        done = sized if level == LEVELS else sized.where(F.col("n") <= LIMIT)
        members = done if members is None else members.unionByName(done)
        if level < LEVELS:
            further = paths.select("digest", "run", F.explode(f"t{level + 1}").alias("token"))
            rows = (sized.where(F.col("n") > LIMIT).join(further, ["digest", "run"])
                    .select("digest", "run", F.xxhash64("bucket", "token").alias("bucket")))
    return members.select("bucket", "digest", "n")


def in_blocks(members: DataFrame, size: str, block: int) -> DataFrame:
    """Deal the members of a large group into blocks and every two blocks into a task: `i`, `j`, and `own`, the member's block."""
    parts = F.ceil(F.col(size) / block).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("digest"), parts).cast("int"))
    other = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    return dealt.select("*", other).select(*dealt.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each row of a symmetric matrix of links is connected with."""
    labels = np.arange(len(linked))
    while True:
        heard = np.where(linked, labels[None, :], len(linked)).min(1)
        new = np.minimum(labels, heard)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _alike(sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which pairs of a bucket may be linked, by sketch and size."""
    n = len(sizes)
    equal = np.empty((n, n), np.uint8)
    step = max(1, 2_000_000 // (n * SKETCH) + 1)
    for lo in range(0, n, step):
        equal[lo:lo + step] = (sketches[lo:lo + step, None, :] == sketches[None, :, :]).sum(2, dtype=np.uint8)
    near = np.minimum(sizes[:, None], sizes[None, :]) >= LEAST * np.maximum(sizes[:, None], sizes[None, :])
    return (equal >= AGREE) & near


def _compare_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and block pair -> a link from every member that has one to the first of those connected."""
    held: pa.Table | None = None

    def links(table: pa.Table) -> pa.RecordBatch:
        digests = table["digest"].combine_chunks()
        group = np.stack([np.asarray(table[n]) for n in ("bucket", "i", "j")], 1)
        own, sizes = np.asarray(table["own"]), np.asarray(table["size"])
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        cuts = np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1
        a, b = [], []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
            if hi - lo < 2:
                continue
            linked = _alike(sketches[lo:hi], sizes[lo:hi])
            if group[lo, 1] != group[lo, 2]:
                linked &= own[lo:hi, None] != own[None, lo:hi]
            roots = _roots(linked)
            rows = np.flatnonzero(roots != np.arange(hi - lo))
            a += (lo + rows).tolist()
            b += (lo + roots[rows]).tolist()
        return pa.record_batch([digests.take(pa.array(a, pa.int64())), digests.take(pa.array(b, pa.int64()))], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        key = np.stack([np.asarray(table[n]) for n in ("bucket", "i", "j")], 1)
        open_ = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if len(key) and (key != key[-1]).any() else 0  # the last group may go on
        if open_:
            yield links(table.slice(0, open_))
        held = table.slice(open_).combine_chunks()
    if held is not None and held.num_rows:
        yield links(held)


def _sets(texts: DataFrame) -> DataFrame:
    """The rows with the sorted shingles of their text, in binary, instead of the text."""
    others = [n for n in texts.columns if n != "text"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for big in batches:
            for batch in slices(big, "text"):
                shingles, at = shingle_sets(*utf8_batch(batch.column("text")))
                raw = shingles.tobytes()
                found = pa.array([raw[8 * a:8 * b] for a, b in zip(at.tolist(), at[1:].tolist())], pa.binary())
                yield pa.record_batch([*(batch.column(n) for n in others), found], [*others, "shingles"])

    return texts.mapInArrow(make, StructType([*texts.select(*others).schema, StructField("shingles", BinaryType())]))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles every two sets share, by products of 0-1 matrices over the shingles that stand in several."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    on = n[which] > 1
    owner, which = owner[on], column[which[on]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    step = 4096
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, step):
        a, b = np.searchsorted(which, [lo, lo + step])
        part = np.zeros((len(sets), step), np.float32)
        part[owner[a:b], which[a:b] - lo] = 1
        shared += part @ part.T
    return shared


def _verify(group: pd.DataFrame) -> pd.DataFrame:
    """Exact links within two blocks of a candidate group: how many documents each class is linked with there, and the
    first class that it is connected with."""
    group = group.sort_values("digest").reset_index(drop=True)
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
    sizes = np.array([len(s) for s in sets])
    shared = overlaps(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= LEAST * union - 1e-6  # both are whole numbers; a tie at LEAST is a link
    np.fill_diagonal(linked, False)
    own = group["own"].to_numpy()
    if group["i"].iloc[0] != group["j"].iloc[0]:
        linked &= own[:, None] != own[None, :]
    roots = _roots(linked)
    rows = np.flatnonzero(linked.any(1))
    return pd.DataFrame({"digest": group["digest"].iloc[rows], "root": group["digest"].iloc[roots[rows]].to_numpy(),
                         "links": (linked * group["n"].to_numpy()[None, :]).sum(1)[rows].astype(np.int64)})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, `class_id` (smallest id with an equal text), `group_id` (smallest id of the group that
    links connect), `n_links` (other documents with an equal text or a shingle Jaccard of at least LEAST).

    Equal texts are one class and are compared once. In each of several independent runs a set follows the paths of
    the shingles it samples; two sets that share a path meet in its bucket. Buckets up to LIMIT are compared at once,
    larger ones are split by a further shared shingle, and what is still larger is compared in blocks. Comparing means
    sketches first: they give candidate groups, one link per member instead of all pairs. Within each candidate group
    all pairs are then compared by their whole sets, in blocks, and counted where they are found, so no pair becomes a
    row. Runs are repeated up to the target RECALL for pairs at LEAST; more similar ones meet more surely.

    Null texts count as empty. Texts without words are linked with equal ones only; fewer than WORDS words are one
    shingle. Null ids never name a class that has another id; repeated rows count as copies. An empty table gives an
    empty result; further columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows, again, texts = classes(docs, id_col, text_col)
    paths = stored(_paths(texts, runs()), "paths")
    sketches = paths.where("run = 0").select("digest", "size", "sketch")
    members = in_blocks(_buckets(paths), "n", BLOCK).join(sketches, "digest")
    sorted_ = (members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "digest")
               .select("bucket", "i", "j", "own", "digest", "size", "sketch"))
    candidates = stored(sorted_.mapInArrow(_compare_buckets, "a binary, b binary").distinct(), "candidates")
    near = stored(components(candidates), "near")
    wide = near.groupBy("group").agg(F.count("*").alias("size"))
    active = stored(near.join(wide, "group").select(F.col("node").alias("digest"), "group", "size"), "active")
    held = texts.join(bounded(active), "digest").select("digest", "text", "group", "size", "n")
    checked = stored(in_blocks(_sets(held), "size", SET_BLOCK).groupBy("group", "i", "j").applyInPandas(_verify, "digest binary, root binary, links long"), "checked")
    groups = components(checked.where("digest != root").select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("digest").agg(F.sum("links").alias("links"))
    named = rows.select("digest", "id").join(bounded(stored(links.select("digest"), "linked")), "digest").groupBy("digest").agg(F.min("id").alias("first"))
    grouped = links.join(groups, links["digest"] == groups["node"]).select("digest", "links", "group").join(named, "digest")
    least = grouped.groupBy("group").agg(F.min("first").alias("group_id"))
    told = stored(grouped.join(least, "group").select("digest", "links", "group_id")
                  .join(again, "digest", "full"), "told")
    return rows.select("id", "digest").join(told, "digest", "left").select(
        F.col("id").alias(id_col), F.coalesce("first", "id").alias("class_id"), F.coalesce("group_id", "first", "id").alias("group_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each linked group the one with the smallest id."""
    told = near_duplicates(docs, id_col, text_col)
    gone = told.where(~F.col(id_col).eqNullSafe(F.col("group_id"))).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(bounded(stored(gone, "gone")), F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
