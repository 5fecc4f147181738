"""Repeated byte strings by sorted suffixes: sampled splitters, local multikey sort, comparison across buckets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.bpe import slices
from parley.llm.classes import classes
from parley.llm.common import let_go, mix, small_batches, stored, utf8_batch

#: Bytes of a repeated string, and leading bytes by which suffixes are grouped (three words of eight bytes).
MATCH, LEAD = 100, 24
#: Starts of leading strings within one repeated string; the smallest hash among them is its anchor.
SPAN = MATCH - LEAD + 1
#: Anchor hashes that are broadcast (8 bytes each); more are joined.
BROADCAST_HASHES = 4_000_000
#: Bytes of text whose hashes are in memory at a time (some ten numbers for each), or one text.
SLICE = 1_000_000
#: Bits of a place in a batch of joined texts.
PLACE_BITS = 28


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of joined texts: places, and 64-bit hashes of the LEAD bytes there.

    Every string of MATCH bytes has one, chosen by its own bytes alone, so equal strings have equal anchors.
    """
    sizes = np.diff(at)
    starts = np.repeat(at[:-1], np.maximum(sizes - MATCH + 1, 0))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) >> PLACE_BITS:
        raise ValueError(f"a text of more than {1 << PLACE_BITS} bytes")
    base, key = np.uint64(0x9E3779B97F4A7C15), data.astype(np.uint64) + np.uint64(1)
    # Polynomial hashes of 1, 2, 4, 8, 16 bytes by doubling; 24 are 16 and 8.
    eight = None
    for width in (1, 2, 4, 8):
        eight = key if width == 8 else eight
        factor = pow(int(base), width, 1 << 64)
        key = key[:len(key) - width] * np.uint64(factor) + key[width:]
    key = mix(key[:len(data) - LEAD + 1] * np.uint64(pow(int(base), 8, 1 << 64)) + eight[16:16 + len(data) - LEAD + 1])
    ranked = (key >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(key), dtype=np.uint64)
    least, width = ranked, 1
    while width * 2 <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(key) - SPAN + 1], least[SPAN - width:SPAN - width + len(key) - SPAN + 1])
    inside = np.zeros(len(least), bool)
    inside[starts + np.arange(len(starts)) - np.repeat(np.cumsum(np.maximum(sizes - MATCH + 1, 0)) - np.maximum(sizes - MATCH + 1, 0), np.maximum(sizes - MATCH + 1, 0))] = True
    places = np.unique((least[inside] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64))
    return places, key[places]


def _anchor_counts(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for big in batches:
            for batch in slices(big, "text", SLICE):
                _, keys = anchors(*utf8_batch(batch.column("text")))
                keys, n = np.unique(keys, return_counts=True)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    return texts.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


CONTEXT = "id {kind}, digest binary, place long, lead int, context binary"


def _contexts(data: np.ndarray, at: np.ndarray, places: np.ndarray, ids: pa.Array, digests: pa.Array) -> pa.RecordBatch:
    """A row per suffix: its text, its place there, and the bytes around: up to SPAN - 1 before, up to MATCH from there on."""
    owner = np.searchsorted(at, places, side="right") - 1
    lo, hi = np.maximum(places - SPAN + 1, at[owner]), np.minimum(places + MATCH, at[owner + 1])
    raw = data.tobytes()
    around = [raw[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
    take = pa.array(owner)
    return pa.record_batch([ids.take(take), digests.take(take), pa.array(places - at[owner]), pa.array((places - lo).astype(np.int32)), pa.array(around, pa.binary())],
                           ["id", "digest", "place", "lead", "context"])


def suffix_rows(texts: DataFrame, again: DataFrame) -> DataFrame:
    """Suffixes at anchors whose leading bytes (their hash, `key`) stand in `again`.

    The hashes are broadcast if there are at most `BROADCAST_HASHES`; else all anchors are joined with them, and
    the places found go back to the texts.
    """
    kind = texts.schema["id"].dataType.simpleString()
    schema = CONTEXT.format(kind=kind)
    if again.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES:
        known = texts.sparkSession.sparkContext.broadcast(np.sort(again.toArrow()["key"].to_numpy()))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            have = known.value
            for big in batches:
                for batch in slices(big, "text", SLICE):
                    data, at = utf8_batch(batch.column("text"))
                    places, keys = anchors(data, at)
                    keys = keys.view(np.int64)
                    hit = np.minimum(np.searchsorted(have, keys), max(len(have) - 1, 0))
                    on = have[hit] == keys if len(have) else np.zeros(len(keys), bool)
                    yield _contexts(data, at, places[on], batch.column("id"), batch.column("digest"))

        return texts.select("id", "digest", "text").mapInArrow(pick, schema)

    def all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for big in batches:
            for batch in slices(big, "text", SLICE):
                data, at = utf8_batch(batch.column("text"))
                places, keys = anchors(data, at)
                owner = np.searchsorted(at, places, side="right") - 1
                yield pa.record_batch([batch.column("digest").take(pa.array(owner)), pa.array(places - at[owner]), pa.array(keys.view(np.int64))], ["digest", "place", "key"])

    def at_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for big in batches:
            for batch in slices(big, "text", SLICE):
                data, at = utf8_batch(batch.column("text"))
                places = [p + lo for lo, own in zip(at.tolist(), batch.column("places").to_pylist()) for p in sorted(own)]
                yield _contexts(data, at, np.array(places, np.int64), batch.column("id"), batch.column("digest"))

    found = texts.select("digest", "text").mapInArrow(all_keys, "digest binary, place long, key long")
    found = found.join(again.select("key"), "key").groupBy("digest").agg(F.collect_list("place").alias("places"))
    return texts.join(found, "digest").select("id", "digest", "text", "places").mapInArrow(at_places, schema)


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of 8-byte words, and for each row in that order the number of leading words equal to the row before.

    A multikey quicksort, all its parts side by side: the rows are split by one word, and only rows of a part that
    still has several go on to the next word.
    """
    n, depth = words.shape
    order, shared = np.arange(n), np.full(n, depth, np.int64)
    shared[:1] = 0
    part = np.zeros(n, np.int64)
    live = np.arange(n) if n > 1 else np.zeros(0, np.int64)  # positions of the order that are not settled
    for k in range(depth):
        if not len(live):
            break
        own = words[order[live], k]
        by = np.lexsort((own, part[live]))
        order[live], own = order[live[by]], own[by]
        first = np.ones(len(live), bool)
        first[1:] = part[live[1:]] != part[live[:-1]]
        differs = np.ones(len(live), bool)
        differs[1:] = own[1:] != own[:-1]
        cut = differs & ~first
        shared[live[cut]] = k
        starts = first | cut
        part[live] = np.cumsum(starts)
        alone = starts & np.append(starts[1:], True)
        live = live[~alone]
    return order, shared


def _equal_bytes(rows: np.ndarray, order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Leading bytes that each row has in common with the row before in the order."""
    same = np.zeros(len(order), np.int64)
    if len(order) > 1:
        word = np.minimum(shared, rows.shape[1] // 8 - 1)[1:, None] * 8 + np.arange(8)
        here, before = order[1:, None], order[:-1, None]
        equal = rows[here, word] == rows[before, word]
        same[1:] = shared[1:] * 8 + np.where(shared[1:] * 8 < rows.shape[1], np.cumprod(equal, 1).sum(1), 0)
    return same


def _padded(pieces: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)


def _classes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows and common leading bytes with the row before."""
    order, shared = multikey_order(rows.view(">u8").astype(np.uint64))
    return order, _equal_bytes(rows, order, shared)


def repeats(table: pa.Table) -> list[tuple]:
    """Within one bucket: which strings of MATCH bytes around each suffix occurred at an earlier suffix.

    Rows of (row, first byte, end, None) to remove, and (row, start, -1, string) for those strings that are the first
    of the bucket but whose leading bytes may also stand in the neighbouring buckets.
    """
    n = table.num_rows
    if not n:
        return []
    lead, place = np.asarray(table["lead"]), np.asarray(table["place"])
    context = table["context"].to_pylist()
    after = [c[k:] for c, k in zip(context, lead.tolist())]
    size = np.fromiter(map(len, after), np.int64, n)
    right = _padded(after, -(-MATCH // 8) * 8)
    left = _padded([c[:k][::-1] for c, k in zip(context, lead.tolist())], -(-(SPAN - 1) // 8) * 8)
    owners = [(i is not None, i if i is not None else 0, d) for i, d in zip(table["id"].to_pylist(), table["digest"].to_pylist())]
    number = {o: k for k, o in enumerate(sorted(set(owners)))}
    age = np.lexsort((place, np.fromiter((number[o] for o in owners), np.int64, n)))  # the earliest suffix first
    order, same = _classes(right)
    back, back_same = _classes(left)
    lead_class = np.empty(n, np.int64)
    lead_class[order] = np.cumsum(same < LEAD)
    edge = (lead_class == lead_class[order[0]]) | (lead_class == lead_class[order[-1]])
    gone, first = np.zeros((n, SPAN), bool), np.zeros((n, SPAN), bool)
    ahead, behind = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(SPAN):  # strings that start d bytes before the suffix
        fits = (lead >= d) & (size >= MATCH - d)
        ahead[order] = np.cumsum(same < MATCH - d)
        behind[back] = np.cumsum(back_same < d) if d else 0
        rows = age[fits[age]]
        kinds = ahead[rows] * (n + 1) + behind[rows]
        first_at = np.zeros(len(rows), bool)
        first_at[np.unique(kinds, return_index=True)[1]] = True
        gone[rows[~first_at], d] = True
        first[rows[first_at & edge[rows]], d] = True
    out: list[tuple] = []
    step = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for row, lo, hi in zip(*np.nonzero(step == 1), np.nonzero(step == -1)[1]):
        out.append((row, int(place[row] - hi + 1), int(place[row] - lo + MATCH), None))
    for row, d in zip(*np.nonzero(first)):
        start = int(lead[row] - d)
        out.append((row, int(place[row] - d), -1, context[row][start:start + MATCH]))
    return out


def repeated_spans(texts: DataFrame, parts: int | None = None) -> DataFrame:
    """Byte spans [start, stop) to remove: `id`, `digest`, `start`, `stop`; overlaps stand side by side.

    texts: `id`, `text`, `digest`, one row per class. Suffixes are taken where a repeat can be told: at the anchors
    whose leading bytes occur again anywhere. Spark samples splitters and deals the suffixes into ranges of their
    bytes, then of document and place, so that leading bytes shared by very many suffixes take several buckets. A
    bucket sorts its suffixes, and their contexts read backwards, by multikey quicksort; common lengths of neighbours
    tell which strings are equal. Strings whose leading bytes stand at the edge of a bucket meet those of other
    buckets in a second, small comparison of the strings themselves.
    """
    kind = texts.schema["id"].dataType.simpleString()
    again = stored(_anchor_counts(texts).where("n > 1").select("key"), "again")
    found = stored(suffix_rows(texts, again).withColumn("suffix", F.expr(f"substring(context, lead + 1, {LEAD})")), "suffixes")
    parts = parts or 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a bucket is held in memory
    dealt = found.repartitionByRange(parts, "suffix", "id", "digest", "place").drop("suffix")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held = list(batches)
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            out = repeats(table)
            rows = pa.array([r for r, *_ in out], pa.int64())
            yield pa.record_batch([*(table[n].combine_chunks().take(rows) for n in ("id", "digest")), *(pa.array([x[i] for x in out], pa.int64()) for i in (1, 2)),
                                   pa.array([x[3] for x in out], pa.binary())],
                                  ["id", "digest", "start", "stop", "string"])

    told = stored(dealt.mapInArrow(compare, f"id {kind}, digest binary, start long, stop long, string binary"), "told")
    age = Window.partitionBy("string").orderBy(F.asc_nulls_first("id"), "digest", "start")
    # One place may send its string twice, from two anchors: both have one rank.
    later = (told.where("string is not null").withColumn("age", F.dense_rank().over(age)).where("age > 1")
             .select("id", "digest", "start", (F.col("start") + MATCH).alias("stop")))
    return told.where("string is null").drop("string").unionByName(later)


def _whole_letters(raw: bytes, start: int, stop: int) -> dict[str, int]:
    """A span widened to the borders of letters, so what is left stays valid UTF-8."""
    while start > 0 and raw[start] & 0xC0 == 0x80:
        start -= 1
    while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
        stop += 1
    return {"start": start, "stop": stop}


def _cut(raw: bytes, spans: list) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left."""
    removed, runs, upto, kept = 0, 0, -1, []
    at = 0
    for lo, hi in sorted((s["start"], s["stop"]) for s in spans):
        if lo > upto:
            runs += 1
            kept.append(raw[at:lo])
            removed += hi - lo
            upto = hi
        elif hi > upto:
            removed += hi - upto
            upto = hi
        at = upto
    return removed, runs, b"".join([*kept, raw[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False) -> DataFrame:
    """Per document: id, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`; with `keep_columns` all columns of `docs`
    with the text left over instead; there cuts are widened to whole letters.

    A byte goes if a string of MATCH bytes around it also starts earlier: at a smaller id, or before in the same text.
    Copies of a whole text go without being sorted: all but the smallest id lose everything if they have MATCH bytes.

    Null texts count as empty; null ids come before all others among different texts, and after them among copies;
    rows that repeat id and text are treated alike, so none of them removes the other; further columns are ignored or
    kept; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows, again, texts = classes(docs, id_col, text_col)
    spans = repeated_spans(texts).groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    marks = stored(again.select("digest", "first", F.lit(True).alias("copied")).join(spans, "digest", "full"), "marks")
    base = rows if not keep_columns else docs.withColumn("__digest", F.unhex(F.md5(F.coalesce(text_col, F.lit("")))))
    own, key = ("id", "digest") if not keep_columns else (id_col, "__digest")
    marks = marks.select(F.col("digest").alias("__key"), F.col("first").alias("__first"), "copied", "spans")
    joined = base.join(marks, F.col(key) == F.col("__key"), "left")
    later = F.coalesce(F.col("copied"), F.lit(False)) & ~F.col(own).eqNullSafe(F.col("__first"))
    text, columns = (text_col if keep_columns else "text"), docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts_, spans_, later_ = (batch.column(n).to_pylist() for n in (text, "spans", "later"))
            out = []
            for t, own_spans, copy in zip(texts_, spans_, later_):
                raw = (t or "").encode()
                if copy:
                    own_spans = [{"start": 0, "stop": len(raw)}] if len(raw) >= MATCH else None
                if keep_columns and own_spans:
                    own_spans = [_whole_letters(raw, x["start"], x["stop"]) for x in own_spans]
                removed, runs, left = _cut(raw, own_spans) if own_spans else (0, 0, raw)
                out.append((len(raw), removed, runs, left, t))
            if keep_columns:
                kept = pa.array([t if not runs else left.decode() for _, _, runs, left, t in out], pa.string())
                yield pa.record_batch([kept if n == text else batch.column(n) for n in columns], columns)
            else:
                yield pa.record_batch([batch.column("id"), *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)),
                                       pa.array([hashlib.sha256(x[3]).hexdigest() for x in out])], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    if keep_columns:
        return joined.withColumn("later", later).select(*columns, "spans", "later").mapInArrow(cut, docs.schema)
    kind = rows.schema["id"].dataType.simpleString()
    told = joined.withColumn("later", later).select("id", "text", "spans", "later").mapInArrow(
        cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return told.withColumnRenamed("id", id_col)
