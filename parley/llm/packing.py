"""Packing token sequences: minimum bin slack over the counts of remaining lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.bpe import encoder, slices, texts_of
from parley.llm.common import small_batches, stored, text_of

#: Parts into which the documents of one remaining length are dealt before they are numbered.
SALTS = 64
#: Bytes of text that are split into words at a time; the arrays beside it take some fifty times as much.
SLICE = 700_000
ENTRY = ("length", "lo", "hi", "per", "sequence", "offset", "take", "rest_lo")


def fill(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths, the largest one included, whose sum comes closest to the capacity.

    A bitset holds the sums reached with each further length; the counts are read back from the last one.
    """
    lengths = np.flatnonzero(counts)[::-1].tolist()
    chosen = {lengths[0]: 1}
    room = capacity - lengths[0]
    mask = (1 << (room + 1)) - 1
    reached, stages = 1, []
    for length in lengths:
        most = min(int(counts[length]) - (length == lengths[0]), room // length)
        if most <= 0:
            continue
        stages.append((length, most, reached))
        step = 1
        while most:  # doubling: 1, 2, 4, .. copies and the remainder
            copies = min(step, most)
            reached |= reached << (copies * length)
            reached &= mask
            most, step = most - copies, step * 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    for length, most, before in reversed(stages):
        copies = next(k for k in range(most + 1) if total >= k * length and before >> (total - k * length) & 1)
        if copies:
            chosen[length] = chosen.get(length, 0) + copies
        total -= copies * length
    return chosen


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Where the remainder number r of each length goes: rows of ENTRY sorted by length and `lo`, and the number of sequences.

    counts[l]: documents that leave l ids, 0 < l < capacity. The numbers lo <= r < hi of a length go to sequences
    from `sequence` on, `per` to each, side by side from `offset`. Of each, `take` ids go there; if that is not all,
    the rest is number rest_lo + (r - lo) of the shorter length. A window that no multiset fills takes the missing
    ids from a longer remainder. What is left in the end, less than a window, fills windows of powers of two.
    Every round uses up a length, so the rounds don't grow with the documents.
    """
    left, used, total = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64), counts.astype(np.int64).copy()
    entries: list[tuple] = []
    sequences = 0

    def place(length: int, per: int, times: int, sequence: int, offset: int, take: int) -> None:
        rest = length - take
        entries.append((length, used[length], used[length] + per * times, per, sequence, offset, take, total[rest] if rest else 0))
        used[length] += per * times
        left[length] -= per * times
        if rest:
            total[rest] += times
            left[rest] += times

    while int((left * np.arange(len(left))).sum()) >= capacity:
        chosen = fill(left, capacity)
        slack = capacity - sum(n * k for n, k in chosen.items())
        need, cut = dict(chosen), 0
        if slack:  # some remainder is longer than the slack: a shorter one would have been chosen
            cut = next(x for x in range(len(left) - 1, slack, -1) if left[x] > chosen.get(x, 0))
            need[cut] = need.get(cut, 0) + 1
        times = min(int(left[n]) // k for n, k in need.items())
        offset = 0
        for n, k in chosen.items():
            place(n, k, times, sequences, offset, n)
            offset += n * k
        if slack:
            place(cut, 1, times, sequences, offset, slack)
        sequences += times
    rest = int((left * np.arange(len(left))).sum())
    for power in reversed(range(capacity.bit_length())):
        room = 1 << power
        if rest & room:
            offset = 0
            while offset < room:
                length = int(np.flatnonzero(left)[-1])
                take = min(length, room - offset)
                place(length, 1, 1, sequences, offset, take)
                offset += take
            sequences += 1
    return np.array(sorted(entries), np.int64).reshape(-1, len(ENTRY)), sequences


def pack(docs: DataFrame, vocab_path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack the ids of all texts, each closed by `end_id`, into sequences of at most `capacity` ids.

    One row per piece: id, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`. Full windows of a
    document are sequences of their own; what remains of each document is packed by the counts of remaining
    lengths, of which there are fewer than `capacity`: only these counts come to the driver. The documents of one
    length are numbered in `SALTS` parts, so a length that a third of all documents leave is no single task.

    Null texts count as empty and give the end id alone; null ids and repeated rows are packed as rows of their
    own; an empty table gives no pieces; further columns are ignored.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocab_path)
        kind = np.uint16 if max(tool.vocab.token_bytes) < 1 << 16 else np.uint32
        for big in batches:
            for batch in slices(big, "text", SLICE):
                flat, at = tool.encode(texts_of(batch.column("text")))
                sums, rests, totals = [], [], []
                for lo, hi in zip(at.tolist(), at[1:].tolist()):
                    own = np.append(flat[lo:hi], end_id).astype("<u4")
                    full = len(own) // capacity
                    sums.append([zlib.crc32(own[i * capacity:(i + 1) * capacity].tobytes()) for i in range(full)])
                    rests.append(own[full * capacity:].astype(kind).tobytes())
                    totals.append(len(own))
                yield pa.record_batch([batch.column("id"), pa.array(totals, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(rests, pa.binary())],
                                      ["id", "tokens", "sums", "rest"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    coded = (rows.mapInArrow(encode, f"id {kind}, tokens long, sums array<long>, rest binary")
             .withColumn("left", F.col("tokens") % capacity).withColumn("full", F.floor(F.col("tokens") / capacity))
             .withColumn("salt", F.pmod(F.xxhash64("id", "tokens", "rest"), F.lit(SALTS)).cast("int")))
    coded = stored(coded, "coded")
    groups = coded.groupBy("left", "salt").agg(F.count("*").alias("n"), F.sum("full").alias("full")).toArrow()
    groups = {name: groups[name].to_numpy() for name in groups.column_names}
    counts, windows = np.zeros((capacity, SALTS), np.int64), np.zeros((capacity, SALTS), np.int64)
    counts[groups["left"], groups["salt"]] = groups["n"]
    windows[groups["left"], groups["salt"]] = groups["full"]
    of_length = counts.sum(1)
    of_length[0] = 0
    entries, sequences = plan(of_length, capacity)
    first_rank = np.cumsum(counts, 1) - counts
    first_window = (np.cumsum(windows.ravel()) - windows.ravel()).reshape(windows.shape) + sequences
    keys = entries[:, 0] << 40 | entries[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(name) for name in batch.schema.names if name not in ("sums", "rest", "id")}
            col = {name: np.asarray(a) for name, a in col.items()}
            rank = first_rank[col["left"], col["salt"]] + col["number"] - 1
            window = first_window[col["left"], col["salt"]] + col["before"] - col["full"]
            sums, rests = batch.column("sums").to_pylist(), batch.column("rest").to_pylist()
            out: list[tuple] = []
            for row, (left, full, number, at, crcs, rest) in enumerate(zip(col["left"].tolist(), col["full"].tolist(), rank.tolist(), window.tolist(), sums, rests)):
                out += [(row, i * capacity, capacity, crc, at + i, 0) for i, crc in enumerate(crcs)]
                wide = np.frombuffer(rest, np.uint16 if left and len(rest) == 2 * left else np.uint32).astype("<u4")
                done = 0
                while done < left:
                    e = entries[np.searchsorted(keys, (left - done) << 40 | number, side="right") - 1]
                    _, lo, _, per, sequence, offset, take, rest_lo = e.tolist()
                    instance, slot = divmod(number - lo, per)
                    out.append((row, full * capacity + done, take, zlib.crc32(wide[done:done + take].tobytes()), sequence + instance, offset + slot * (left - done)))
                    number, done = rest_lo + number - lo, done + take
            told = np.array(out, np.int64).reshape(-1, 6)
            yield pa.record_batch([batch.column("id").take(pa.array(told[:, 0])), *(pa.array(told[:, i]) for i in (1, 2, 3)),
                                   pa.array(col["tokens"][told[:, 0]]), *(pa.array(told[:, i]) for i in (4, 5))],
                                  ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    order = Window.partitionBy("left", "salt").orderBy("id", "tokens", "rest", "sums")
    numbered = coded.withColumn("number", F.row_number().over(order)).withColumn(
        "before", F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = numbered.mapInArrow(place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
