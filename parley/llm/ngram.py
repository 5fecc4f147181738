"""Scoring text with an n-gram model: a weighted automaton whose failure arcs back off to shorter contexts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.bpe import slices
from parley.llm.common import blank_words, let_go, mix, ranges, removed, shuffles_removed, small_batches, text_of, utf8_batch, word_hashes
from parley.llm.common import stored_lean as stored

#: How often a word or an n-gram must occur to be a state, at any size of the training text.
LEAST = 2
#: Share of all training tokens that a word or an n-gram needs to be sent to every task; the others are joined. As the
#: counts of one order sum to at most all tokens, there are at most 1 / share of each: the bound of a broadcast.
GRAM_SHARE = 5e-7
ORDER = 3
#: Bits of a broadcast filter that spares the join most n-grams that are not in the table, and blocks they are merged in; powers of two.
FILTER_BITS, FILTER_BLOCKS = 1 << 27, 64
#: Ranges of hashes for each shuffle partition, and rows that a task gathers before it deals them out.
BUCKETS_EACH, PENDING = 1, 1_000_000
#: Tokens that one lane of the traversal reads; lanes run side by side.
LANE = 32
#: Hashes that stand for a text's start and its end, and the bits of a word's number in an n-gram's key.
START, END, WORD_BITS = np.uint64(0), np.uint64(1), 22
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, each text closed by `END`; and where each text starts."""
    data, at = utf8_batch(column)
    starts, ends, first = blank_words(data, at)
    words = word_hashes(LOWER[data], starts, ends)
    words[words <= END] = np.uint64(2)
    sizes = np.diff(first) + 1
    upto = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(upto[-1]), END, np.uint64)
    out[ranges(upto[:-1], sizes - 1)] = words
    return out, upto


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted list, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Index:
    """Finds hashes in a list by their first bits and a few steps, where a binary search takes many."""

    def __init__(self, hashes: np.ndarray) -> None:
        bits = max(1, len(hashes).bit_length())
        self.shift, self.order = np.uint64(64 - bits), np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], ~np.uint64(0))
        self.start = np.searchsorted(self.hashes[:-1] >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the list, or -1."""
        at = self.start[(hashes >> self.shift).astype(np.int64)]
        found = self.hashes[at]
        less = np.flatnonzero(found < hashes)
        while len(less):
            at[less] += 1
            found[less] = self.hashes[at[less]]
            less = less[found[less] < hashes[less]]
        out = np.full(len(hashes), -1, np.int64)
        hit = np.flatnonzero((found == hashes) & (at < len(self.order)))
        out[hit] = self.order[at[hit]]
        return out


def grams(words: np.ndarray, upto: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the n-gram that ends at each token: hash of its words but the last, and of those but the first; its own is their `pair`.

    In front of a text stands its start, so a text's first token ends no n-gram of three.
    """
    if order == 2:
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[upto[:-1]] = START
        return before, words
    pairs = pair(*grams(words, upto, 2))
    inside = np.ones(len(words), bool)
    inside[upto[:-1]] = False
    at = np.flatnonzero(inside)
    return pairs[at - 1], pairs[at]


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) + b)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each key."""
    bit = keys & np.uint64(FILTER_BITS - 1)
    return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


@dataclass
class Model:
    """Counts and the automaton of what is frequent. State 0 has no context; 1.. are frequent words, the first of them a text's start;
    then come pairs, and so on up to the order less one."""

    total: int  # training tokens
    kinds: int  # different ones
    discount: float  # taken from every seen word for the unseen
    words: np.ndarray  # sorted hashes of the words that every task knows
    counts: np.ndarray
    frequent: np.ndarray  # number among the frequent words, or -1
    grams: list[np.ndarray]  # by order from 2: sorted keys, number of the n-gram before << WORD_BITS | number of the word
    gram_counts: list[np.ndarray]
    first: np.ndarray | None = None  # first state of contexts of 1, 2, .. words
    seen: np.ndarray | None = None  # filter: bits at the hashes of all n-grams in the table
    arcs: np.ndarray | None = None  # sorted keys: state << WORD_BITS | number of the word
    weight: np.ndarray | None = None  # log10 probability of each arc
    target: np.ndarray | None = None
    fail: np.ndarray | None = None  # state with the context shortened by its first word
    cost: np.ndarray | None = None  # log10 weight of the failure arc
    cost_all: np.ndarray | None = None  # of all failure arcs down to state 0
    longer: DataFrame | None = None  # stored `key` and `gain` of all n-grams, which stay on the driver's side

    def __getstate__(self) -> dict:
        return self.__dict__ | {"longer": None}

    @cached_property
    def word_index(self) -> Index:
        return Index(self.words)

    @cached_property
    def arc_index(self) -> Index:
        return Index(mix(self.arcs))

    def unseen(self) -> float:
        return self.discount * self.kinds / self.total if self.total else 1.0

    def word_logs(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability without context; of an unseen word, that of all unseen ones together."""
        if not self.total:
            return np.zeros(len(counts))
        return np.log10(np.where(counts > 0, (counts - self.discount) / self.total, self.unseen()))

    def base_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.kinds + 1))

    def numbers(self, words: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token among the known words, and its number among the frequent ones (0: a text's start)."""
        place = self.word_index.places(words)
        return place, np.where(place >= 0, self.frequent[place] if len(self.frequent) else -1, -1)

    def missed(self, words: np.ndarray, upto: np.ndarray, owner: np.ndarray, read: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams that the automaton lacks and the table may have, and their texts; `read` is from `traverse`."""
        found, texts = [], []
        for order in range(2, ORDER + 1):
            before, last = grams(words, upto, order)
            at = np.arange(len(words)) if len(last) == len(words) else np.delete(np.arange(len(words)), upto[:-1])
            lacks = np.flatnonzero(read[at] < order)
            keys = pair(before[lacks], last[lacks])
            may = passes(self.seen, keys)
            found.append(keys[may])
            texts.append(owner[at[lacks[may]]])
        return np.concatenate(found), np.concatenate(texts)

    def link(self, texts: int, costs: list[np.ndarray]) -> None:
        """Build the automaton from the counts; `texts` is how often a text's start was seen, `costs` are the log10
        weights of the failure arcs by length of the context, which also count n-grams that are not sent."""
        number = np.flatnonzero(self.frequent >= 0)  # places of the frequent words, whose numbers start at 1
        count1 = np.concatenate([[texts], self.counts[number]]).astype(float)
        self.first = first = np.cumsum([1, len(count1), *(len(g) for g in self.grams)])
        states = int(first[ORDER - 1])
        self.fail, self.cost = np.zeros(states, np.int64), np.zeros(states)
        arcs, weight, target = [], [], []
        below_counts = count1  # of the n-grams one shorter
        last_word, suffix_of = np.arange(len(count1)), np.zeros(len(count1), np.int64)
        for k, (keys, counts) in enumerate(zip(self.grams, self.gram_counts)):
            before, word = keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)
            held = np.maximum(counts - 0.5, 0.25)
            logs = np.log10(held / below_counts[before])
            # The same n-gram without its first word: the word itself, or a shorter n-gram that is at least as frequent.
            suffix = word if k == 0 else places(self.grams[k - 1], (last_word[before] if k == 1 else suffix_of[before]) << WORD_BITS | word)
            self.cost[first[k] + np.arange(len(below_counts))] = costs[k]
            arcs.append(first[k] + before << WORD_BITS | word)
            weight.append(logs)
            longest = k + 2 == ORDER
            target.append(first[k] + suffix if longest else first[k + 1] + np.arange(len(keys)))
            if not longest:
                self.fail[first[k + 1] + np.arange(len(keys))] = first[k] + suffix
            below_counts, last_word, suffix_of = counts.astype(float), word, suffix
        arcs, weight, target = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (arcs, weight, target))
        order = np.argsort(arcs)
        self.arcs, self.weight, self.target = arcs[order], weight[order], target[order]
        self.cost_all = self.cost.copy()
        at = self.fail.copy()
        for _ in range(ORDER):
            self.cost_all += self.cost[at]
            at = self.fail[at]

    def traverse(self, place: np.ndarray, frequent: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each text without what its unknown words weigh themselves; and for each token the words of the
        longest n-gram that the automaton holds and that ends there.

        Lanes of `LANE` tokens run from left to right, each carrying a state. A lane inside a text first reads the
        tokens before it without counting them: a state knows no more than ORDER - 1 words.
        """
        sizes = np.diff(upto)
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        lo = upto[:-1][owner] + nth * LANE
        hi = np.minimum(lo + LANE, upto[1:][owner])
        order = np.argsort(lo - hi, kind="stable")
        owner, nth, lo, hi = owner[order], nth[order], lo[order], hi[order]
        own_log = np.zeros(len(place))
        known = place >= 0
        own_log[known] = self.word_logs(self.counts[place[known]])
        state = np.where(nth == 0, 1 if len(self.fail) > 1 else 0, 0)
        score, read = np.zeros(len(lo)), np.zeros(len(place), np.int8)
        for step in range(1 - ORDER, LANE):
            at = lo + step
            live = np.flatnonzero((at < hi) & ((step >= 0) | (nth > 0)))
            if not len(live):
                continue
            at = at[live]
            word, s, gained = frequent[at], state[live], own_log[at].copy()
            rare = word < 0
            gained[rare] += self.cost_all[s[rare]]
            s[rare] = 0
            todo = np.flatnonzero(~rare)
            while len(todo):
                arc = self.arc_index.places(mix(s[todo] << WORD_BITS | word[todo]))
                hit = arc >= 0
                done, arc = todo[hit], arc[hit]
                if step >= 0:
                    read[at[done]] = 1 + np.searchsorted(self.first, s[done], side="right")
                gained[done] += self.weight[arc] - own_log[at[done]]
                s[done] = self.target[arc]
                todo = todo[~hit]
                ended = s[todo] == 0
                bottom, todo = todo[ended], todo[~ended]
                s[bottom] = 1 + word[bottom] if len(self.fail) > 1 else 0
                gained[todo] += self.cost[s[todo]]
                s[todo] = self.fail[s[todo]]
            state[live] = s
            if step >= 0:
                score[live] += gained
        return np.bincount(owner, score, len(sizes)), read


def _buckets(spark: SparkSession) -> int:
    """Ranges of hashes that n-grams are dealt out by; they grow with the shuffle partitions and so with the input."""
    return BUCKETS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _dealt(keys: np.ndarray, buckets: int, columns: list[np.ndarray]) -> list[pa.Array]:
    """Numbers of the buckets that sorted keys fall into, and for each one its part of all columns, packed."""
    return _packed(_bucket(keys, buckets), columns)


def _packed(number: np.ndarray, columns: list[np.ndarray]) -> list[pa.Array]:
    """The different ones of sorted numbers, and for each one its part of all columns, one after the other.

    The first bytes of all values come together, then the second ones and so on, and the first column as steps from one
    to the next, so that the many zeros are compressed away on disk.
    """
    ends = np.append(np.flatnonzero(number[1:] != number[:-1]) + 1, len(number))[:len(number)]
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[:len(ends)]
    steps = columns[0].copy()
    steps[1:] -= columns[0][:-1]
    steps[starts] = columns[0][starts]

    def part(column: np.ndarray, lo: int, hi: int) -> bytes:
        return column[lo:hi].view(np.uint8).reshape(hi - lo, -1).T.tobytes()

    return [pa.array(number[starts].astype(np.int32)),
            pa.array([b"".join(part(c, lo, hi) for c in [steps, *columns[1:]]) for lo, hi in zip(starts.tolist(), ends.tolist())], pa.binary())]


def _undealt(parts: list[bytes], types: list[type], keyed: bool) -> list[np.ndarray]:
    """The columns of all parts that `_dealt` made; whether the first one is in steps."""
    sizes = [np.dtype(t).itemsize for t in types]
    out: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in types]
    for part in parts:
        n, at = len(part) // sum(sizes), 0
        for k, (t, size) in enumerate(zip(types, sizes)):
            values = np.frombuffer(part, np.uint8, n * size, at).reshape(size, n).T.copy().view(t).reshape(n)
            out[k].append(np.cumsum(values, dtype=t) if keyed and k == 0 else values)
            at += n * size
    return [np.concatenate(c) for c in out]


def _counted(rows: DataFrame, columns_of, names: list[str], least: int = 1) -> DataFrame:
    """Sum over all texts of what `columns_of` finds in a batch, columns `names` whose `pair` is the hash that tells apart, or
    that hash alone: `key`, those, and `n`, if it is `least` or more.

    Tasks count `PENDING` tokens at a time and send one packed row for each bucket of hashes, sorted by its first column,
    which repeats.
    """
    buckets = _buckets(rows.sparkSession)
    types = [np.uint64] * max(len(names), 1) + [np.uint32]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for found in _pending((columns_of(*tokens(batch.column("text"))) for big in batches for batch in slices(big, "text"))):
            keys = pair(*found) if names else found[0]
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            n = np.diff(first, append=len(keys)).astype(np.uint32)
            keys, order = keys[first], order[first]
            number, columns = _bucket(keys, buckets), [c[order] for c in found]
            found.clear()
            if names:
                order = np.argsort(columns[0])
                order = order[np.argsort(number[order].astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")]
                number, n, columns = number[order], n[order], [c[order] for c in columns]
            yield pa.record_batch(_packed(number, [*columns, n]), ["bucket", "data"])

    def add(table: pa.Table) -> pa.Table:
        *columns, n = _undealt(table["data"].to_pylist(), types, True)
        keys = pair(*columns) if names else columns[0]
        order = np.argsort(keys)
        first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
        n = np.add.reduceat(n[order].astype(np.int64), first)
        first, n = order[first[n >= least]], n[n >= least]
        return pa.table([*(pa.array(c[first].view(np.int64)) for c in ([keys, *columns] if names else [keys])), pa.array(n)], ["key", *names, "n"])

    return (rows.mapInArrow(count, "bucket int, data binary").groupBy("bucket")
            .applyInArrow(add, "key long, " + "".join(f"{c} long, " for c in names) + "n long"))


def _pending(batches: Iterator[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Columns of batches put together until they have `PENDING` rows; none is empty. Who takes them may empty the list."""
    held: list[list[np.ndarray]] = []
    size = 0

    def joined() -> list[np.ndarray]:
        out = [np.concatenate(c) for c in zip(*held)]
        held.clear()  # before they are worked on, or they are in memory twice
        return out

    for batch in batches:
        if len(batch[0]):
            held.append(batch)
            size += len(batch[0])
        del batch
        if size >= PENDING:
            yield joined()
            size = 0
    if held:
        yield joined()


def _costs(grams: DataFrame) -> DataFrame:
    """log10 weight of the failure arc of each context (`a`, `cost`): what its n-grams leave over, by what they would
    have a word shorter (`log`, `low`)."""
    left = lambda log: F.greatest(1 - F.sum(F.pow(F.lit(10.0), log)), F.lit(1e-9))
    return grams.groupBy("a").agg(F.log10(left("log") / left("low")).alias("cost"))


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits at the hashes of all keys, merged by the executors in blocks: of the same size for any number of keys."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for found, in _pending([batch.column("key").to_numpy().view(np.uint64)] for batch in batches):
            bit = np.unique((found & np.uint64(FILTER_BITS - 1)).astype(np.uint32))
            yield pa.record_batch(_packed(bit // np.uint32(FILTER_BITS // FILTER_BLOCKS), [bit]), ["block", "data"])

    def merged(table: pa.Table) -> pa.Table:
        block, held = table["block"][0].as_py(), np.zeros(FILTER_BITS // FILTER_BLOCKS, bool)
        for data in table["data"].to_pylist():
            held[_undealt([data], [np.uint32], True)[0] - np.uint32(block * len(held))] = True
        return pa.table([pa.array([block], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], ["block", "data"])

    with shuffles_removed(keys.sparkSession):
        found = keys.mapInArrow(dealt, "block int, data binary").groupBy("block").applyInArrow(merged, "block int, data binary").toArrow()
    out = np.zeros((FILTER_BLOCKS, FILTER_BITS // FILTER_BLOCKS // 64), "<u8")
    for block, data in zip(found["block"].to_pylist(), found["data"].to_pylist()):
        out[block] = np.frombuffer(data, "<u8")
    return out.reshape(-1)


def learn(training: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model and the stored table of all words (`key`, `n`, `gain`), from all texts of `training`; the model's
    `longer` is the table of all n-grams that occur `LEAST` times.

    A text's log10 probability is the sum of what its n-grams gain. A word gains its own weight and that of its failure
    arc; a longer n-gram what it weighs more than the way round by the failure arc before it, and its own failure
    arc. So each n-gram can be looked up by itself, in the automaton or in the tables.
    """
    small_batches(training.sparkSession)
    rows = training.select(text_of(text_col).alias("text"))
    words = stored(_counted(rows, lambda words, upto: [words], []), "words")
    total, kinds, once, texts = words.agg(F.sum("n"), F.count("*"), F.sum((F.col("n") == 1).cast("long")),
                                          F.sum(F.when(F.col("key") == int(END), F.col("n")))).first()
    total, once, texts = int(total or 0), int(once or 0), int(texts or 1)
    least = max(LEAST, int(np.ceil(total * GRAM_SHARE)))
    discount = min(0.75, max(once, 1) / (kinds + 1))
    own = F.log10((F.col("n") - F.lit(discount)) / F.lit(float(max(total, 1))))
    words = words.withColumn("log", own)
    spark = training.sparkSession
    starts = spark.createDataFrame([(int(START), texts, 0.0)], "key long, n long, log double")
    below = words.where(F.col("n") >= LEAST).unionByName(starts)
    found, arcs = [], []
    for size in range(2, ORDER + 1):
        shared = spark.sparkContext.broadcast(_filter(below.select("key")))

        def columns_of(words: np.ndarray, upto: np.ndarray, size: int = size, shared: Broadcast = shared) -> list[np.ndarray]:
            a, b = grams(words, upto, size)  # both shorter n-grams occur as often as this one at least
            may = passes(shared.value, a) & passes(shared.value, b)
            return [x[may] for x in (a, b)]

        counts = stored(_counted(rows, columns_of, ["a", "b"], LEAST), "counts")
        known = (counts.join(below.select(F.col("key").alias("a"), F.col("n").alias("all")), "a")
                 .join(below.select(F.col("key").alias("b"), F.col("log").alias("low")), "b")
                 .select("key", "a", "b", "n", F.log10((F.col("n") - 0.5) / F.col("all")).alias("log"), "low"))
        known = stored(known, "known")
        removed(counts)
        shared.destroy()  # its file would stay on every machine
        found.append(known)
        arcs.append(stored(_costs(known), "costs"))
        below = known.select("key", "n", "log")
    none = F.lit(0.0)
    leads = [*(c.select(F.col("a").alias("key"), F.col("cost").alias("on")) for c in arcs), None]

    def leading(table: DataFrame, k: int) -> DataFrame:
        return table.withColumn("on", none) if leads[k] is None else table.join(leads[k], "key", "left").withColumn("on", F.coalesce("on", none))

    levels = [stored(leading(words, 0), "leading")]
    gains = levels[0].select("key", "n", (F.col("log") + F.col("on")).alias("gain"))
    longer = []
    for k, known in enumerate(found):
        rare = F.col("n") < least
        levels.append(stored(leading(known.join(arcs[k], "a"), k + 1).select(
            "key", (F.col("log") - F.col("low") - F.col("cost") + F.col("on")).alias("gain"),
            *(F.when(~rare, F.col(c)).alias(c) for c in ("a", "b", "n", "on"))), "leading"))
        longer.append(levels[-1].select("key", "gain"))

    def few(level: DataFrame, *columns: str) -> list[np.ndarray]:
        rows = level.where(F.col("n") >= least).select(*columns).toArrow()
        return [rows[c].to_numpy() for c in columns]

    keys, n, on = few(levels[0], "key", "n", "on")
    order = np.argsort(keys.view(np.uint64))
    hashes, n, on = keys.view(np.uint64)[order], n[order], on[order]
    model = Model(total, kinds, discount, hashes, n, np.arange(1, len(n) + 1), [], [])
    start = arcs[0].where(F.col("a") == int(START)).first()
    removed(words, *found, *arcs)  # all that is read later is in the levels
    costs = [np.concatenate([[start["cost"] if start else 0.0], on])]
    numbers = np.concatenate([[0], np.arange(1, len(n) + 1)])  # of the contexts `hashes`, the start before the words
    hashes = np.concatenate([[START], hashes]).astype(np.uint64)
    last = numbers
    for level in levels[1:]:
        key, a, b, n, on = few(level, "key", "a", "b", "n", "on")
        key, a, b = (x.view(np.uint64) for x in (key, a, b))
        sort = np.argsort(hashes)
        of = lambda x: numbers[sort][places(hashes[sort], x)]
        before, word = of(a), last[sort][places(hashes[sort], b)]
        packed = before << WORD_BITS | word
        order = np.argsort(packed)
        model.grams.append(packed[order])
        model.gram_counts.append(n[order])
        costs.append(on[order])
        hashes, last, numbers = key[order], word[order], np.arange(len(order))
    model.longer = reduce(DataFrame.unionByName, longer)
    model.seen = _filter(model.longer.select("key"))
    model.link(texts, costs)
    return model, gains


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` for every row of `docs`.

    The automaton of the frequent words and n-grams goes to every task, bounded by their share of all tokens. The
    others take their counts and gains from the stored table: their hashes are packed by bucket and meet the bucket's
    part of the table, and what they gain is summed per row.

    Null texts count as empty: one token, the end. Null ids and repeated rows are scored as rows of their own; an
    empty table gives an empty result; without training text every word is unseen and weighs nothing. Columns of
    `docs` other than id and text are ignored.
    """
    spark = docs.sparkSession
    shared, buckets, size = spark.sparkContext.broadcast(model), _buckets(spark), float(model.total + model.kinds + 1)
    small_batches(spark)
    names = ["bucket", "data", "batch", "row", "id", "n_tokens", "known", "base", "gained", "unseen"]
    answer = [np.uint32, np.int64, float, float]  # row in its batch, words known, their base score, what all n-grams gain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        tool, told = shared.value, []

        def looked_up() -> Iterator[list[np.ndarray]]:
            for big in batches:
                for batch in slices(big, "text"):
                    words, upto = tokens(batch.column("text"))
                    place, numbers = tool.numbers(words, upto)
                    rows, n = batch.column("row").to_numpy(), len(batch)
                    owner = np.repeat(np.arange(n), np.diff(upto))
                    known = place >= 0
                    base = np.zeros(len(words))
                    base[known] = tool.base_logs(tool.counts[place[known]])
                    gained, read = tool.traverse(place, numbers, upto)
                    told.append([batch.column("row"), batch.column("id"), pa.array(np.diff(upto)), pa.array(np.bincount(owner, known, n).astype(np.int64)),
                                 pa.array(np.bincount(owner, base, n)), pa.array(gained), pa.array(np.bincount(owner, ~known, n).astype(np.int64))])
                    longer, whose = tool.missed(words, upto, owner, read)
                    yield [np.concatenate([words[~known], longer]), rows[np.concatenate([owner[~known], whose])]]

        def own(first: int) -> Iterator[pa.RecordBatch]:
            for columns in told:
                n, number = len(columns[0]), _bucket(mix(columns[0].to_numpy()), buckets).astype(np.int32)
                yield pa.record_batch([pa.array(number), pa.nulls(n, pa.binary()), pa.array(np.full(n, first)), *columns], names)

        for keys, rows in _pending(looked_up()):
            first, blank = told[0][0][0].as_py(), [c.type for c in told[0]]  # rows of a task are numbered one after the other
            yield from own(first)
            told.clear()
            order = np.argsort(keys)
            number, data = _dealt(keys := keys[order], buckets, [keys, (rows[order] - first).astype(np.uint32)])
            yield pa.record_batch([number, data, pa.array(np.full(len(number), first)), *(pa.nulls(len(number), t) for t in blank)], names)
        if told:
            yield from own(told[0][0][0].as_py())

    def dealt_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for keys, n, gain in _pending([batch.column("key").to_numpy().view(np.uint64), pc.fill_null(batch.column("n"), 0).to_numpy(),
                                       batch.column("gain").to_numpy()] for batch in batches):
            order = np.argsort(keys)
            yield pa.record_batch(_dealt(keys := keys[order], buckets, [keys, n[order], gain[order]]), names[:2])

    def look_up(table: pa.Table) -> pa.Table:
        """The rows, and for each batch that asks the bucket, packed: its rows that the tables add to, how many words they know
        and what these and longer n-grams gain."""
        packed, asks = pc.is_valid(table["data"]), pc.is_valid(table["batch"])
        held, n, gain = _undealt(table.filter(pc.and_not(packed, asks))["data"].to_pylist(), [np.uint64, np.int64, float], True)
        order = np.argsort(held)
        held = held[order]
        asked, answers = table.filter(pc.and_(packed, asks)), []
        for data in asked["data"].to_pylist():
            keys, rows = _undealt([data], [np.uint64, np.uint32], True)
            at = places(held, keys)
            at, rows = order[at[at >= 0]], rows[at >= 0]
            count, found = n[at], np.flatnonzero(np.bincount(rows))
            word = count > 0
            sums = [np.bincount(rows, x)[found] for x in (word, np.where(word, np.log10((count + 1) / size), 0.0), gain[at])]
            part = _packed(np.zeros(len(found), np.int64), [c.astype(t) for c, t in zip((found, *sums), answer)])[1]
            answers.append(part[0].as_py() if len(part) else b"")
        answers = pa.array(answers, pa.binary())
        told = table.filter(pc.invert(packed))
        return pa.concat_tables([told, asked.set_column(1, "data", answers).cast(told.schema)]).drop_columns("bucket")

    def summed(table: pa.Table) -> pa.Table:
        """The rows of a batch, with what all buckets add to them."""
        packed = pc.is_valid(table["data"])
        rows, *added = _undealt(table.filter(packed)["data"].to_pylist(), answer, True)
        told = table.filter(pc.invert(packed))
        at = told["row"].to_numpy() - table["batch"][0].as_py()
        order = np.argsort(at)
        place = order[np.searchsorted(at[order], rows)]
        out = [np.bincount(place, x, len(at)).astype(x.dtype) for x in added]
        return pa.table([*(told[c] for c in names[4:]), *map(pa.array, out)], [*names[4:], "rest_known", "rest_base", "rest_gain"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    kind = rows.schema["id"].dataType.simpleString()
    columns = f"id {kind}, n_tokens long, known long, base double, gained double, unseen long"
    asked = rows.mapInArrow(run, f"bucket int, data binary, batch long, row long, {columns}")
    gains = counts.unionByName(model.longer.withColumn("n", F.lit(None).cast("long"))).select("key", "n", "gain")
    both = asked.unionByName(gains.mapInArrow(dealt_gains, "bucket int, data binary"), allowMissingColumns=True)
    told = both.groupBy("bucket").applyInArrow(look_up, f"data binary, batch long, row long, {columns}")
    sums = told.groupBy("batch").applyInArrow(summed, f"{columns}, rest_known long, rest_base double, rest_gain double")
    unseen = F.col("unseen") - F.col("rest_known")
    return sums.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.col("rest_known")).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rest_base") + unseen * F.lit(float(-np.log10(size)))).alias("base_score"),
        (F.col("gained") + F.col("rest_gain") + unseen * F.lit(float(np.log10(model.unseen())))).alias("score"))
