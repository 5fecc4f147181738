"""Byte-level BPE over Arrow batches: a memory-mapped lexicon automaton for frequent words, exact merges for the rest."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import distinct, ranges, resident, stored, text_of, tile_hashes

#: Classes of characters by which text is split before merging.
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Code points of Unicode's White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Endings that an apostrophe starts.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: The lexicon keeps words that make up at least one in so many of all words, and so at most so many.
LEXICON_WORDS = 65_536
#: Words of the rest whose ids a task remembers; the memory is emptied beyond that.
REMEMBERED = 300_000
#: Words of more bytes are merged one by one with a heap.
LONG = 48
TWO_WORDS = "two words have one 64-bit hash"


@lru_cache(1)
def char_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            table[point] = LETTER if kind == "L" else NUMBER
    table[WHITE] = SPACE
    return table


def word_starts(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where words start in joined texts that begin at `edges`: contractions, runs of letters, of numbers and of
    other marks, each with the one space before it, and the white space left over."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    first = np.zeros(n + 1, bool)
    first[edges] = True
    first[n] = True
    space = kind == SPACE
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    after = np.empty(n, bool)  # the next character, of the same text, is not white
    after[-1], after[:-1] = False, ~space[1:]
    after &= ~first[1:]
    begin = first[:n]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 0x20
    start = begin | np.where(space, (before != SPACE) | after, (before != kind) & ~blank_before)
    marks = np.flatnonzero(start & (points == 0x27))
    if len(marks):
        limit = np.append(np.flatnonzero(first), n)
        ends = limit[np.searchsorted(limit, marks, side="right")]
        open_ = np.ones(len(marks), bool)
        for ending in ENDINGS:
            size = len(ending)
            fits = open_ & (marks + size < ends)
            for i, letter in enumerate(ending):
                fits &= points[np.minimum(marks + 1 + i, n - 1)] == ord(letter)
            hit = marks[fits]
            start[hit + 1] = False
            beyond = hit + 1 + size
            start[beyond[beyond < n]] = True
            open_ &= ~fits
    return np.flatnonzero(start)


class Vocabulary:
    """Merges and ids of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        # Bytes are written as printable characters: those that are printable themselves, the rest from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        of_char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.token_bytes = {i: bytes(of_char[c] for c in token) for token, i in model["vocab"].items() if token not in self.special}
        self.token_bytes |= {i: token.encode() for token, i in self.special.items()}
        ids = model["vocab"]
        self.of_byte = np.array([ids[c] for c, _ in sorted(of_char.items(), key=lambda x: x[1])], np.int64)
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.rank = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right))}
        self._table(left << 20 | right)

    def _table(self, keys: np.ndarray) -> None:
        """Open addressing: slot -> key and rank, with a bounded number of probes."""
        self.mask = (1 << (int(4 * len(keys)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, len(keys), np.int32)
        slots, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slots[todo]] < 0]
            _, at = np.unique(slots[free], return_index=True)
            won = free[at]
            self.keys[slots[won]], self.ranks[slots[won]] = keys[won], won
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges if there is none."""
        shape = left.shape
        keys = np.where(right < 0, -2, left << 20 | right).ravel()  # no slot holds -2
        slots = self._slot(keys)
        found = self.ranks[slots]
        miss = np.flatnonzero(self.keys[slots] != keys)
        found[miss] = len(self.made)
        for _ in range(self.probes - 1):
            miss = miss[self.keys[slots[miss]] >= 0]
            if not len(miss):
                break
            slots[miss] = (slots[miss] + 1) & self.mask
            hit = self.keys[slots[miss]] == keys[miss]
            found[miss[hit]] = self.ranks[slots[miss[hit]]]
            miss = miss[~hit]
        return found.reshape(shape)

    def merge_long(self, word: bytes) -> list[int]:
        """Merges of one word: the lowest rank first, the leftmost of equals, by a heap over a linked list."""
        ids = [int(self.of_byte[b]) for b in word]
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := self.rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(self.made[rank]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.rank.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:start+size], one after the other, and how many each has.

        Words of like size step together, a merge each.
        """
        counts = np.zeros(len(starts), np.int64)
        found = []
        for lo, hi in ((0, 6), (6, 9), (9, 13), (13, 20), (20, LONG)):
            rows = np.flatnonzero((sizes > lo) & (sizes <= hi))
            if not len(rows):
                continue
            place = starts[rows][:, None] + np.arange(hi)
            ids = self.of_byte[data[np.minimum(place, len(data) - 1)]]
            ids[np.arange(hi) >= sizes[rows][:, None]] = -1
            live, part, width = np.arange(len(rows)), ids.copy(), hi
            while len(live) and width > 1:
                ranks = self.ranks_of(part[:, :-1], part[:, 1:])
                at = ranks.argmin(1)
                best = ranks[np.arange(len(live)), at]
                go = best < len(self.made)
                ids[live[~go], :width] = part[~go]
                ids[live[~go], width:] = -1
                live, part, at, best = live[go], part[go], at[go], best[go]
                moved = part[:, 1:].copy()  # what stands behind the merged pair moves up by one
                part = np.where(np.arange(width - 1) > at[:, None], moved, part[:, :-1])
                part[np.arange(len(live)), at] = self.made[best]
                width -= 1
            ids[live, :width] = part
            ids[live, width:] = -1
            counts[rows] = (ids >= 0).sum(1)
            found.append((rows, ids[ids >= 0]))
        for i in np.flatnonzero(sizes > LONG).tolist():
            own = np.array(self.merge_long(data[starts[i]:starts[i] + sizes[i]].tobytes()), np.int64)
            counts[i] = len(own)
            found.append((np.array([i]), own))
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for rows, ids in found:
            flat[ranges(begin[rows], counts[rows])] = ids
        return flat, counts


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lexicon:
    """Minimal acyclic automaton of words over bytes, every arc with the number of words before it, so that the sum
    along a word's path is its place in the sorted list; the ids are listed in that order. Read from a mapped file."""

    HEAD = 6  # numbers at the start of the file

    def __init__(self, path: str) -> None:
        held = np.memmap(path, np.int32, "r")
        states, kinds, words, tokens = (int(x) for x in held[:4])
        at = self.HEAD

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return held[at - n:at]

        self.kind_of, self.final = take(256), take(states)
        self.kinds = kinds
        self.arcs, self.skip = take(states * kinds), take(states * kinds)
        self.begin, self.ids = take(words + 1), take(tokens)

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Place of each word data[start:start+length] in the lexicon, or -1; all words walk together."""
        place = np.full(len(starts), -1, np.int64)
        live = np.flatnonzero(lengths > 0)
        state, total = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            kind = self.kind_of[data[starts[live] + step]].astype(np.int64)
            arc = state * self.kinds + kind
            state = np.where(kind >= 0, self.arcs[arc], -1)
            total = total + self.skip[arc]
            step += 1
            on = state >= 0
            live, state, total = live[on], state[on].astype(np.int64), total[on]
            done = lengths[live] == step
            ended = done & (self.final[state] > 0)
            place[live[ended]] = total[ended]
            live, state, total = live[~done], state[~done], total[~done]
        return place


def build_lexicon(words: list[bytes], vocab: Vocabulary, path: str) -> None:
    """Compile sorted distinct words: states are made unique from the back while the next word is added."""
    kinds = sorted({b for w in words for b in w})
    kind_of = np.full(256, -1, np.int32)
    kind_of[kinds] = np.arange(len(kinds))
    register: dict[tuple, int] = {}
    arcs: list[dict[int, int]] = []
    finals: list[bool] = []
    path_now: list[tuple[dict[int, int], list[bool]]] = [({}, [False])]

    def settle(depth: int) -> None:
        """Replace the states of the last word below `depth` by equal ones that exist."""
        while len(path_now) > depth + 1:
            out, final = path_now.pop()
            key = (final[0], *out.items())
            if key not in register:
                register[key] = len(arcs)
                arcs.append(out)
                finals.append(final[0])
            path_now[-1][0][last[len(path_now) - 1]] = register[key]

    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        settle(same)
        for b in word[same:]:
            path_now[-1][0][b] = -1
            path_now.append(({}, [False]))
        path_now[-1][1][0] = True
        last = word
    settle(0)
    root, final = path_now[0]
    arcs.append(root)
    finals.append(final[0])
    order = [len(arcs) - 1, *range(len(arcs) - 1)]  # the root first
    new = {old: i for i, old in enumerate(order)}
    count = [0] * len(arcs)  # words below a state; children come before parents
    table = np.full((len(arcs), len(kinds)), -1, np.int32)
    skip = np.zeros((len(arcs), len(kinds)), np.int32)
    for old, out in enumerate(arcs):
        total = int(finals[old])
        for b in sorted(out):
            table[new[old], kind_of[b]], skip[new[old], kind_of[b]] = new[out[b]], total
            total += count[out[b]]
        count[old] = total
    sizes = np.array([len(w) for w in words], np.int64)
    ids, counts = vocab.merge(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    begin = np.concatenate([[0], np.cumsum(counts)])
    parts = [np.array([len(arcs), len(kinds), len(words), len(ids), 0, 0]), kind_of, np.array(finals)[order], table.ravel(), skip.ravel(), begin, ids]
    with open(path, "wb") as f:
        for part in parts:
            f.write(part.astype(np.int32).tobytes())


def utf8_of(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of joined words given by their characters; where each word starts and how many bytes it has."""
    if not len(sizes):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    lengths = np.add.reduceat(width, np.cumsum(sizes) - sizes)
    return data, np.cumsum(lengths) - lengths, lengths


class Encoder:
    """Encodes batches of texts; `lexicon` may be None."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None) -> None:
        self.vocab, self.lexicon = vocab, lexicon
        self._forget()

    def _forget(self) -> None:
        """Remembered words: sorted hashes with their places, and by place the characters and the ids."""
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.chars, self.char_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.ids, self.id_at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each hash among the remembered words, or -1."""
        if not len(self.hashes):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
        return np.where(self.hashes[at] == keys, self.place[at], -1)

    def _learn(self, keys: np.ndarray, points: np.ndarray, sizes: np.ndarray) -> None:
        """Remember words that were not known, given as joined characters."""
        data, starts, lengths = utf8_of(points, sizes)
        ids, counts = self.vocab.merge(data, starts, lengths)
        order = np.argsort(keys)
        where = np.searchsorted(self.hashes, keys[order])
        self.hashes = np.insert(self.hashes, where, keys[order])
        self.place = np.insert(self.place, where, len(self.id_at) - 1 + order)
        self.chars, self.ids = np.concatenate([self.chars, points]), np.concatenate([self.ids, ids])
        self.char_at = np.concatenate([self.char_at, self.char_at[-1] + np.cumsum(sizes)])
        self.id_at = np.concatenate([self.id_at, self.id_at[-1] + np.cumsum(counts)])

    def _ids_of(self, keys: np.ndarray, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A list of ids, and for each distinct word where its ids start in it and how many there are."""
        begin, counts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        rest, before = np.arange(len(keys)), np.zeros(0, np.int32)
        if self.lexicon is not None:
            place = self.lexicon.find(*utf8_of(points, sizes))
            hit, rest, before = np.flatnonzero(place >= 0), np.flatnonzero(place < 0), self.lexicon.ids
            begin[hit] = self.lexicon.begin[place[hit]]
            counts[hit] = self.lexicon.begin[place[hit] + 1] - begin[hit]
        if len(self.hashes) > REMEMBERED:
            self._forget()
        at = np.cumsum(sizes) - sizes
        known = self._find(keys[rest])
        new = rest[known < 0]
        if len(new):
            self._learn(keys[new], points[ranges(at[new], sizes[new])], sizes[new])
        old, place = rest[known >= 0], known[known >= 0]
        if (self.char_at[place + 1] - self.char_at[place] != sizes[old]).any() or (
                self.chars[ranges(self.char_at[place], sizes[old])] != points[ranges(at[old], sizes[old])]).any():
            raise ValueError(TWO_WORDS)
        own = self._find(keys[rest])
        begin[rest], counts[rest] = self.id_at[own] + len(before), self.id_at[own + 1] - self.id_at[own]
        return np.concatenate([before, self.ids]), begin, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text starts among them (one number more than texts)."""
        joined = "".join(texts)
        special = [s for s in self.vocab.special if s in joined]
        if special:
            return self._with_special(texts, special[0])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = word_starts(points, edges[:-1][sizes > 0])
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        lengths = np.append(starts[1:], len(points)) - starts
        keys = tile_hashes(points, starts, lengths)
        at, which = distinct(keys)
        self._check(points, starts, lengths, at[which])
        ids, begin, counts = self._ids_of(keys[at], points[ranges(starts[at], lengths[at])], lengths[at])
        tokens = counts[which]
        flat = ids[ranges(begin[which], tokens)]
        upto = np.concatenate([[0], np.cumsum(tokens)])
        return flat, upto[np.searchsorted(starts, edges)]

    @staticmethod
    def _check(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: np.ndarray) -> None:
        """Compare every word with the one that stands for its hash."""
        there = np.arange(len(points), dtype=np.int32) + np.repeat((starts[model] - starts).astype(np.int32), lengths)
        if (lengths[model] != lengths).any() or (points[np.minimum(there, len(points) - 1)] != points).any():
            raise ValueError(TWO_WORDS)

    def _with_special(self, texts: list[str], token: str) -> tuple[np.ndarray, np.ndarray]:
        """Texts are cut at the special token, which becomes its id, and joined again."""
        cut = [t.split(token) for t in texts]
        flat, at = self.encode([piece for pieces in cut for piece in pieces])
        own = np.array([self.vocab.special[token]], np.int32)
        parts, sizes, k = [], [], 0
        for pieces in cut:
            size = 0
            for i in range(len(pieces)):
                got = [own] * (i > 0) + [flat[at[k]:at[k + 1]]]
                parts += got
                size += sum(map(len, got))
                k += 1
            sizes.append(size)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def encoder(vocab_path: str, lexicon_file: str | None = None) -> Encoder:
    """The worker's encoder; `lexicon_file` is a name that `ship_lexicon` gave."""
    return resident(("encoder", vocab_path, lexicon_file), lambda: Encoder(
        Vocabulary(vocab_path), Lexicon(SparkFiles.get(lexicon_file)) if lexicon_file else None))


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about `limit` bytes of text, or one row."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    at = 0
    while at < len(sizes):
        upto = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:at + 4096]), limit, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each word (before merging) stands in all texts; special tokens count as text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text"):
                texts = texts_of(batch.column("text"))
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                edges = np.concatenate([[0], np.cumsum(sizes)])
                joined = "".join(texts)
                points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
                starts = word_starts(points, edges[:-1][sizes > 0])
                if not len(starts):
                    continue
                ends = np.append(starts[1:], len(points))
                at, which = distinct(tile_hashes(points, starts, ends - starts))
                words = [joined[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
                yield pa.record_batch([pa.array(words, pa.string()), pa.array(np.bincount(which), pa.int64())], ["word", "n"])

    rows = docs.select(text_of(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def ship_lexicon(docs: DataFrame, vocab_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all documents and give every executor the file; returns its name.

    Frequent is a word that makes up at least one in `words` of all, so at most `words` words come to the driver
    whatever the documents hold, each of at most 255 bytes, and no task sends others.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs, text_col).where(F.octet_length("word").between(1, 255)), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = sorted(row.word.encode() for row in counts.where(F.col("n") * words >= total).select("word").collect())
    name = f"lexicon-{uuid4().hex}"  # Spark takes a name once
    made = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    build_lexicon(found, vocabulary(vocab_path), made)
    spark.sparkContext.addFile(made)
    return name


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                     words: int = LEXICON_WORDS) -> DataFrame:
    """Encode every text and decode its ids again: id, `n_tokens`, `ids_sha256` (decimal ids joined by commas),
    `decoded_sha256`.

    The frequent words of all documents become a minimal acyclic automaton with ids, mapped into memory by every
    task; words outside it are merged exactly. Null texts count as empty (no ids); null ids, repeated rows and
    further columns are kept apart as rows; an empty table gives an empty result.
    """
    name = ship_lexicon(docs, vocab_path, text_col, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocab_path, name)
        size = max(tool.vocab.token_bytes) + 1
        spelled = [str(i).encode() for i in range(size)]
        spoken = [tool.vocab.token_bytes.get(i, b"") for i in range(size)]
        for big in batches:
            for batch in slices(big, "text"):
                flat, at = tool.encode(texts_of(batch.column("text")))
                ids, upto = flat.tolist(), at.tolist()
                told, back = [], []
                for lo, hi in zip(upto, upto[1:]):
                    own = ids[lo:hi]
                    told.append(hashlib.sha256(b",".join(map(spelled.__getitem__, own))).hexdigest())
                    text = b"".join(map(spoken.__getitem__, own)).decode("utf-8", "replace")
                    back.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.record_batch([batch.column("id"), pa.array(np.diff(at), pa.int64()), pa.array(told, pa.string()), pa.array(back, pa.string())],
                                      ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
