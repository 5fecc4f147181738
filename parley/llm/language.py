"""Language identification by cross-parsing: the language whose text needs the fewest phrases to write a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from parley.llm.bpe import LETTER, char_classes, slices, texts_of
from parley.llm.common import resident, small_batches, text_of

#: Bounds of each language's labelled sample: documents, characters of each document, letters.
DOCUMENTS, DOCUMENT_CHARS, LETTERS = 100, 2_000, 26_000
#: Letters of a language that have a column of their own, and the entries of such tables together; the ways of all
#: other letters of the sample are looked up in a sorted list, with the same outcome.
COLUMNS, ENTRIES = 94, 32 << 20
#: Letters that are parsed in one go; a phrase ends where such a block ends.
BLOCK = 1_024
#: Bits that halve the doubt about a prediction.
DOUBT_BITS = 16.0
UNDETERMINED = "und"


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, every run of other characters as one 0, and where each text starts."""
    lower = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower))
    points = np.frombuffer("".join(lower).encode("utf-32-le"), np.uint32)
    points = np.where(char_classes()[points] == LETTER, points, 0)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    keep = points > 0
    keep[1:] |= points[:-1] > 0
    upto = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], upto[edges]


def transitions(text: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Suffix automaton of coded letters: the number of states, and of each way its state, letter and target."""
    ways: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        new = len(ways)
        ways.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in ways[p]:
            ways[p][c] = new
            p = link[p]
        if p >= 0:
            q = ways[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(ways)
                ways.append(dict(ways[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and ways[p].get(c) == q:
                    ways[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    sizes = np.fromiter(map(len, ways), np.int64, len(ways))
    n = int(sizes.sum())
    letter = np.fromiter((c for way in ways for c in way), np.int64, n)
    target = np.fromiter((t for way in ways for t in way.values()), np.int32, n)
    return len(ways), np.repeat(np.arange(len(ways)), sizes), letter, target


def tabled(states: int, state: np.ndarray, letter: np.ndarray, target: np.ndarray, kinds: int) -> np.ndarray:
    """The ways by letters below `kinds` as a table [state, letter].

    A walk follows the longest match. Where a letter doesn't continue it, the entry is the complement (below 0) of
    the state at which the next phrase begins with that letter; code `kinds` leaves the state as it is.
    """
    table = np.full((states, kinds + 1), -1, np.int32)
    own = letter < kinds
    table[state[own], letter[own]] = target[own]
    again = ~np.maximum(table[0], 0)
    table = np.where(table < 0, again, table)
    table[:, kinds] = np.arange(states)
    return np.ascontiguousarray(table, np.int32)


def automaton(text: np.ndarray, kinds: int) -> np.ndarray:
    """Suffix automaton of coded letters as a table of all of them."""
    return tabled(*transitions(text), kinds)


class Language:
    """The automaton of one sample: columns for frequent letters, a sorted list for the others, every letter in it."""

    def __init__(self, text: np.ndarray, alphabet: np.ndarray, columns: int) -> None:
        """`alphabet` holds the letters of all languages."""
        found, at, n = np.unique(text, return_inverse=True, return_counts=True)
        rank = np.empty(len(found), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(found))
        states, state, letter, target = transitions(rank[at])
        self.columns = min(columns, len(found))  # the column after them: a letter that isn't in the sample
        self.code = np.full(len(alphabet) + 1, self.columns, np.int32)
        self.code[np.searchsorted(alphabet, found)] = np.where(rank < self.columns, rank, rank + 1)
        self.kinds = len(found) + 1
        few = letter < self.columns
        table = tabled(states, state[few], letter[few], target[few], self.columns + 1)
        self.flat, self.width = table.ravel(), table.shape[1]
        keys = state[~few] * self.kinds + letter[~few] + 1
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], target[~few][order]

    def step(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next state of each walk, or the complement of the state at which a new phrase begins."""
        if not len(self.keys):
            return self.flat[state * self.width + codes]
        found = self.flat[state * self.width + np.minimum(codes, self.columns)]
        rare = np.flatnonzero(codes > self.columns)
        if len(rare):
            code = codes[rare].astype(np.int64)
            keys = state[rare] * self.kinds + code
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            begin = self.targets[np.searchsorted(self.keys, code)]  # from state 0, which every letter leaves
            found[rare] = np.where(self.keys[at] == keys, self.targets[at], ~begin)
        return found


class Parser:
    """Counts the phrases of texts against each language."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        text = {lang: letters(samples[lang])[0][:LETTERS] for lang in self.languages}
        self.alphabet = np.unique(np.concatenate([*text.values(), np.zeros(1, np.uint32)]))
        self.code = np.full(0x110000, len(self.alphabet), np.int32)
        self.code[self.alphabet] = np.arange(len(self.alphabet))
        columns = max(0, min(COLUMNS, ENTRIES // (2 * sum(map(len, text.values())) + len(text)) - 2))
        self.tables = [Language(text[lang], self.alphabet, columns) for lang in self.languages]
        self.phrase_bits = np.array([np.log2(len(text[lang]) + 2) for lang in self.languages])

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits to point at all phrases of each text in each language, and the number of its letters and gaps."""
        points, at = letters(texts)
        sizes = np.diff(at)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        lo = at[:-1][owner] + nth * BLOCK
        size = np.minimum(at[1:][owner] - lo, BLOCK)
        order = np.argsort(-size, kind="stable")  # the longest first, so that a step only has the blocks that go on
        owner, lo, size = owner[order], lo[order], size[order]
        letter = self.code[points]
        live = np.searchsorted(-size, -np.arange(BLOCK), side="left")  # blocks with more than so many letters
        phrases = np.ones((len(self.languages), len(owner)), np.int32)
        for row, table in zip(phrases, self.tables):
            codes = table.code[letter]
            state = np.zeros(len(owner), np.int64)
            for step in range(int(size[0]) if len(size) else 0):
                n = live[step]
                found = table.step(state[:n], codes[lo[:n] + step])
                miss = found >> 31
                row[:n] -= miss
                state[:n] = found ^ miss
        out = np.zeros((len(texts), len(self.languages)))
        for k, row in enumerate(phrases):
            out[:, k] = np.bincount(owner, row, len(texts)) * self.phrase_bits[k]
        return out, sizes


def _parser(samples: tuple) -> Parser:
    """The worker's parser."""
    return resident(("parser", samples), lambda: Parser({lang: list(texts) for lang, texts in samples}))


def sample(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple:
    """Texts of every language: `DOCUMENTS` different texts in the order of a hash of the text alone.

    Copies count once, so a group of a third of all rows is one text of the sample. Hashes are made distinct and ranked
    before the texts, at most `DOCUMENTS` for each language, are fetched; the ranks are limited before the shuffle.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.xxhash64(text_of(text_col)).alias("at"),
                           F.substring(text_of(text_col), 1, DOCUMENT_CHARS).alias("text")).where("lang is not null")
    few = rows.select("lang", "at").distinct()
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("at"))).where(F.col("rank") <= DOCUMENTS)
    texts = rows.join(F.broadcast(few), ["lang", "at"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    found: dict[str, list[str]] = {}
    for row in texts.orderBy("lang", "rank").collect():
        found.setdefault(row.lang, []).append(row.text)
    return tuple((lang, tuple(texts)) for lang, texts in sorted(found.items()))


def identify(docs: DataFrame, samples: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` and `lang_pred`, `score`, `bits_per_letter`.

    Every whole text is parsed, left to right, into the longest phrases that occur in a language's sample; a suffix
    automaton of the sample finds them. A phrase costs the bits to point into the sample, so samples of different
    sizes compare; the cheapest language wins, the first by name on a tie. `score` is its share of the likelihood
    that these bits stand for, flattened by `DOUBT_BITS`.

    Null texts and texts without a letter are `und` with score 0 and null bits; so is everything if there is no
    sample. Repeated rows get equal answers; an empty table gives an empty result. Columns of `docs` named like the
    new ones are replaced.
    """
    added = {"lang_pred": pa.string(), "score": pa.float64(), "bits_per_letter": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(samples) if samples else None
        for big in batches:
            for batch in slices(big, text_col):
                texts = texts_of(batch.column(text_col))
                has = np.zeros(len(texts), bool)
                if parser:
                    bits, sizes = parser.bits(texts)
                    has = np.array([any(map(str.isalpha, t)) for t in texts], bool)
                    best = bits.argmin(1)
                    least = bits[np.arange(len(texts)), best]
                    score = 1 / np.exp2(-(bits - least[:, None]) / DOUBT_BITS).sum(1)
                told = [parser.languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), has)] if parser else [UNDETERMINED] * len(texts)
                scores = np.where(has, score, 0.0) if parser else np.zeros(len(texts))
                rate = pa.array(least / np.maximum(sizes, 1), mask=~has) if parser else pa.nulls(len(texts), pa.float64())
                kept = [n for n in batch.schema.names if n not in added]
                yield pa.record_batch([*(batch.column(n) for n in kept), pa.array(told, pa.string()), pa.array(scores), rate], [*kept, *added])

    small_batches(docs.sparkSession)
    rows = docs.drop(*added)
    return rows.mapInArrow(run, StructType([*rows.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                                            StructField("bits_per_letter", DoubleType())]))
