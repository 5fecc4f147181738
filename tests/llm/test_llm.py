"""The operators for training text against brute force, libraries and SQL, and on odd rows."""

import hashlib
import math
import os
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import bpe, classes, common, exact, jaccard, language, links, ngram, order_minhash, packing, queries, suffixes, warc

SF = "/root/testdata/sf0.001"
VOCAB = queries.vocabulary_path()
CLASH = "id keep n hash digest first spans score group size part row key salt later copied next head text_sha256 n_tokens".split()
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(4000))
ODD = [(1, "one two three four five six", "en"), (None, "one two three four five six", "en"), (2, None, None), (3, "", "en"), (4, "... 123 !!", "xx"),
       (5, LONG, "en"), (5, LONG, "en"), (6, LONG + " more", None), (7, "\n\n  \t", "de"), (8, "été à la plage <|endoftext|> it's", "fr"), (8, "other text", "fr")]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(con):
    return {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame([(*r, 0) for r in ODD], "doc_id long, text string, lang string, n_chars long")
    return rows.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCAB)


OPERATORS = {
    "identify": lambda d: language.identify(d.drop("score"), language.sample(d)),
    "encode": lambda d: bpe.encode_documents(d, VOCAB, words=50),
    "pack": lambda d: packing.pack(d, VOCAB),
    "exact": exact.exact_groups, "near": jaccard.near_duplicates, "repeats": suffixes.remove_repeats,
    "score": lambda d: ngram.score(d, *ngram.learn(d)), "prints": order_minhash.compare_edits,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(odd, name):
    found = OPERATORS[name](odd).collect()
    ids = Counter(r["doc_id"] for r in found)
    if name == "pack":
        assert set(ids) == {r[0] for r in ODD}
    else:
        assert ids == Counter(r[0] for r in ODD)
    assert OPERATORS[name](odd.limit(0)).collect() == []


def test_pages_of_odd_rows(spark, tmp_path):
    pages = spark.createDataFrame([(1, None, None), (2, "no host", ""), (2, "no host", ""), (None, "http://A.net?x", "h" * 2000), (3, "http://b.org/fr/x", "h" * 2000),
                                   (4, "https://c.net/\r\n", "h" * 2000)], "page_id long, url string, html string").withColumns({c: F.lit("own") for c in CLASH})
    judged = links.judge(pages, queries.RULES).collect()
    assert Counter(r["page_id"] for r in judged) == Counter([1, 2, 2, None, 3, 4])
    assert {(r["host"], r["path"], r["rule"], r["verdict"]) for r in judged} == {
        ("", "", None, "allow"), ("a.net", "", None, "allow"), ("b.org", "/fr/x", "org/fr/", "allow"), ("c.net", "/\r\n", "net/", "block")}
    assert links.judge(pages.limit(0), queries.RULES).collect() == []
    found = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(pages, str(tmp_path / "a")).collect()}
    assert found == {(1, "response", None, 0), (2, "response", None, 0), (None, "response", None, 2000), (3, "revisit", 4, 2000), (4, "response", None, 2000)}
    assert warc.round_trip(pages.limit(0), str(tmp_path / "b")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) is None


def test_language_of_held_out_texts(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = [r for r in run(spark, "op1_cross_parsing") if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_automaton_walks_longest_matches():
    rng = np.random.default_rng(3)
    text, query = rng.integers(0, 3, 400), rng.integers(0, 3, 200)
    table, raw = language.automaton(text, 3), bytes(text.tolist())
    state, phrases, begin = 0, 1, 0
    for i, c in enumerate(query.tolist()):
        found = int(table[state, c])
        state, miss = (~found, True) if found < 0 else (found, False)
        assert miss == (bytes(query[begin:i + 1].tolist()) not in raw)
        begin, phrases = (i, phrases + 1) if miss else (begin, phrases)
    assert phrases > 5


def test_languages_of_many_scripts_and_labels(spark):
    """Seven scripts, one of them of a thousand letters, and labels for 70 languages of words of their own."""
    rng = np.random.default_rng(11)
    scripts = {"el": (0x3B1, 24), "ru": (0x430, 32), "ar": (0x628, 30), "hi": (0x915, 35), "he": (0x5D0, 27), "zh": (0x4E00, 1000), "ko": (0xAC00, 600)}
    starts = {**scripts, **{f"x{i:02}": (0x61, 26) for i in range(70)}}
    rows = []
    for k, (lang, (start, n)) in enumerate(starts.items()):
        words = ["".join(chr(start + int(c)) for c in rng.integers(0, n, 5)) for _ in range(30)]
        rows += [(100 * k + d, " ".join(words[int(w)] for w in rng.integers(0, 30, 25)), lang) for d in range(6 if lang != "x69" else 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.sample(docs.where("doc_id % 100 > 0"))
    assert {lang for lang, _ in samples} == set(starts)
    found = language.identify(docs.where("doc_id % 100 = 0"), samples).collect()
    assert len(found) == len(starts) and all(r["lang_pred"] == r["lang"] for r in found)


def test_columns_do_not_change_phrases(monkeypatch):
    rng = np.random.default_rng(4)
    texts = ["".join(chr(0x4E00 + int(c)) for c in rng.zipf(1.4, 400) % 300) for _ in range(6)]
    samples = {"a": texts[:2], "b": texts[2:4]}
    whole = language.Parser(samples).bits(texts)[0]
    monkeypatch.setattr(language, "COLUMNS", 3)
    assert (language.Parser(samples).bits(texts)[0] == whole).all()


def test_trust_follows_links(spark):
    """Against repeated matrix products."""
    edges = [("a", "b", 2), ("b", "c", 1), ("b", "a", 1), ("c", "d", 3), ("e", "d", 1)]
    names = "abcdef"
    seeds = {"a": (4, 0), "d": (0, 6), "f": (1, 1)}
    hosts = spark.createDataFrame([(h, 10, *seeds.get(h, (0, 0))) for h in names], "host string, pages long, allowed long, blocked long")
    found = {r["host"]: r for r in links.spread(hosts, spark.createDataFrame(edges, "source string, target string, n long")).collect()}
    for k, kind in enumerate(("trust", "distrust")):
        m = np.zeros((6, 6))
        for s, t, n in edges:
            m[(names.index(s), names.index(t))[::1 if k == 0 else -1]] += n
        out = m.sum(1, keepdims=True)
        m = np.where(out > 0, m / np.maximum(out, 1), np.eye(6))
        seed = np.array([seeds.get(h, (0, 0))[k] for h in names], float)
        x = seed.copy()
        for _ in range(300):
            x = (1 - links.DAMPING) * seed + links.DAMPING * x @ m
        assert [found[h][kind] for h in names] == pytest.approx(x.tolist(), abs=1e-3)


def test_ids_equal_the_library(spark, texts):
    tool = tokenizer()
    for r in run(spark, "op3_bpe_lexicon"):
        ids = tool.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        told = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == told


def test_hard_texts_equal_the_library():
    tool, own = tokenizer(), bpe.Encoder(bpe.vocabulary(VOCAB))
    hard = ["it's 's ''s !!'s we'll  they've\n\n  x 'sfoo I'd've ", "", " ", "\n\n", "a  \nb\t\tc 　 d", "<|endoftext|>x<|endoftext|><|endoftext|> y",
            "½²Ⅷ 123abc日本語😀😀 é", "x" * 500, "aaaaaaaa" * 20 + " " + "ab" * 300, "ẽ \x1c\x1d \x85 z", "don't'll 'lll 'r 've'", "'"]
    flat, at = own.encode(hard)
    for i, text in enumerate(hard):
        assert flat[at[i]:at[i + 1]].tolist() == tool.encode(text, add_special_tokens=False).ids


def test_lexicon_finds_its_words_only(tmp_path):
    words = sorted({w.encode() for w in "a an and ant ants band bands été hand hands stand".split()})
    bpe.build_lexicon(words, bpe.vocabulary(VOCAB), str(tmp_path / "lexicon"))
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    asked = [*words, b"", b"an d", b"bandsx", b"zz", b"hants"]
    sizes = np.array([len(w) for w in asked])
    assert lexicon.find(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(sizes) - sizes, sizes).tolist() == [*range(len(words)), -1, -1, -1, -1, -1]


@pytest.mark.parametrize("limit", [40, 10_000_000])
def test_chains_pass_over_magic_in_payloads(spark, tmp_path, limit):
    """Small splits, and payloads that hold a magic or whole records."""
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = ["plain", "x" * 50 + "WARC/1.0\r\n" + "y" * 50, record, "a" + record + record, "WARC/1.0\r\n", "z" * 300, "", "\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n"] * 3
    pages = spark.createDataFrame([(i, f"http://h/{i}", h + str(i) * (h == "plain")) for i, h in enumerate(html)], "page_id long, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    try:
        found = {r["page_id"]: r for r in warc.round_trip(pages, str(tmp_path / "warc")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {i: (r["payload_bytes"], r["payload_digest"]) for i, r in found.items()} == {
        r["page_id"]: (len(r["html"].encode()), hashlib.sha1(r["html"].encode()).hexdigest()) for r in pages.collect()}


def test_packing_is_exact(spark, texts):
    tool = tokenizer()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op5_bin_slack_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, text in texts.items():
        ids, at = [*tool.encode(text, add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded


@pytest.mark.parametrize("counts", [{700: 1000}, {1023: 7, 1: 3}, {3: 1}, {513: 2, 512: 5, 200: 9, 31: 4}, {}])
def test_plans_place_every_id_once(counts):
    held = np.zeros(1024, np.int64)
    for length, n in counts.items():
        held[length] = n
    entries, sequences = packing.plan(held, 1024)
    filled = np.zeros(sequences + 1, np.int64)
    for length, lo, hi, per, sequence, offset, take, _ in entries.tolist():
        for r in range(lo, hi):
            filled[sequence + (r - lo) // per] += take
    assert filled.sum() == (held * np.arange(1024)).sum() and all(n & (n - 1) == 0 for n in filled.tolist())


def test_fill_is_best():
    rng = np.random.default_rng(5)
    for _ in range(30):
        counts = np.zeros(40, np.int64)
        counts[rng.integers(1, 40, 4)] = rng.integers(1, 4, 4)
        reach = {int(np.flatnonzero(counts)[-1])}
        for length in np.flatnonzero(counts):
            spare = counts[length] - (length == np.flatnonzero(counts)[-1])
            reach |= {s + k * int(length) for s in reach for k in range(int(spare) + 1)}
        chosen = packing.fill(counts, 60)
        assert all(k <= counts[n] for n, k in chosen.items())
        assert sum(n * k for n, k in chosen.items()) == max(s for s in reach if s <= 60)


def test_collisions_are_told_apart(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "doc_id long, text string")
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_groups(docs, hashed=lambda c: F.length(c)).collect()}
    assert found == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 2, True), 5: (4, 2, False)}


def linked(texts):
    sets = {}
    for i, t in texts.items():
        w = [x for x in re.split("[ \t\n\x0b\f\r]+", t) if x]
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    found = {i: set() for i in texts}
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and (texts[a] == texts[b] or both * 5 >= 4 * (len(sets[a]) + len(sets[b]) - both) and both):
                found[a].add(b)
                found[b].add(a)
    return found


def reached(found, i):
    seen, todo = {i}, [i]
    while todo:
        todo = [x for k in todo for x in found[k] if x not in seen and not seen.add(x)]
    return min(seen)


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates(spark, texts, monkeypatch, small):
    """Also with buckets and blocks so small that all are split."""
    texts = {i: t for i, t in texts.items() if i < 120}
    base = [f"w{k}" for k in range(200)]
    for k in range(14):
        own = list(base)
        own[k * 10] = "new"
        texts[1000 + k] = " ".join(own)
    if small:
        for name in ("LIMIT", "BLOCK", "SET_BLOCK"):
            monkeypatch.setattr(jaccard, name, 4)
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    expected = linked(texts)
    found = {r["doc_id"]: (r["n_links"], r["group_id"]) for r in jaccard.near_duplicates(docs).collect()}
    assert found == {i: (len(expected[i]), reached(expected, i)) for i in texts}
    assert sum(n for n, _ in found.values()) > 150


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 105), (105, 100)]
    found = {r["node"]: r["group"] for r in classes.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100}


def removed(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(raw[p:p + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out[i] = (len(raw), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("joined", [False, True])
def test_repeats(spark, texts, monkeypatch, joined):
    texts = {i: t for i, t in texts.items() if i < 80}
    texts |= {1001: "a" * 350, 1002: "é" * 49 + "x", 1003: "é" * 50 + "y" + "é" * 50, 1004: "b" * 99, 1005: texts[3][200:500] + texts[5][:250], 1006: texts[5][10:109]}
    if joined:
        monkeypatch.setattr(suffixes, "BROADCAST_HASHES", -1)
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove_repeats(docs).collect()}
    assert found == removed(texts)


def test_scores(spark, texts):
    def tokens(text):
        return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) + ["<end>"]

    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i, t in texts.items() if not out[i] for w in tokens(t))
    total = sum(count.values())
    sums = Counter()
    for r in run(spark, "op9_weighted_backoff"):
        words = tokens(texts[r["doc_id"]])
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(words), sum(w in count for w in words), total, out[r["doc_id"]])
        assert r["base_score"] == pytest.approx(base)
        if r["held_out"]:
            sums.update(base=base, own=r["score"])
    assert sums["own"] > sums["base"]


def test_probabilities_add_up(spark):
    """Of all words after every state, the unseen ones together."""
    docs = spark.createDataFrame([(i, "a b c a b d a b c e f g" + " h" * (i % 3)) for i in range(30)], "doc_id long, text string")
    model, counts = ngram.learn(docs)
    n = len(model.words)
    assert n == model.kinds and model.kinds == counts.count()
    for state in range(len(model.fail)):
        total = 0.0
        for word in range(n):
            s, log = state, 0.0
            while True:
                hit = ngram.places(model.arcs, np.array([s << ngram.WORD_BITS | int(model.frequent[word])]))[0]
                if hit >= 0:
                    log += model.weight[hit]
                    break
                if s == 0:
                    log += model.word_logs(model.counts[word:word + 1])[0]
                    break
                log, s = log + model.cost[s], int(model.fail[s])
            total += 10 ** log
        total += 10 ** model.cost_all[state] * model.unseen()
        assert total == pytest.approx(1, abs=0.02)


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    """Against the back-off rule over all n-grams that occur twice, with few of them sent to the tasks."""
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{int(k)}" for k in rng.zipf(1.3, 60) if k < 400) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    train = docs.where("doc_id % 4 > 0")
    lists = {i: [*t.split(), "</s>"] for i, t in texts.items()}
    seen = [Counter() for _ in range(3)]
    for i, words in lists.items():
        if i % 4:
            line = ["<s>", *words]
            seen[0].update(words)
            seen[1].update(zip(line, line[1:]))
            seen[2].update(zip(line, line[1:], line[2:]))
    total, kinds = sum(seen[0].values()), len(seen[0])
    discount = min(0.75, max(1, sum(n == 1 for n in seen[0].values())) / (kinds + 1))
    one = {w: (n - discount) / total for w, n in seen[0].items()}
    held = {("<s>",): sum(i % 4 > 0 for i in texts), **{(w,): n for w, n in seen[0].items()}, **seen[1]}
    prob = {g: (n - 0.5) / held[g[:-1]] for c in seen[1:] for g, n in c.items() if n >= 2}
    followers = defaultdict(list)
    for g in prob:
        followers[g[:-1]].append(g)

    def weight(words):
        if len(words) == 1:
            return one.get(words[0], discount * kinds / total)
        if words in prob:
            return prob[words]
        left = 1 - sum(prob[g] for g in followers[words[:-1]])
        lower = 1 - sum(weight(g[1:]) for g in followers[words[:-1]])
        return left / lower * weight(words[1:])

    for share in (5e-7, 0.01):
        monkeypatch.setattr(ngram, "GRAM_SHARE", share)
        for r in ngram.score(docs, *ngram.learn(train)).collect():
            line = ["<s>", *lists[r["doc_id"]]]
            assert r["score"] == pytest.approx(sum(math.log10(weight(tuple(line[max(0, k - 2):k + 1]))) for k in range(1, len(line)))), share


def test_shuffles_of_learning_are_removed_and_no_hashes_of_texts_stored(spark, monkeypatch):
    """Looked-up hashes go straight to their buckets; of stored tables only the files stay, not the shuffles they came from."""
    names, cleaned, write = [], [], ngram.stored

    def noted(df, name):
        names.append(name)
        return write(df, name)

    monkeypatch.setattr(ngram, "stored", noted)
    monkeypatch.setattr(common, "stored", lambda df, name, plain=common.stored: cleaned.append(spark.conf.get(common.SHUFFLE_CLEANUP)) or plain(df, name))
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.3, 50))) for i in range(20)], "doc_id long, text string")
    assert ngram.score(docs, *ngram.learn(docs)).count() == 20
    assert "scored" not in names and cleaned == ["true"] * len(names)
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


def test_packed_columns_come_back():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    rows = np.arange(len(keys), dtype=np.uint32)
    number, data = ngram._dealt(keys, 24, [keys, rows])
    assert len(number) == 24
    back = [ngram._undealt([d], [np.uint64, np.uint32], True) for d in data.to_pylist()]
    assert np.array_equal(np.concatenate([b[0] for b in back]), keys) and np.array_equal(np.concatenate([b[1] for b in back]), rows)
    assert all(np.all(ngram._bucket(b[0], 24) == k) for k, b in zip(number.to_pylist(), back))


def test_batches_put_together_are_not_held_twice():
    made = []

    def column(k):
        made.append(weakref.ref(out := np.full(ngram.PENDING // 2, k)))
        return out

    sizes = []
    for columns in ngram._pending([column(k)] for k in range(6)):
        sizes.append(len(columns[0]))
        assert not any(m() is not None for m in made)
    assert sizes == [ngram.PENDING] * 3


def test_tables_of_learning_are_removed_once_read(spark, monkeypatch):
    """At the end only the two kinds of tables stay that scoring reads: the levels, and no count, join or cost."""
    kept, write = {}, ngram.stored

    def noted(df, name):
        out = write(df, name)
        kept[out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")] = name
        return out

    monkeypatch.setattr(ngram, "stored", noted)
    docs = spark.createDataFrame([(i, "a b c a b d a b c e") for i in range(5)], "doc_id long, text string")
    model, gains = ngram.learn(docs)
    assert {name for path, name in kept.items() if os.path.exists(path.replace("//", "/"))} == {"leading"}
    assert {"words", "counts", "known", "costs", "leading"} == set(kept.values())
    assert gains.count() == model.kinds and model.longer.count() > 0


def test_traversal_tells_the_longest_ngram_held(spark, monkeypatch):
    monkeypatch.setattr(ngram, "GRAM_SHARE", 0.02)
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, 150)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, _ = ngram.learn(docs)
    words, upto = ngram.tokens(pa.array(texts))
    place, numbers = model.numbers(words, upto)
    _, read = model.traverse(place, numbers, upto)
    lists = [["<s>", *t.split(), "</s>"] for t in texts]
    seen = Counter(tuple(line[k:k + n]) for line in lists for n in (1, 2, 3) for k in range(len(line) - n + 1))
    least = max(ngram.LEAST, math.ceil(sum(len(line) - 1 for line in lists) * 0.02))
    for n, (line, at) in enumerate(zip(lists, upto)):
        for k in range(1, len(line)):
            longest = max((m for m in (2, 3) if m <= k + 1 and seen[tuple(line[k - m + 1:k + 1])] >= least), default=1)
            assert max(1, read[at + k - 1]) == longest, (n, k)
    assert set(read.tolist()) >= {2, 3}


def test_index_finds_what_a_binary_search_finds():
    rng = np.random.default_rng(9)
    last = ~np.uint64(0)
    for n, top in ((0, 1 << 64), (1, 1 << 64), (500, 1 << 64), (500, 700)):
        held = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        for keys in (held, np.append(held, last)):
            asked = np.concatenate([held, held + np.uint64(1), rng.integers(0, last, 300, dtype=np.uint64), np.array([0, last], np.uint64)])
            assert np.array_equal(ngram.Index(keys).places(asked), ngram.places(keys, asked))


def test_hashes_of_words_by_eight_bytes():
    rng = np.random.default_rng(8)
    words = [bytes(rng.integers(0, 3, int(n)).astype(np.uint8)) for n in rng.integers(1, 30, 3000)] + [b"x", b"x\0", b"x" * 8, b"x" * 8 + b"\0", b"x" * 16]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    hashes = common.word_hashes(data, ends - [len(w) for w in words], ends)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_answers_are_packed_by_batch_not_by_row(spark):
    """No row for each text and bucket leaves the look-up, so no aggregate folds them; rows of many partitions keep their sums."""
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d a b c{i % 5}") for i in range(200)], "doc_id long, text string")
    learnt = ngram.learn(docs.where("doc_id % 2 = 0"))
    out = ngram.score(docs.repartition(5), *learnt)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    one = {r["doc_id"]: r["score"] for r in ngram.score(docs.coalesce(1), *learnt).collect()}
    assert {r["doc_id"]: r["score"] for r in out.collect()} == pytest.approx(one) and len(one) == 200


def test_fingerprints(spark, texts):
    found = {r["doc_id"]: r for r in run(spark, "op10_order_minhash")}
    ids = sorted(texts, reverse=True)
    following = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}

    def alike(a, b):
        a, b = (set(x.split(",")) if x else set() for x in (a, b))
        return len(a & b) / max(len(a), len(b)) if a or b else 1.0

    for i, r in found.items():
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[following[i]][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(alike(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(alike(r["fingerprint"], found[following[i]]["fingerprint"]))
    long = [r for r in found.values() if r["n_chars"] > 1000]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.8 * len(long)


def test_fingerprints_follow_order(spark):
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(swapped)), (3, " ".join(words))], "k int, text string")
    a, b, c = (r["p"] for r in rows.orderBy("k").select(order_minhash.fingerprint(F.col("text")).alias("p")).collect())
    assert a == c and 0 < len(set(a) & set(b)) < len(a) and len(a) > order_minhash.TUPLES * 0.9


def test_fingerprints_of_short_texts_follow_order(spark):
    """Halves of 20 to 100 words change places: as many tuples stay as pairs of k-mers keep their order."""
    rng = np.random.default_rng(9)
    rows, expected = [], []
    for k in range(120):
        words = [f"w{k}x{int(i)}" for i in range(rng.integers(20, 100))]
        both = [words, words[len(words) // 2:] + words[:len(words) // 2]]
        rows.append((k, *map(" ".join, both)))
        a, b = ({tuple(w[i:i + 3]): i for i in range(len(w) - 2)} for w in both)
        same = [(a[g], b[g]) for g in a.keys() & b.keys()]
        kept = sum((x[0] < y[0]) == (x[1] < y[1]) for i, x in enumerate(same) for y in same[:i])
        expected.append(kept / math.comb(len(a.keys() | b.keys()), 2))
    docs = spark.createDataFrame([*rows, (1000, "a b c", "a b"), (1001, "a b c d", "a b c d")], "k int, a string, b string")
    found = docs.select("k", *(order_minhash.fingerprint(F.col(c)).alias(c) for c in "ab")).collect()
    assert all(len(r[c]) == order_minhash.TUPLES for r in found for c in "ab")
    alike = [len(set(r["a"]) & set(r["b"])) / order_minhash.TUPLES for r in sorted(found)[:-2]]
    assert np.mean(alike) == pytest.approx(np.mean(expected), abs=0.03)


def plain_fingerprint(text):
    """Order MinHash by ranking every numbered k-mer under each function."""
    from xxhash import xxh64_intdigest

    def long(x, seed):
        return xxh64_intdigest(x.to_bytes(8, "little"), seed)

    def small(x, seed):
        return xxh64_intdigest((x % 2**32).to_bytes(4, "little"), seed)

    words = [xxh64_intdigest(w.encode(), 42) for w in re.split("[ \\t\\n\\x0B\\f\\r]+", text) if w]
    seen, kmers = Counter(), []
    for i in range(max(len(words) - order_minhash.K, 0) + 1 if words else 0):
        h = 42
        for w in words[i:i + order_minhash.K]:
            h = long(w, h)
        kmers.append(small(seen[h], long(h, 42)))
        seen[h] += 1
    best = [{} for _ in range(order_minhash.TUPLES)]  # of each function: place of a k-mer and its value
    for at, h in enumerate(kmers):
        for e in range(1, order_minhash.ROUNDS + 1):
            r = small(e, long(h, 42))
            best[r % order_minhash.TUPLES].setdefault(at, (e, r >> 12))
        for j in range(order_minhash.TUPLES):
            best[j].setdefault(at, (order_minhash.ROUNDS + 1, small(-j, long(h, 42)) >> 12))
    out = []
    for j, ranked in enumerate(best if kmers else []):
        value = 42
        for at in sorted(sorted(ranked, key=ranked.get)[:order_minhash.TUPLE]):
            value = long(kmers[at], value)
        out.append(j << 32 | value & 0xFFFFFFFF)
    return out


def test_fingerprints_against_plain_ranking(spark, texts):
    rng = np.random.default_rng(4)
    made = [" ".join(f"w{int(x)}" for x in rng.integers(0, kinds, n)) for kinds, n in [(3, 40), (2, 900), (9999, 1), (9999, 2), (9999, 5),
                                                                                   (9999, 30), (9999, 700), (9999, 703), (500, 5000), (1, 3000)]]
    made += ["", " \t\n", "één twee één twee één twee drie", *list(texts.values())[:40]]
    rows = spark.createDataFrame(list(enumerate(made)), "k int, text string").select("k", order_minhash.fingerprint(F.col("text")).alias("p"))
    for k, found in rows.collect():
        assert list(found) == plain_fingerprint(made[k]), made[k][:80]


def test_sorted_draws_hold_no_more_than_key_and_place(spark, capsys):
    """Hundreds of draws are sorted for each text, so the hashes of k-mers are taken only for the chosen ones."""
    capsys.readouterr()
    spark.createDataFrame([("a b",)], "text string").select(order_minhash.fingerprint(F.col("text"))).explain()
    plan = capsys.readouterr().out
    starts = [m.end() for m in re.finditer(r"struct\(q,", plan)]
    assert starts
    for start in starts:
        depth = np.cumsum([(c == "(") - (c == ")") for c in plan[start:]])
        draw = plan[start:start + int(np.argmax(depth < 0))]
        assert ", at, " in draw and ", h, " not in draw


def test_stages(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "123 ...", "en", "s", 7)], docs.schema)
    kept = {}
    now = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        assert now.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in now.collect()}
    assert set(kept["language ID"]) == set(texts)
    first = {t: i for i, t in sorted(texts.items(), reverse=True)}
    assert set(kept["exact dedup"]) == set(first.values())
    left = linked(kept["exact dedup"])
    assert set(kept["n-gram Jaccard join"]) == {i for i in left if reached(left, i) == i}
    cut = removed(kept["n-gram Jaccard join"])
    assert set(kept["suffix-array dedup"]) == set(cut) and not any("\ufffd" in t for t in kept["suffix-array dedup"].values())
    # Cuts are widened to whole letters, by at most three bytes at either end of a run.
    assert all(0 <= cut[i][0] - cut[i][1] - len(t.encode()) <= 6 * cut[i][2] for i, t in kept["suffix-array dedup"].items())
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    sizes = Counter()
    for r in packed:
        sizes[r["doc_id"]] += r["length"]
    tool = tokenizer()
    assert sizes == {i: len(tool.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept["suffix-array dedup"].items()}


def test_stages_pass_columns_of_any_name_on(spark):
    """Columns named like an operator's own, no `n_chars`, rows given twice, letters of several bytes at a cut."""
    shared = "é" + "".join(f" wörter {i} größe" for i in range(12)) + " ü"
    rows = [(1, "alpha " + shared, "de"), (1, "alpha " + shared, "de"), (2, "ß" + shared + "ß " + " ".join(f"other{i}" for i in range(60)), "de"), (3, "alpha " + shared, "de"),
            (4, "short text", "en"), (4, "short text", "en"), (5, None, "en"), (None, "short text", "en"), (None, "own words", "en"), (None, "own words", "en")]
    names = "score lang_pred bits_per_letter spans later digest first id __other".split()
    now = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(f"own {c}") for c in names})
    columns = now.columns
    empty = now.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), now.schema)
        assert now.columns == columns and all(r[c] == f"own {c}" for r in now.collect() for c in names)
        if name != "language ID":
            assert sorted((r["doc_id"] or 0) for r in now.collect()) == [0, 1, 2, 4]
        assert stage(spark, empty, SF).collect() == []
    left = {r["doc_id"]: r["text"] for r in now.collect()}
    assert left[1] == "alpha " + shared and "wörter 3" not in left[2] and left[2].endswith("other59") and "\ufffd" not in left[2]


def test_words_that_a_polynomial_takes_for_one(spark):
    """Complementary Thue-Morse words: modulo 2**64 every polynomial has one value for both."""
    def word(n, a, b):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))

    tool, own = tokenizer(), bpe.Encoder(bpe.vocabulary(VOCAB))
    for n in (1024, 4096):
        one, other = word(n, "a", "b"), word(n, "b", "a")
        for texts_ in ([f"{one} {other}"], [one, other], [f"x {other}", f"y {one}"]):
            flat, at = own.encode(texts_)
            assert [flat[at[i]:at[i + 1]].tolist() for i in range(len(texts_))] == [tool.encode(t, add_special_tokens=False).ids for t in texts_]
    one, other = word(1024, "a", "b"), word(1024, "b", "a")
    docs = spark.createDataFrame([(1, one), (2, other), (3, f"{one} common"), (4, f"{other} common")], "doc_id long, text string")
    assert {r["n_links"] for r in jaccard.near_duplicates(docs).collect()} == {0}
    scored = {r["doc_id"]: r for r in ngram.score(docs, *ngram.learn(docs.where("doc_id = 1"))).collect()}
    assert [scored[i]["n_known"] for i in (1, 2, 3, 4)] == [2, 1, 2, 1]
    whole = spark.createDataFrame([(i, " ".join(w * 3 for w in [f"{(one, other)[i % 2]}"])) for i in range(4)], "doc_id long, text string")
    assert {r["n_links"] for r in jaccard.near_duplicates(whole).collect()} == {1}
