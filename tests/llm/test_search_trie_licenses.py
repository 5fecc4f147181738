"""The conversation trie, ranked search and license scans against brute force, on odd rows and hot groups."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from oracle import connect
from pyspark.sql import functions as F

from parley.llm import licenses, prefix_trie, queries, ranked

SF = "/root/testdata/sf0.001"
CLASH = "conv base pos k h n key name start level done ends id size kind text2 no salt rank score word words held places".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie_by_hand(turns):
    """Nodes of (conv, turn, role, text) rows, as the operator's columns."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), sha(f"{len(role.encode())}:{role}{text}")[:32], (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        whole[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), kids[p], leaves[p], saved[p],
                    sha(",".join(map(str, sorted(ends[p]))))) for p in members), key=repr)


def conversations(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def random_turns(seed, convs=120, longest=14, words=3):
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.choice(4 * convs, convs, replace=False).tolist():
        same = c % 7 == 0  # a group of equal conversations
        for t in range(9 if same else int(rng.integers(1, longest))):
            out.append((c - 30, t, "user" if t % 2 == 0 else "bot", f"turn {t} é" if same else f"w{int(rng.integers(words))} é"))
    return out


@pytest.mark.parametrize("seed, longest, keys, block, hot", [(1, 14, 4096, 512, None), (2, 14, 7, 512, True), (3, 7, 16, 3, False)])
def test_trie_equals_brute_force(spark, seed, longest, keys, block, hot):
    turns = random_turns(seed, 60 if block == 3 else 120, longest)
    found = prefix_trie.prefix_trie(conversations(spark, turns), hot=hot, block=block, keys=keys)
    assert rows(found) == trie_by_hand(turns)


def test_trie_of_odd_rows(spark):
    turns = [(0, None, None, None), (0, None, "", ""), (0, 1, "user", "hi"), (0, 1, "user", "hi"), (None, 1, "user", "lost"), (3, 5, None, "x" * 100_000),
             (7, 1, "user", "hi"), (12, None, None, None), (-4, 2, "bot", None), (5, 0, "us", "er"), (6, 0, "u", "ser"), (2, 2, "user", "hi"), (2, 1, "user", "hi")]
    for block in (512, 3):
        assert rows(prefix_trie.prefix_trie(conversations(spark, turns), block=block)) == trie_by_hand(turns)
    assert prefix_trie.prefix_trie(conversations(spark, turns).limit(0)).collect() == []
    only = conversations(spark, [(None, 1, "user", "lost")])
    assert prefix_trie.prefix_trie(only).collect() == []


def test_trie_of_one_hot_beginning_and_long_conversations(spark):
    """A third shares its first turn, a third is equal, and two conversations go on alike for long."""
    turns = [(c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(0, 300) for t in range(10)]
    turns += [(c, t, "user", f"same {t}") for c in range(1000, 1300) for t in range(10)]
    turns += [(c, t, "user", f"long {t}" if t < 140 or c == 2001 else f"other {t}") for c in (2001, 2002, 2003) for t in range(150)]
    found = prefix_trie.prefix_trie(conversations(spark, turns), block=64, keys=600)
    assert rows(found) == trie_by_hand(turns)


def test_layouts_grow():
    rng = np.random.default_rng(1)
    for kinds in (3, 12, 40, 256):
        keys = sorted({bytes(rng.integers(0, kinds, int(n)).astype(np.uint8).tolist()) for n in rng.integers(1, 5, 600)})
        root = prefix_trie.Inner(b"")
        for i, key in enumerate(rng.permutation(len(keys)).tolist()):
            prefix_trie.insert(root, keys[key], key)
        seen, rooms = [], Counter()

        def walk(node, path):
            path += node.path
            if node.value is not None:
                seen.append((path, node.value))
            if isinstance(node, prefix_trie.Inner):
                rooms[node.room] += 1
                for kid in node.children():
                    walk(kid, path)

        walk(root, b"")
        assert seen == [(k, i) for i, k in enumerate(keys)]
        assert max(rooms) == {3: 4, 12: 16, 40: 48, 256: 256}[kinds]


def search_by_hand(items, docs, top=10):
    def terms(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low))

    counted = [(i, terms(t)) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        asked, scores = terms(text), []
        for i, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // max(length, 1)
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 24, 300])
def test_search_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(ranked, "INDEX_BYTES", block_bytes)
    items = [(1, "Alpha beta BETA É é"), (2, None), (None, "gamma"), (3, "... !!"), (1, "alpha beta"), (4, "unseen words"), (5, "日本 x2 x2 beta")]
    docs = [(i, f"alpha {'beta ' * (i % 4)} É x2 gamma{i}") for i in range(40)] + [(100 + i, "beta beta alpha") for i in range(30)]
    docs += [(None, "alpha É"), (None, "alpha É"), (7, "alpha É"), (200, None), (201, ""), (202, "?!"), (203, "日本 " + "long text " * 20_000), (204, "Ébeta bETA")]
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumns({c: F.lit(f"own {c}") for c in CLASH if c != "id"})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("own"))
    assert rows(ranked.search(asked, made)) == search_by_hand(items, docs)
    assert ranked.search(asked.limit(0), made).collect() == [] and ranked.search(asked, made.limit(0)).collect() == []


def test_windows_end_between_terms(monkeypatch):
    text = ("abc déf9 x" * 7 + "  " + "y" * 50 + " z").encode()
    whole = ranked.term_counts(text)
    monkeypatch.setattr(ranked, "WINDOW", 5)
    assert ranked.term_counts(text) == whole and whole["y".encode() * 50] == 1


def words_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def scan_by_hand(text):
    """Every rule tried on every text, without a prefilter; every pair of detections compared."""
    words = words_by_hand(text)
    joined = " ".join(words)
    base = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    places = []
    for no, rule in enumerate(licenses.rules()):
        for m in re.finditer(rule.pattern, joined):
            start = joined.count(" ", 0, m.start())
            places.append((start, start + m.group().count(" ") + 1, rule.priority, no, rule.label))

    def beats(y, x):
        return y[0] <= x[0] and y[1] >= x[1] and y[2] <= x[2] and (y[:2] != x[:2] or (y[2], y[3]) < (x[2], x[3]))

    kept = [x for x in places if not any(beats(y, x) for y in places)]
    starts = [i for i, _ in base]
    labels = sorted({label for _, label in base} | {x[4] for x in kept})
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in base})), ",".join(labels),
            max((licenses.WEIGHTS[x[2] - 1] for x in kept), default=0.0))


NOTICES = [None, "", "?!", "MIT License", "the mit license, MIT-license; cc by cc by 4.0 CC BY-NC-SA 4.0", "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0",
           "GNU General Public License, version 3 or GNU LESSER GENERAL PUBLIC LICENSE v2.1; GPLv3 license gnu gpl 2", "committee license mitlicense xcc by", "Expat License",
           "Creative Commons Zero 1.0, CC0 license, cc zero", "Released by us under the terms of the MIT License. All rights reserved. Copyright (c) 2020",
           "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "mit license " * 500,
           "neither the name of the great company nor ours may be used to endorse or promote products, BSD 3-Clause License", "in the public domain", "dual-licensed; proprietary and confidential"]


def test_scan_equals_brute_force(spark):
    found = rows(licenses.summarised(licenses.scan(spark.createDataFrame(
        [(i, t) for i, t in enumerate(NOTICES)] + [(3, NOTICES[3]), (None, "MIT License")], "doc_id long, text string").withColumns({c: F.lit(f"own {c}") for c in CLASH if c != "id"}))))
    assert found == sorted([(i, *scan_by_hand(t)) for i, t in enumerate(NOTICES)] + [(3, *scan_by_hand(NOTICES[3])), (None, *scan_by_hand("MIT License"))], key=repr)


def test_every_rule_passes_its_prefilter(spark):
    """A text made from each expression is found by its rule, so the words asked for are words of every match."""
    assert len(licenses.rules()) > 300
    texts = []
    for rule in licenses.rules():
        text = re.sub(r"\(\?<!.*?\]\)|\(\?!.*?\]\)", "", rule.pattern)
        text = text.replace("(?: [^ ]+){0,3}", "").replace("(?: [^ ]+){1,12}", " a b").replace("[cs]", "s").replace("[0-9]", "3").replace("[0-9]{2}", "33").replace("3{2}", "33")
        while re.search(r"\(\?:[^()]*\)", text):
            text = re.sub(r"\(\?:([^()|]*)[^()]*\)(\?)?", lambda m: "" if m.group(2) else m.group(1), text, count=1)
        text = re.sub(r".\?|\[ds\]\?", "", re.sub(r"\[ds\]\?| \?", "", text))
        assert re.fullmatch(rule.pattern, text), (rule, text)
        assert all(w in text for w in rule.words), (rule, text)
        texts.append(text)
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        assert [tuple(x) for x in r["detections"]] and licenses.summarised


def test_scan_of_documents_equals_brute_force(spark):
    texts = dict(connect(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    found = queries.QUERIES["op13_license_rules"](spark, SF).collect()
    told = {r["doc_id"]: tuple(r[c] for c in "n_words n_base first_word last_word base_labels labels score".split()) for r in found}
    assert set(told) == set(texts)
    short = {i: t for i, t in texts.items() if len(t or "") < 2000}  # every rule on long texts takes minutes by hand
    assert len(short) > 100 and {i: told[i] for i in short} == {i: scan_by_hand(t) for i, t in short.items()}


def test_scan_stays_in_the_jvm(spark):
    plan = queries.QUERIES["op13_license_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
