"""License scans by ordered signature rules, in SQL functions."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.arrays import bind, running_max, running_sums

#: What parts words after A-Z are lower-cased.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases that are always reported, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: How often a rule of each priority is right; the first priority is the strongest.
WEIGHTS = (1.0, 0.95, 0.9, 0.75, 0.5)
#: Forms in which a license is named: priority, words that must occur besides the license's own, and the expression.
#: Rules read the words of a text, joined by single spaces, so `2.0` is `2 0`.
FORMS = {
    "tag": (1, "spdx", "spdx license identifier {tag}"),
    "grant": (2, "under", "(?:licen[cs]ed|released|distributed|published|available|provided|covered|shared|offered)(?: [^ ]+){{0,3}} under(?: the)?(?: terms of)?(?: the)?(?: same)? {name}"),
    "subject": (2, "subject", "subject to(?: the)?(?: terms of)?(?: the)? {name}"),
    "url": (2, "", "{url}"),
    "name": (3, "", "{name}"),
    "short": (4, "licen", "{tag} licen[cs]e[ds]?"),
    "under": (4, "licen", "licen[cs]e(?: is)? {tag}"),
}

#: Versions a family of licenses may carry: label suffix and expression.
VERSION = "(?: ?(?:version|ver|v))? ?{0}"

#: Families: label, word of the prefilter, names, tags, addresses, versions. Fixed values.
FAMILIES = (
    ("mit", "mit", "mit licen[cs]e", "mit", "opensource org licenses mit", ()),
    ("mit", "expat", "expat licen[cs]e", "expat", "directory fsf org wiki license expat", ()),
    ("mit-0", "attribution", "mit no attribution(?: licen[cs]e)?", "mit 0", "opensource org licenses mit 0", ()),
    ("x11", "x11", "x11 licen[cs]e", "x11", "x org licenses x11", ()),
    ("isc", "isc", "isc licen[cs]e", "isc", "opensource org licenses isc", ()),
    ("apache", "apache", "apache(?: software)? licen[cs]e", "apache", "apache org licenses license", ("1 0", "1 1", "2 0")),
    ("gpl", "gnu", "gnu (?:general public licen[cs]e|gpl)", "gpl", "gnu org licenses gpl", ("1", "2", "3")),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e", "lgpl", "gnu org licenses lgpl", ("2", "2 1", "3")),
    ("lgpl-library", "library", "(?:gnu )?library general public licen[cs]e", "lgpl library", "gnu org licenses old licenses lgpl", ("2",)),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", "agpl", "gnu org licenses agpl", ("1", "3")),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e", "gfdl", "gnu org licenses fdl", ("1 1", "1 2", "1 3")),
    ("bsd", "bsd", "(?:new |modified |simplified |original )?bsd licen[cs]e", "bsd", "opensource org licenses bsd license", ()),
    ("bsd-2-clause", "clause", "(?:bsd 2|2|two) clause(?: bsd)? licen[cs]e", "bsd 2 clause", "opensource org licenses bsd 2 clause", ()),
    ("bsd-3-clause", "clause", "(?:bsd 3|3|three) clause(?: bsd)? licen[cs]e", "bsd 3 clause", "opensource org licenses bsd 3 clause", ()),
    ("bsd-4-clause", "clause", "(?:bsd 4|4|four) clause(?: bsd)? licen[cs]e", "bsd 4 clause", "directory fsf org wiki license bsd 4clause", ()),
    ("0bsd", "zero", "zero clause bsd(?: licen[cs]e)?", "0bsd", "opensource org licenses 0bsd", ()),
    ("mpl", "mozilla", "mozilla public licen[cs]e", "mpl", "mozilla org mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public licen[cs]e", "epl", "eclipse org legal epl", ("1 0", "2 0")),
    ("edl", "eclipse", "eclipse distribution licen[cs]e", "edl", "eclipse org org documents edl", ("1 0",)),
    ("cddl", "development", "common development and distribution licen[cs]e", "cddl", "opensource org licenses cddl", ("1 0", "1 1")),
    ("cpl", "common", "common public licen[cs]e", "cpl", "opensource org licenses cpl", ("1 0",)),
    ("eupl", "european", "european union public licen[cs]e", "eupl", "joinup ec europa eu software page eupl", ("1 1", "1 2")),
    ("artistic", "artistic", "artistic licen[cs]e", "artistic", "opensource org licenses artistic license", ("1 0", "2 0")),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "zlib", "zlib net zlib license", ()),
    ("boost", "boost", "boost software licen[cs]e", "bsl", "boost org license", ("1 0",)),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql", "opensource org licenses postgresql", ()),
    ("python", "python", "python software foundation licen[cs]e", "psf", "docs python org license", ("2",)),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby", "ruby lang org license", ()),
    ("php", "php", "php licen[cs]e", "php", "php net license", ("3 0", "3 01")),
    ("ofl", "font", "(?:sil )?open font licen[cs]e", "ofl", "scripts sil org ofl", ("1 0", "1 1")),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense org", ()),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl net", ("2",)),
    ("odbl", "database", "open (?:data commons open )?database licen[cs]e", "odbl", "opendatacommons org licenses odbl", ("1 0",)),
    ("odc-by", "commons", "open data commons attribution licen[cs]e", "odc by", "opendatacommons org licenses by", ("1 0",)),
    ("pddl", "public", "(?:open data commons )?public domain dedication and licen[cs]e", "pddl", "opendatacommons org licenses pddl", ("1 0",)),
    ("cc0", "cc0", "cc0(?: licen[cs]e)?", "cc0", "creativecommons org publicdomain zero", ("1 0",)),
    ("cc0", "zero", "(?:creative commons|cc) zero(?: licen[cs]e)?", "cc zero", "creativecommons org share your work public domain cc0", ("1 0",)),
    ("cc-by", "cc", "cc by(?: licen[cs]e)?", "cc by", "creativecommons org licenses by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc", "cc by sa(?: licen[cs]e)?", "cc by sa", "creativecommons org licenses by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc", "cc by nc(?: licen[cs]e)?", "cc by nc", "creativecommons org licenses by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc", "cc by nd(?: licen[cs]e)?", "cc by nd", "creativecommons org licenses by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: licen[cs]e)?", "cc by nc sa", "creativecommons org licenses by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: licen[cs]e)?", "cc by nc nd", "creativecommons org licenses by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-attribution", "attribution", "creative commons attribution(?: licen[cs]e)?", "cc attribution", "creativecommons org about cclicenses", ("2 0", "3 0", "4 0")),
)

#: Sentences of license texts and notices: label, priority, words of the prefilter, expression. Fixed values.
SENTENCES = (
    ("mit", 2, "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 2, "permission to use", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 2, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 2, "endorse", "neither the name of(?: [^ ]+){1,12} may be used to endorse or promote products"),
    ("gpl", 2, "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 2, "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("gpl", 3, "any later", "either version [0-9](?: [0-9])? of the license or at your option any later version"),
    ("apache", 2, "except in compliance", "you may not use this file except in compliance with the license"),
    ("mpl", 2, "source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("boost", 2, "machine-executable", "machine executable object code generated by a source language processor"),
    ("unlicense", 2, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", 4, "public domain", "(?:in|into|to) the public domain"),
    ("public-domain", 3, "dedicated", "dedicated to the public domain"),
    ("proprietary", 4, "rights reserved", "all rights reserved"),
    ("proprietary", 3, "confidential", "proprietary and confidential"),
    ("copyright-notice", 5, "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}"),
    ("no-warranty", 5, "warranty", "without (?:any )?warranty(?: of any kind)?"),
    ("dual", 4, "dual", "dual licen[cs]ed"),
    ("non-commercial", 4, "commercial", "(?:for )?non commercial use only"),
    ("no-derivatives", 5, "derivative", "no derivative works?"),
)


@dataclass(frozen=True)
class Rule:
    """`words`: parts of the text without which the expression cannot match."""

    label: str
    priority: int
    words: tuple[str, ...]
    pattern: str


def whole(expression: str) -> str:
    """Between whole words."""
    return f"(?<![^ ])(?:{expression})(?![^ ])"


def rules() -> list[Rule]:
    """All rules, the stronger ones of equal priority first: every family in every form, with each version and without."""
    out = []
    for label, word, name, tag, url, versions in FAMILIES:
        for version in (*versions, None):
            end = "" if version is None else VERSION.format(version)
            named = label if version is None else f"{label}-{version.replace(' ', '.')}"
            for priority, needed, form in FORMS.values():
                own = word if "{name}" in form else (url if "{url}" in form else tag).split()[0]
                pattern = form.format(name=name + end, tag=tag + end, url=url + end)
                out.append(Rule(named, priority, tuple(w for w in (own, needed) if w), whole(pattern)))
    out += [Rule(label, priority, (words.replace("-", " "),), whole(expression)) for label, priority, words, expression in SENTENCES]
    return sorted(out, key=lambda r: r.priority)


def _literal(told: list[Rule]) -> Column:
    """The rules as one constant; hundreds of columns of their own would take seconds to plan."""
    said = json.dumps([{**asdict(r), "rule": i} for i, r in enumerate(told)])
    return F.from_json(F.lit(said), "array<struct<label:string,priority:int,words:array<string>,pattern:string,rule:int>>")


def words_of(text: Column) -> Column:
    """The words of a text joined by single spaces; only A-Z are lower-cased, null is empty."""
    upper = "".join(chr(c) for c in range(0x41, 0x5B))
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), GAPS, " "))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def found(words: Column, rule: Column) -> Column:
    """Places of a rule's matches: `start` and `end` in words from 0, the end exclusive."""
    def placed(matches: Column) -> Column:
        between = F.transform(F.split(words, rule["pattern"], -1), spaces)
        steps = F.transform(matches, lambda m, i: F.get(between, i) + F.when(i > 0, spaces(F.get(matches, i - 1))).otherwise(0))
        return bind(running_sums(steps), lambda at: F.transform(matches, lambda m, i: F.struct(
            F.get(at, i).alias("start"), (F.get(at, i) + spaces(m) + 1).alias("end"), rule["priority"].alias("priority"),
            rule["rule"].alias("rule"), rule["label"].alias("label"))))

    return bind(F.regexp_extract_all(words, rule["pattern"], F.lit(0)), placed)


def resolved(detections: Column) -> Column:
    """Drop every detection whose words lie inside those of another one of the same or a stronger priority; of equal
    places the strongest rule stays, the first one of several."""
    def kept(ranked: Column) -> Column:
        # Whatever holds a place stands before it: the furthest end so far of each strength tells.
        def upto(priority: int) -> Column:
            return running_max(F.transform(ranked, lambda x: F.when(x["priority"] <= priority, x["end"]).otherwise(-1)))

        reach = F.array(*(upto(p + 1) for p in range(len(WEIGHTS))))
        return bind(reach, lambda r: F.filter(ranked, lambda x, i: (i == 0) | (F.get(F.get(r, x["priority"] - 1), i - 1) < x["end"])))

    order = F.array_sort(F.transform(detections, lambda x: F.struct(x["start"], (-x["end"]).alias("minus"), x["priority"], x["rule"], x["label"], x["end"])))
    return bind(order, lambda ranked: F.when(F.size(ranked) > 0, kept(ranked)).otherwise(ranked))


_PLACES = "array<struct<start:int,end:int,priority:int,rule:int,label:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License signatures in every text: id, `n_words`, `base` and `detections`, arrays of (start, end, priority, rule, label).

    `base` holds all places of the phrases of `BASE`. A rule of `rules()` is tried only on texts that hold its words
    (the prefilter); overlapping detections are resolved by priority and containment. All is done in the row, by
    SQL functions; nothing is shuffled.

    Null texts count as empty and have no words and no places. Repeated rows and null ids are rows of their own. Equal
    places go to the strongest rule. Very long texts are one row each, and are read once for each rule they can match.
    An empty table gives an empty result; further columns are ignored.
    """
    told = rules()
    held = sorted({w for r in told for w in r.words})
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    phrases = _literal([Rule(label, 1, (phrase,), whole(phrase)) for phrase, label in BASE.items()])
    none = F.array().cast(_PLACES)
    rows = rows.select("id", "words", F.when(F.col("words") == "", 0).otherwise(spaces(F.col("words")) + 1).cast("long").alias("n_words"),
                       F.filter(F.from_json(F.lit(json.dumps(held)), "array<string>"), lambda w: F.contains(F.col("words"), w)).alias("held"))
    base = F.flatten(F.transform(F.filter(phrases, lambda r: F.contains(F.col("words"), F.get(r["words"], 0))), lambda r: found(F.col("words"), r)))
    gated = F.filter(_literal(told), lambda r: F.size(F.array_except(r["words"], F.col("held"))) == 0)
    rows = rows.select("id", "words", "n_words", base.cast(_PLACES).alias("base"), F.when(F.size("held") > 0, gated).alias("gated"))
    places = F.when(F.size("gated") > 0, F.flatten(F.transform("gated", lambda r: found(F.col("words"), r))).cast(_PLACES)).otherwise(none)
    rows = rows.select("id", "n_words", "base", places.alias("places"))
    hits = F.when(F.size("places") > 0, F.transform(resolved(F.col("places")), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["priority"].alias("priority"), x["rule"].alias("rule"), x["label"].alias("label"))).cast(_PLACES)).otherwise(none)
    return rows.select(F.col("id").alias(id_col), "n_words", "base", hits.alias("detections"))


def summarised(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each text of `scan`: id, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score` (the
    weight of its strongest detection)."""
    starts = F.col("base.start")
    best = F.aggregate("detections", F.lit(0.0), lambda a, x: F.greatest(a, F.element_at(F.array(*map(F.lit, WEIGHTS)), x["priority"])))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
                          F.array_max(starts).cast("long").alias("last_word"), joined(F.col("base.label")).alias("base_labels"),
                          joined(F.concat("base.label", "detections.label")).alias("labels"), best.alias("score"))
