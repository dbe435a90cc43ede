"""Operator 9: license scan by ordered signature rules, in DataFrame functions only.

Texts become word sequences (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, joined
by one blank).  Rules are regular expressions over that sequence in order of priority; each names a
keyword, and only texts that hold it (a plain substring test) see the expression.  Every match is a
detection with a word interval.  Sorted by start, longer first, then priority, a detection inside one
that comes before it is suppressed, so "gnu lesser general public license version 3" does not also
count as a rule for its parts.  The phrase rules of ``BASE`` are counted by themselves and never
suppressed.

The rules are ``SPDX`` ids after their tag, ``FAMILIES`` times ``TEMPLATES``, and ``SHORT`` names.  Nothing is shuffled.

Defined results: null or empty texts have no words, null ``first_word`` and ``last_word``, empty
label strings and score 0; a null ``doc_id`` is carried through; every row gives one row.  Extra
columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import texts

#: Phrases that are counted everywhere they stand, and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: Hand-written signatures: label, keyword that gates them, names as regular expressions over words.
FAMILIES = [
    ("agpl", "affero", [r"gnu affero general public licen[cs]e", r"affero general public licen[cs]e"]),
    ("lgpl", "lesser", [r"gnu lesser general public licen[cs]e", r"lesser general public licen[cs]e"]),
    ("lgpl", "library general", [r"gnu library general public licen[cs]e", r"library general public licen[cs]e"]),
    ("gfdl", "free documentation", [r"gnu free documentation licen[cs]e"]),
    ("gpl", "general public", [r"gnu general public licen[cs]e"]),
    ("gpl", "gnu", [r"gnu gpl", r"gnu public licen[cs]e"]),
    ("apache", "apache", [r"apache licen[cs]e", r"apache software licen[cs]e"]),
    ("mit", "mit licen", [r"mit licen[cs]e"]),
    ("mit", "mit x11", [r"mit x11 licen[cs]e"]),
    ("mit", "permission is hereby granted", [r"permission is hereby granted free of charge to any person obtaining a copy"]),
    ("bsd-3-clause", "bsd", [r"bsd 3 clause(?: licen[cs]e)?", r"3 clause bsd(?: licen[cs]e)?", r"new bsd licen[cs]e", r"modified bsd licen[cs]e", r"revised bsd licen[cs]e"]),
    ("bsd-2-clause", "bsd", [r"bsd 2 clause(?: licen[cs]e)?", r"2 clause bsd(?: licen[cs]e)?", r"simplified bsd licen[cs]e", r"freebsd licen[cs]e"]),
    ("bsd", "bsd", [r"bsd licen[cs]e", r"bsd style licen[cs]e"]),
    ("bsd", "redistribution and use", [r"redistribution and use in source and binary forms"]),
    ("mpl", "mozilla", [r"mozilla public licen[cs]e"]),
    ("epl", "eclipse", [r"eclipse public licen[cs]e"]),
    ("cddl", "development and distribution", [r"common development and distribution licen[cs]e"]),
    ("cpl", "common public", [r"common public licen[cs]e"]),
    ("isc", "isc licen", [r"isc licen[cs]e"]),
    ("zlib", "zlib", [r"zlib licen[cs]e", r"zlib libpng licen[cs]e"]),
    ("boost", "boost", [r"boost software licen[cs]e"]),
    ("unlicense", "unlicense", [r"the unlicense"]),
    ("artistic", "artistic", [r"artistic licen[cs]e", r"perl artistic licen[cs]e"]),
    ("eupl", "european union public", [r"european union public licen[cs]e"]),
    ("osl", "open software licen", [r"open software licen[cs]e"]),
    ("wtfpl", "do what the", [r"do what the \S+ you want to public licen[cs]e"]),
    ("ofl", "open font", [r"sil open font licen[cs]e", r"open font licen[cs]e"]),
    ("psf", "python software", [r"python software foundation licen[cs]e"]),
    ("odbl", "open database", [r"open database licen[cs]e"]),
    ("cc0", "cc0", [r"cc0(?: 1 0)?(?: universal)?"]),
    ("cc-by-nc-sa", "nc sa", [r"cc by nc sa"]),
    ("cc-by-nc-nd", "nc nd", [r"cc by nc nd"]),
    ("cc-by-nc", "by nc", [r"cc by nc"]),
    ("cc-by-nd", "by nd", [r"cc by nd"]),
    ("cc-by-sa", "by sa", [r"cc by sa"]),
    ("cc-by", "cc by", [r"cc by"]),
    ("cc-by-nc-sa", "creative commons", [r"creative commons attribution non ?commercial share ?alike"]),
    ("cc-by-nc-nd", "creative commons", [r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?"]),
    ("cc-by-nc", "creative commons", [r"creative commons attribution non ?commercial"]),
    ("cc-by-sa", "creative commons", [r"creative commons attribution share ?alike"]),
    ("cc-by-nd", "creative commons", [r"creative commons attribution no ?deriv(?:ative)?s?"]),
    ("cc-by", "creative commons", [r"creative commons attribution"]),
    ("cc", "creative commons", [r"creative commons"]),
    ("public-domain", "public domain", [r"public domain", r"dedicated to the public domain"]),
    ("proprietary", "all rights reserved", [r"all rights reserved"]),
    ("copyright", "copyright", [r"copyright(?: c)? (?:19|20)[0-9][0-9]"]),
]

#: SPDX ids as words, after the tag: label and expression.
_REST = r"(?: only| or later)?"
SPDX = [("agpl", r"agpl [13] 0" + _REST), ("lgpl", r"lgpl (?:2 0|2 1|3 0)" + _REST), ("gfdl", r"gfdl 1 [123]" + _REST),
        ("gpl", r"gpl [123] 0" + _REST), ("apache", r"apache (?:1 0|1 1|2 0)"), ("mit", r"mit(?: 0)?"), ("isc", r"isc"),
        ("bsd-3-clause", r"bsd 3 clause"), ("bsd-2-clause", r"bsd 2 clause"), ("bsd", r"0bsd"), ("mpl", r"mpl (?:1 0|1 1|2 0)"),
        ("epl", r"epl [12] 0"), ("cddl", r"cddl 1 [01]"), ("cpl", r"cpl 1 0"), ("zlib", r"zlib"), ("boost", r"bsl 1 0"),
        ("unlicense", r"unlicense"), ("artistic", r"artistic [12] 0"), ("eupl", r"eupl 1 [012]"), ("osl", r"osl [123] [01]"),
        ("wtfpl", r"wtfpl"), ("ofl", r"ofl 1 [01]"), ("psf", r"psf 2 0"), ("odbl", r"odbl 1 0"), ("cc0", r"cc0 1 0")]

#: Short names: label, keyword, expression.
SHORT = [("agpl", "agpl", r"agpl ?v?[13](?: 0)?"), ("lgpl", "lgpl", r"lgpl ?v?[23](?: [01])?"), ("gpl", "gpl", r"gpl ?v?[123](?: 0)?"),
         ("apache", "apache", r"apache ?v?2(?: 0)?"), ("mpl", "mpl", r"mpl ?v?[12](?: [01])?"), ("mit", "under mit", r"under mit"),
         ("mit", "under the mit", r"under the mit"), ("mit", "mit licensed", r"mit licensed"), ("bsd", "under bsd", r"under bsd")]

#: Every signature holds one of these; a text without them is not looked at further.
ATOMS = ["licen", "public", "reserved", "copyright", "commons", "cc", "permission", "redistribution", "bsd", "gpl",
         "apache", "mit", "mpl"]

#: Ways a name is used, most telling first: pattern around the name and confidence.
TEMPLATES = [
    (r"spdx licen[cs]e identifier {0}{1}", 1.0),
    (r"(?:is |are )?(?:licensed|released|distributed|available|published|provided|made available) under (?:the )?(?:terms of (?:the )?)?{0}{1}", 0.95),
    (r"(?:under|subject to) the terms (?:and conditions )?of (?:the )?{0}{1}", 0.9),
    (r"{0} (?:version|v) [0-9]+(?: [0-9]+)?(?: or (?:any )?later(?: version)?)?", 0.85),
    (r"{0}", 0.7),
]
_VERSION = r"(?: (?:version |v)?[0-9]+(?: [0-9]+)?)?(?: or (?:any )?later(?: version)?)?(?: international)?"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules() -> list[dict]:
    """All rules in order of priority: SPDX ids, telling templates in the order of the families, short names."""
    out: list[dict] = []

    def add(label, keyword, sure, regex):
        out.append({"priority": len(out), "label": label, "keyword": keyword, "confidence": sure, "regex": rf"(?<![^ ]){regex}(?![^ ])"})

    for label, name in SPDX:
        for spelled in ("license", "licence"):
            add(label, f"spdx {spelled} identifier", 1.0, f"spdx {spelled} identifier (?:{name})")
    for around, sure in TEMPLATES:
        for label, keyword, names in FAMILIES:
            for name in names:
                add(label, keyword, sure, around.format(f"(?:{name})", _VERSION))
    for label, keyword, name in SHORT:
        add(label, keyword, 0.7, name)
    return out


def word_sequence(text: Column) -> Column:
    """The words of a text in lower case (A-Z only), joined by one blank."""
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


_MARK = "\x01"         # never in a sequence of words
BLOCK = 64             # detections suppressed together


def _places(words: Column, regex: Column) -> Column:
    """``array<struct<start, n>>``: word intervals of the matches of ``regex`` in ``words``, in time linear in the text:
    the first word of every match is marked, and the marked words are found by their place."""
    match = F.regexp_extract_all(words, regex, F.lit(0))
    marked = F.split(F.regexp_replace(words, regex, F.lit(_MARK + "$0")), " ", -1)
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(_MARK)), i)), lambda i: i.isNotNull())
    n = F.transform(match, lambda m: F.length(m) - F.length(F.replace(m, F.lit(" "))) + 1)
    return F.transform(F.arrays_zip(starts.alias("s"), n.alias("n")), lambda x: F.struct(x["s"].cast("int").alias("start"), x["n"].cast("int").alias("n")))


def _uncontained(ordered: Column, found: str) -> Column:
    """The detections that do not end inside an earlier one of ``ordered`` (by start, the longer first).

    They are taken in blocks of ``BLOCK``; each begins with the last end of the blocks before, so the time stays
    near linear in the detections."""
    end = lambda h: h["start"] - h["shorter"]
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(ordered) - 1) / BLOCK).cast("int"))),
                         lambda b: F.slice(ordered, b * BLOCK + 1, BLOCK))
    before = F.aggregate(
        blocks, F.struct(F.lit(-1).alias("m"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct(F.greatest(a["m"], F.array_max(F.transform(x, end))).alias("m"), F.concat(a["out"], F.array(a["m"])).alias("out")))["out"]
    kept = lambda block, last: F.aggregate(
        block, F.struct(last.alias("end"), F.array().cast(found).alias("out")),
        lambda a, h: F.when(end(h) <= a["end"], a).otherwise(F.struct(
            end(h).alias("end"),
            F.concat(a["out"], F.array(F.struct(h["start"].alias("start"), (-h["shorter"]).alias("n"), h["priority"].alias("priority"),
                                                h["label"].alias("label"), h["confidence"].alias("confidence")))).alias("out"))))["out"]
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), before.alias("last")), lambda x: kept(x["block"], x["last"])))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, base, detections)`` of every row of ``docs(doc_id, text)``.

    ``base``: every place of a base phrase; ``detections``: those of the rules left by suppression
    (``start``, ``n`` words, ``priority``, ``label``, ``confidence``)."""
    table = rules()
    low = F.lower("text")
    some = F.lit(False)
    for atom in ATOMS:
        some = some | F.contains(low, F.lit(atom))
    parts = F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)       # empty ones only at the ends
    seq = texts(docs).select("doc_id", F.when(some, word_sequence(F.col("text"))).alias("_w"), F.size(F.filter(parts, lambda x: x != "")).alias("_n"))
    gate = F.col("_w").isNotNull()
    place = "array<struct<start:int,n:int,label:string>>"
    found = "array<struct<start:int,n:int,priority:int,label:string,confidence:double>>"
    named = lambda label: lambda x: F.struct(x["start"], x["n"], F.lit(label).alias("label"))
    base = F.concat(*[
        F.when(F.contains(F.col("_w"), F.lit(p)), F.transform(_places(F.col("_w"), F.lit(rf"(?<![^ ]){p}(?![^ ])")), named(label)))
        .otherwise(F.array().cast(place)) for p, label in BASE])
    rule = F.from_json(F.lit(json.dumps(table)), "array<struct<priority:int,label:string,keyword:string,confidence:double,regex:string>>")
    open_rules = F.filter(rule, lambda r: F.contains(F.col("_w"), r["keyword"]))
    hits = F.flatten(F.transform(open_rules, lambda r: F.transform(
        _places(F.col("_w"), r["regex"]),
        lambda x: F.struct(x["start"], x["n"], r["priority"].alias("priority"), r["label"].alias("label"), r["confidence"].alias("confidence")))))
    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"], (-h["n"]).alias("shorter"), h["priority"], h["label"], h["confidence"])))
    kept = F.transform(F.array(ordered), lambda o: _uncontained(o, found))[0]      # a lambda's argument is evaluated once
    return seq.select("doc_id", F.col("_n").cast("bigint").alias("n_words"),
                      F.when(gate, base).otherwise(F.array().cast(place)).alias("base"),
                      F.when(gate, kept).otherwise(F.array().cast(found)).alias("detections"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base places, labels of the base and of the rules, score."""
    labels = lambda c: F.transform(F.col(c), lambda x: x["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    doubt = F.aggregate("detections", F.lit(1.0), lambda a, x: a * (1.0 - x["confidence"]))
    starts = F.transform("base", lambda x: x["start"].cast("bigint"))
    return scan(docs).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(labels("base")).alias("base_labels"), joined(F.concat(labels("base"), labels("detections"))).alias("labels"),
        F.greatest(F.round(1.0 - doubt, 6), F.when(F.size("base") > 0, 0.7).otherwise(0.0)).alias("score"))
