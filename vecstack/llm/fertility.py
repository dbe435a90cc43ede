"""Operator 6: tokeniser fertility rules.

A public sub-word vocabulary with byte fallback is run over every word of a document (words repeat,
so each worker keeps the ids of the words it has met).  Three measures follow: characters per
token, share of byte-fallback tokens, and entropy of the tokens relative to the logarithm of their
number.  Grouped aggregation gives each language (or script, where no language is declared) its
quartiles over all documents; a document outside the far fences of its group (three quartile
distances beyond the quartiles) is rejected: below or above for characters per token, above for byte
fallback, below for entropy, which cannot exceed 1.

Defined results: null, empty and blank texts have no words, fail the base rules and have null
measures; a null ``doc_id`` is carried through; every row gives one row; without a ``lang`` column,
or where it is null, the script of most letters is the group.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import cut_lineage, texts
from vecstack.operators.ranges import values_at

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FENCE = 3.0          # quartile distances beyond the quartiles
MIN_SPREAD = {"chars_per_token": 0.01, "byte_share": 0.005, "entropy": 0.01}   # for quartiles that (nearly) coincide
SIDES = {"chars_per_token": ("lo", "hi"), "byte_share": ("hi",), "entropy": ("lo",)}
WORDS_KEPT = 1 << 18

#: First code point of script ranges of Unicode, in order; a range ends where the next begins.
SCRIPTS = [(0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"),
           (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "other"),
           (0x0E00, "thai"), (0x0E80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other")]


def script_of(text: str) -> str:
    """The script of most letters (``none`` without letters)."""
    from bisect import bisect_right
    from collections import Counter
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else "none"
    firsts = [f for f, _ in SCRIPTS]
    n = Counter()
    for c, k in Counter(text).items():
        if c.isalpha():
            n[SCRIPTS[max(0, bisect_right(firsts, ord(c)) - 1)][1]] += k
    return max(n, key=lambda s: (n[s], s)) if n else "none"


class _Words(dict):
    """Token ids of words; byte-fallback ids are known from ``fallback``."""

    def __init__(self, model: bytes):
        import sentencepiece
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        import numpy as np
        self.fallback = np.array([self.model.is_byte(i) for i in range(size)])

    def __missing__(self, word: bytes):
        ids = tuple(self.model.encode(word.decode("utf-8", "replace")))
        if len(word) <= 64:
            self[word] = ids
        return ids


_LOADED: dict = {}


def _words(shared) -> _Words:
    key = hash(shared.value)
    if key not in _LOADED:
        _LOADED[key] = _Words(shared.value)
    return _LOADED[key]


def measures(docs: DataFrame, model_path: str) -> DataFrame:
    """Base counts and token measures of every row of ``docs(doc_id, text[, lang])``."""
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())      # one vocabulary file
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(parts):
        from itertools import chain

        import numpy as np
        import pandas as pd

        from vecstack.llm.textstats import base_stats
        from vecstack.llm.words import Block, blocks, encode
        known = _words(shared)
        for pdf in parts:
            raw = encode(pdf["text"])
            for i, j in blocks(raw):
                if len(known) > WORDS_KEPT:
                    known.clear()
                base = base_stats(Block(raw[i:j], lower=False))
                n_tokens, n_bytes, entropy, script = [], [], [], []
                for b, t in zip(raw[i:j], pdf["text"].iloc[i:j]):
                    ids = np.fromiter(chain.from_iterable(map(known.__getitem__, b.split())), np.int32)
                    c = np.bincount(ids)
                    c = c[c > 0]
                    n = len(ids)
                    n_tokens.append(n)
                    n_bytes.append(int(known.fallback[ids].sum()) if n else 0)
                    entropy.append(float(np.log(n) - (c * np.log(c)).sum() / n) / np.log(n) if n > 1 else None)
                    script.append(script_of(t))
                out = pd.DataFrame({"doc_id": pdf["doc_id"].iloc[i:j].to_numpy(), "lang": pdf["lang"].iloc[i:j].to_numpy(),
                                    **{c: base[c] for c in names}})
                out["n_tokens"], out["n_bytes"], out["entropy"], out["script"] = n_tokens, n_bytes, entropy, script
                yield out

    lang = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                         F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
    schema = "doc_id bigint, lang string, " + ", ".join(f"{c} bigint" for c in names) + \
        ", n_tokens bigint, n_bytes bigint, entropy double, script string"
    return source.mapInPandas(run, schema).select(
        "*", (F.col("word_chars") / F.when(F.col("n_tokens") > 0, F.col("n_tokens"))).alias("chars_per_token"),
        (F.col("n_bytes") / F.when(F.col("n_tokens") > 0, F.col("n_tokens"))).alias("byte_share"),
        F.coalesce("lang", "script").alias("band"))


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


BANDS_BROADCAST = 100_000     # languages and scripts whose bounds may travel to every task


def bands(measured: DataFrame, fence: float = FENCE) -> DataFrame:
    """One row per language or script: the accepted interval of each measure (null: no bound).

    The quartiles are exact (linear between ranks), whatever the partitions."""
    good = measured.where(~_base_failed())
    long = good.select("band", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("x")) for m in MIN_SPREAD])).alias("v")) \
        .select("band", "v.measure", "v.x", F.lit(1).cast("bigint").alias("w")).where("x is not null")
    n_keys = len(MIN_SPREAD) * good.select("band").distinct().count()
    found = values_at(long, ["band", "measure"], "x", "w", [0.25, 0.75], n_keys)
    quartiles = found.groupBy("band").agg(*[F.first(F.when(F.col("measure") == m, F.col("q")), ignorenulls=True).alias(m) for m in MIN_SPREAD])
    cols = []
    for m, least in MIN_SPREAD.items():
        spread = F.greatest(F.col(m)[1] - F.col(m)[0], F.lit(least))
        ends = {"lo": F.col(m)[0] - fence * spread, "hi": F.col(m)[1] + fence * spread}
        cols += [(v if k in SIDES[m] else F.lit(None).cast("double")).alias(f"{m}_{k}") for k, v in ends.items()]
    return quartiles.select("band", *cols)


def judge(docs: DataFrame, model_path: str, fence: float = FENCE) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    chars_per_token, byte_share, entropy, band)`` of every row of ``docs``."""
    m = cut_lineage(measures(docs, model_path))
    inside = F.lit(True)
    for c in MIN_SPREAD:
        inside = inside & F.coalesce(F.col(c) >= F.col(c + "_lo"), F.lit(True)) & F.coalesce(F.col(c) <= F.col(c + "_hi"), F.lit(True))
    limits = cut_lineage(bands(m, fence))
    limits = F.broadcast(limits) if limits.count() <= BANDS_BROADCAST else limits
    return m.join(limits, "band", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", _base_failed().alias("base_failed"),
        (~_base_failed() & inside).alias("kept"), "chars_per_token", "byte_share", "entropy", "band")
