"""Operator 7: language identification by Bayesian evidence fusion.

Four kinds of evidence are combined on the log scale:

* text: hashed byte-trigram likelihoods, learned from the declared languages of all documents by
  grouped sums;
* the declared (markup) language, with the reliability measured over the corpus;
* the address suffix, as ``P(language | suffix)``;
* the host: counts of the text's verdicts per host, smoothed towards its domain, that towards its
  suffix, that towards the corpus (grouped aggregations all the way).

A document is rejected if no letters are left, if its text is less likely than uniform noise under
every language, or if the best posterior is below ``MIN_POSTERIOR``.

Defined results: null or empty texts are rejected (language null, posterior null); null declared
languages, addresses and hosts give no evidence; a null ``doc_id`` is carried through; every row
gives one row; without any declared language everything is rejected.  Ties go to the language that
sorts first.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import batches_of, cut_lineage, without_ids

BUCKETS = 1 << 14            # hashed trigrams
ALPHA = 0.5                  # pseudo-count of a bucket
EVIDENCE_TRIGRAMS = 60.0     # a text counts as this many independent trigrams at most
HOST_MASS = 20.0             # pseudo-documents of the parent's distribution
MIN_POSTERIOR = 0.5
SLICE = 1000                 # texts handed to a Python worker at once
MAX_MODEL_BYTES = 256 << 20  # of the broadcast likelihoods (BUCKETS x languages)

_FOLD = np.arange(256, dtype=np.uint8)       # bytes of ASCII letters in lower case, other ASCII as space
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def trigrams(raw: list[bytes]):
    """``(bucket, text number)`` of every trigram of folded bytes that is not mostly blank."""
    joined = _FOLD[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)].astype(np.uint32)
    size = np.fromiter((len(b) + 1 for b in raw), np.int64, len(raw))
    doc = np.repeat(np.arange(len(raw)), size)
    a, b, c = joined[:-2], joined[1:-1], joined[2:]
    use = ((a != 32).astype(np.int8) + (b != 32) + (c != 32) >= 2) & (doc[:-2] == doc[2:])
    h = (a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(2654435761)
    return (h >> np.uint32(18))[use].astype(np.int64), doc[:-2][use]


def evidence_columns(docs: DataFrame, declared: str | None, host: str | None) -> DataFrame:
    """``(doc_id, text, declared, host, domain, suffix)``; lower-cased, absent ones null."""
    column = lambda c: F.lower(F.trim(docs[c].cast("string"))) if c else F.lit(None).cast("string")
    d = F.regexp_extract(column(declared), "^([a-z]+)", 1)
    out = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
                      F.when(d != "", d).alias("declared"), column(host).alias("host"))
    dotted = F.col("host").contains(".")
    return out.withColumn("domain", F.when(dotted, F.substring_index("host", ".", -2))) \
        .withColumn("suffix", F.when(dotted, F.substring_index("host", ".", -1)))


class Likelihoods:
    """Log-likelihoods of trigram buckets for each language."""

    def __init__(self, languages: list[str], counts):
        self.languages = languages
        p = (counts + ALPHA) / (counts.sum(axis=0) + ALPHA * BUCKETS)
        self.log = np.log(p).astype(np.float32)

    def text_evidence(self, raw: list[bytes]):
        """``(trigrams, mean log-likelihood per language)`` of each text."""
        bucket, doc = trigrams(raw)
        n = np.bincount(doc, minlength=len(raw))
        sums = np.column_stack([np.bincount(doc, self.log[bucket, k], len(raw)) for k in range(len(self.languages))]) \
            if self.languages else np.zeros((len(raw), 0))
        return n, sums / np.maximum(n, 1)[:, None]


def learn(docs: DataFrame) -> Likelihoods:
    """Trigram counts of every declared language over all texts of ``docs`` (evidence columns)."""
    schema = "language string, bucket int, n bigint"

    def count(parts):
        import pandas as pd

        from vecstack.llm.words import blocks, encode
        total: dict = {}
        for pdf in parts:
            raw, lang = encode(pdf["text"]), pdf["declared"].tolist()
            for i, j in blocks(raw):
                bucket, doc = trigrams(raw[i:j])
                names = sorted(set(lang[i:j]))
                code = np.array([names.index(x) for x in lang[i:j]])
                n = np.bincount(code[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    total[name] = total.get(name, 0) + n[k * BUCKETS:(k + 1) * BUCKETS]
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"language": name, "bucket": at.astype(np.int32), "n": n[at]})

    with batches_of(docs.sparkSession, SLICE):
        counted = cut_lineage(docs.where("declared is not null").select("declared", "text").mapInPandas(count, schema)
                              .groupBy("language", "bucket").agg(F.sum("n").alias("n")))
    languages = [r["language"] for r in counted.select("language").distinct().orderBy("language").collect()]
    if len(languages) * BUCKETS * 4 > MAX_MODEL_BYTES:
        raise ValueError(f"{len(languages)} declared languages: the model would pass {MAX_MODEL_BYTES} bytes")
    table = np.zeros((BUCKETS, len(languages)))
    rows = counted.toPandas()                       # at most BUCKETS rows per language
    if len(rows):
        code = {x: k for k, x in enumerate(languages)}
        table[rows["bucket"], rows["language"].map(code)] = rows["n"]
    return Likelihoods(languages, table)


def text_scores(docs: DataFrame, model: Likelihoods) -> DataFrame:
    """Evidence columns without the text, plus ``n`` trigrams, ``mean`` log-likelihoods and the
    text's own verdict ``guess`` (null without letters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        import pandas as pd

        from vecstack.llm.words import blocks, encode
        for pdf in parts:
            raw = encode(pdf["text"])
            for i, j in blocks(raw):
                n, mean = shared.value.text_evidence(raw[i:j])
                best = mean.argmax(axis=1) if mean.shape[1] else np.zeros(j - i, int)
                names = shared.value.languages
                out = pdf.iloc[i:j][["doc_id", "declared", "host", "domain", "suffix"]].copy()
                out["n"], out["mean"] = n, list(mean)
                out["guess"] = [names[b] if k and names else None for b, k in zip(best, n)]
                yield out

    return docs.mapInPandas(run, "doc_id bigint, declared string, host string, domain string, suffix string, "
                                 "n bigint, mean array<double>, guess string")


def host_priors(scores: DataFrame, languages: list[str]) -> DataFrame:
    """``(host, prior ARRAY<DOUBLE>)``: language shares of each host, smoothed level by level."""
    counted = scores.where("guess is not null").groupBy("host", "domain", "suffix", "guess").count()
    vector = F.array(*[F.sum(F.when(F.col("guess") == x, F.col("count")).otherwise(0)).cast("double") for x in languages])
    level = lambda *keys: counted.groupBy(*keys).agg(vector.alias("v"))
    n = counted.agg(vector.alias("v")).first()["v"]
    mass = sum(x or 0.0 for x in n) + len(languages)
    root = F.array(*[F.lit(((x or 0.0) + 1.0) / mass) for x in n])          # of the whole corpus
    share = lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda a, b: a + b))
    smooth = lambda v, parent: share(F.transform(F.arrays_zip(v.alias("own"), parent.alias("up")),
                                                 lambda x: x["own"] + HOST_MASS * x["up"]))
    suffix = level("suffix").where("suffix is not null").select("suffix", smooth(F.col("v"), root).alias("p1"))
    domain = level("domain", "suffix").where("domain is not null").join(suffix, "suffix") \
        .select("domain", smooth(F.col("v"), F.col("p1")).alias("p2"))
    host = level("host", "domain").where("host is not null").join(domain, "domain", "left")
    return host.select("host", smooth(F.col("v"), F.coalesce("p2", root)).alias("prior"))


def suffix_shares(scores: DataFrame, languages: list[str]) -> DataFrame:
    """``(suffix, by_suffix ARRAY<DOUBLE>)``: language shares of the declared languages per suffix."""
    n = scores.where("suffix is not null and declared is not null")
    sums = [F.sum((F.col("declared") == x).cast("double")) for x in languages]
    return n.groupBy("suffix").agg(F.array(*[(s + 1.0) / (F.count("*") + len(languages)) for s in sums]).alias("by_suffix"))


def identify(docs: DataFrame, declared: str | None = "lang", host: str | None = "source",
             model: Likelihoods | None = None, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``(doc_id, language, posterior, text_language, kept)`` of every row of ``docs``.

    ``model``: likelihoods learned elsewhere; by default they are learned from ``docs``."""
    docs = evidence_columns(docs, declared, host)
    model = learn(docs) if model is None else model
    names = model.languages
    if not names:
        return docs.select("doc_id", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("kept"))
    with batches_of(docs.sparkSession, SLICE):
        scores = cut_lineage(text_scores(docs, model))
    agree = scores.where("declared is not null and guess is not null").agg(F.avg((F.col("declared") == F.col("guess")).cast("double"))).first()[0]
    trust = min(0.99, max(0.5, agree if agree is not None else 0.5))
    other = (1 - trust) / max(1, len(names) - 1)
    known = scores.join(host_priors(scores, names), "host", "left").join(suffix_shares(scores, names), "suffix", "left")
    flat = F.array(*[F.lit(1.0 / len(names))] * len(names))
    label = F.array(*map(F.lit, names))
    log = F.transform(F.arrays_zip(F.col("mean").alias("m"), F.coalesce("prior", flat).alias("p"), F.coalesce("by_suffix", flat).alias("s"), label.alias("name")),
                      lambda x: F.least("n", F.lit(EVIDENCE_TRIGRAMS)) * x["m"] + F.log(x["p"]) + F.log(x["s"])
                      + F.when(F.col("declared").isNull() | ~F.array_contains(label, F.col("declared")), 0.0)
                      .when(F.col("declared") == x["name"], float(np.log(trust))).otherwise(float(np.log(other or 1e-9))))
    known = known.withColumn("log", log).withColumn("peak", F.array_max("log"))
    total = F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("peak")))
    best = F.element_at(label, F.array_position("log", F.col("peak")).cast("int"))
    some = F.col("n") > 0
    likely = F.array_max("mean") > float(-np.log(BUCKETS))
    return known.select("doc_id", F.when(some, best).alias("language"), F.when(some, 1.0 / total).alias("posterior"),
                        F.col("guess").alias("text_language"),
                        F.coalesce(some & likely & (1.0 / total >= min_posterior), F.lit(False)).alias("kept"))


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is not rejected; rows without an id stay only if their
    text has a letter (they cannot be looked up)."""
    gone = identify(docs, **options).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("any")) \
        .where("not any")
    rest = docs.where(docs["doc_id"].isNotNull() | docs["text"].cast("string").rlike(r"\p{L}"))
    return without_ids(rest, gone, "doc_id")


def page_documents(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` as ``(doc_id, text, markup_language, host)``."""
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " ")
    return pages.select(F.col("page_id").alias("doc_id"), F.regexp_replace(body, r"(?s)<[^>]*>", " ").alias("text"),
                        F.regexp_extract("html", r"""(?i)<html[^>]*\blang\s*=\s*["']?([A-Za-z-]+)""", 1).alias("markup_language"),
                        F.lower(F.regexp_extract("url", r"(?i)^[a-z]+://(?:[^/@]*@)?([^/:?#]+)", 1)).alias("host"))
