"""Corpus pipeline: the stages a training corpus goes through, in order.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and reread as the ``docs`` of the next stage.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers

from vecstack.llm import bpe, decontaminate, language_id, ngram_join, secrets_scan
from vecstack.llm.common import materialise, read, ship_package


def language_identification(spark, docs, sf_dir):
    """Documents whose language cannot be told go."""
    ship_package(spark)
    return language_id.accepted(docs)


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each group of near copies stays (the smallest id)."""
    ship_package(spark)
    return ngram_join.one_per_component(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs, sf_dir):
    """Secrets are replaced in the text; all documents stay."""
    ship_package(spark)
    return secrets_scan.redacted(docs)


def byte_bpe(spark, docs, sf_dir):
    """Token ids of every document, with the digests of the round trip."""
    ship_package(spark)
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_identification", language_identification),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: Learned likelihoods, compression and token merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage, from the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
