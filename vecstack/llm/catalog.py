"""Registered queries of the pipeline operators: name -> ``(spark, sf_dir) -> DataFrame``.

Each query applies its operator with the production parameters to its whole table.
"""

from __future__ import annotations

import public_tokenizers

from vecstack.llm import (bpe, curriculum, decontaminate, fertility, hard_negatives, language_id, lexical_search,
                          license_scan, ngram_join, paragraph_dedup, quality, secrets_scan, suffix_dedup)
from vecstack.llm.common import read

QUERIES: dict = {}
ORACLES: dict = {}


#: Lower-case A-Z only, and the words of a text.
_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_SHINGLES = """CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""
#: A search term (lower-cased).
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Links and the smallest item reachable, of ``sets(item, s)`` with lists of distinct shingles.
_COMPONENTS = """x AS (SELECT item, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (SELECT a.item AS a, b.item AS b FROM x a JOIN x b ON a.sh = b.sh AND a.item <> b.item
          GROUP BY a.item, b.item, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT item, item FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS item, min(b) AS c FROM reach GROUP BY a)"""


def register(fn=None, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f
    return add if fn is None else add(fn)


@register
def op1_benchmark_decontamination(spark, sf_dir):
    """Every passage of every document that holds a benchmark item."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register(sql=f"""
WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS paragraph FROM documents),
places AS (SELECT doc_id, paragraph, {_WORDS.format(_LOW.format("line"))} AS w FROM lines),
begun AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY doc_id ORDER BY paragraph ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM places),
kept AS (SELECT *, dense_rank() OVER (ORDER BY array_to_string(w, ' ')) AS item FROM begun WHERE len(w) >= 25),
sets AS (SELECT item, {_SHINGLES} AS s FROM (SELECT DISTINCT item, w FROM kept)),
{_COMPONENTS},
words AS (SELECT doc_id, {_WORDS.format(_LOW.format("text"))} AS w FROM documents),
each AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM words),
hashed AS (SELECT doc_id, w, i, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM each),
near AS (SELECT *, min(h) OVER (o ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS lo, min(h) OVER (o ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS hi
         FROM hashed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
pieces AS (SELECT doc_id, i AS start, array_to_string(w[i + 1:i + 25], ' ') AS item FROM near
           WHERE i + 25 <= len(w) AND (lo IS NULL OR h < lo) AND (hi IS NULL OR h <= hi)),
every AS (SELECT 'l' || c.c AS cluster, k.doc_id, k.start, len(k.w) AS n FROM kept k JOIN comp c USING (item)
          UNION ALL SELECT 'w' || item, doc_id, start, 25 FROM pieces),
units AS (SELECT *, start + n AS ends, min((doc_id, start)) OVER (PARTITION BY cluster) AS head, count(*) OVER (PARTITION BY cluster) AS copies FROM every),
placed AS (SELECT doc_id, start, ends, head[1] AS component_id, (doc_id, start) <> head AS removed FROM units WHERE copies > 1),
cut AS (SELECT *, max(ends) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach,
               coalesce(max(CASE WHEN removed THEN ends END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
        FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY start, ends, removed)),
spans AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END)
                    OVER (PARTITION BY doc_id ORDER BY start, ends, removed ROWS UNBOUNDED PRECEDING) AS span FROM cut)
SELECT doc_id, min(start)::INTEGER AS first_word, (max(ends) - min(start))::INTEGER AS n_words, count(*)::BIGINT AS n_units,
       min(component_id)::BIGINT AS component_id, sum(CASE WHEN removed THEN greatest(0, ends - greatest(start, gone)) ELSE 0 END)::BIGINT AS n_removed
FROM spans GROUP BY doc_id, span""")
def op2_substring_dedup(spark, sf_dir):
    """Every span of repeated lines and windows, with the smallest document of its clusters."""
    return paragraph_dedup.repeated_spans(read(spark, sf_dir, "documents"))


@register
def op3_quality_classifier(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register(sql=f"""
WITH RECURSIVE words AS (SELECT doc_id AS item, {_WORDS.format(_LOW.format("text"))} AS w FROM documents),
sets AS (SELECT item, {_SHINGLES} AS s FROM words),
{_COMPONENTS}
SELECT sets.item AS doc_id, len(s)::BIGINT AS n_shingles, c AS component_id FROM sets JOIN comp USING (item)""")
def op4_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


@register
def op5_byte_bpe(spark, sf_dir):
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op6_tokeniser_fertility(spark, sf_dir):
    return fertility.judge(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register
def op7_language_id(spark, sf_dir):
    """Documents: the declared language is ``lang``, the host is ``source``."""
    return language_id.identify(read(spark, sf_dir, "documents"))


@register
def language_id_pages(spark, sf_dir):
    """Pages: markup language, address suffix and host, with likelihoods learned from the documents."""
    docs = language_id.evidence_columns(read(spark, sf_dir, "documents"), "lang", "source")
    pages = language_id.page_documents(read(spark, sf_dir, "pages"))
    found = language_id.identify(pages, "markup_language", "host", model=language_id.learn(docs))
    return found.withColumnRenamed("doc_id", "page_id")


@register
def op8_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.report(read(spark, sf_dir, "documents"))


@register
def op9_license_scan(spark, sf_dir):
    return license_scan.report(read(spark, sf_dir, "documents"))


@register
def op10_secret_scan(spark, sf_dir):
    return secrets_scan.report(read(spark, sf_dir, "documents"))


@register(sql=f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_LOW.format("text")}, '{_TERM}') AS w FROM documents),
d AS (SELECT *, len(w)::BIGINT AS n, row_number() OVER () AS row FROM t WHERE len(w) > 0),
stat AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM d),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOW.format("text")}, '{_TERM}')) AS term FROM benchmark),
tf AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS wt FROM tf, stat GROUP BY term, nd),
impact AS (SELECT row, doc_id, term, wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))) AS v
           FROM tf JOIN weight USING (term), stat),
s AS (SELECT item_id, doc_id, sum(v)::BIGINT AS score FROM q JOIN impact USING (term) GROUP BY item_id, row, doc_id HAVING sum(v) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s QUALIFY rank <= 10""")
def op11_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register(sql="""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             list_sum(list_transform(list_zip(a.c, b.c), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""")
def op12_hard_negatives(spark, sf_dir):
    """Ten hard negatives for each of the five positives of every anchor."""
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


@register(sql=r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
                  ('0x' || substr(md5(concat_ws(':', 'curriculum', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM d GROUP BY source),
w AS (SELECT *, number % 3 AS kind, 3 * n AS most, [5, 2, 1][1 + number % 3] AS w FROM s),
f AS (SELECT *, sum(n) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS level,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight, row_number() OVER o AS place
      FROM w WINDOW o AS (ORDER BY most::DOUBLE / w, number)),
l AS (SELECT level, weight, place FROM f WHERE level * w <= most * weight ORDER BY place LIMIT 1),
t AS (SELECT f.source, f.kind, f.n, CASE WHEN f.place < l.place THEN f.most::DOUBLE ELSE l.level::DOUBLE * f.w / l.weight::DOUBLE END AS target FROM f, l),
c AS (SELECT d.doc_id, d.size, t.kind, t.n AS source_size, t.target, floor(t.target + 0.5)::BIGINT AS goal,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, (greatest(0, least(goal - start, size)) + greatest(0, least(goal - start - source_size, size))
                 + greatest(0, least(goal - start - 2 * source_size, size)))::BIGINT AS taken, start / goal::DOUBLE AS x FROM c)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE kind WHEN 0 THEN 10 * x / (7.5 + sqrt(56.25 - 50 * x))
         WHEN 1 THEN CASE WHEN x < 0.5 THEN 4 * x / (1 + sqrt(1 + 16 * x)) ELSE 0.5 + 2 * (2 * x - 1) / (3 + sqrt(9 - 8 * (2 * x - 1))) END
         ELSE 2 * x / (0.5 + sqrt(0.25 + 2 * x)) END, 9) END AS position FROM x""")
def op13_curriculum_mix(spark, sf_dir):
    """Words taken of every document, and its first position in training."""
    return curriculum.report(read(spark, sf_dir, "documents"))
