"""Queries J1-J3, A5, M3, M4, A10-A13 (similarity joins, votes, evaluation).

Fixture: ``embeddings``; queries are the validation split (row_id % 5 = 0),
the train side is every other row; k = 5.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecstack.operators import evaluate as ev
from vecstack.operators import neighbors as nb
from vecstack.plans.registry import EMB, big, long_sql, r, register, rnd
from vecstack.sources.tables import labelled_vectors, train_val

K = 5
PIVOT_BLOCK = 256     # train rows of a block in the pruned queries (their tables are small)


def split(spark, sf):
    return train_val(labelled_vectors(spark, sf))


def knn_sql(metric: str = "cosine") -> str:
    base = f"""
WITH e AS ({EMB}),
q AS (SELECT * FROM e WHERE row_id % 5 = 0),
t AS (SELECT * FROM e WHERE row_id % 5 <> 0),
ql AS ({long_sql("SELECT * FROM q", "f", "row_id")}),
tl AS ({long_sql("SELECT * FROM t", "f", "row_id")}),"""
    if metric == "cosine":
        base += f"""
qn AS (SELECT row_id, sqrt(sum(v * v)) + 1e-12 AS nrm FROM ql GROUP BY row_id),
tn AS (SELECT row_id, sqrt(sum(v * v)) + 1e-12 AS nrm FROM tl GROUP BY row_id),
s AS (SELECT ql.row_id AS q_id, tl.row_id AS t_id, sum((ql.v / qn.nrm) * (tl.v / tn.nrm)) AS score
      FROM ql JOIN qn USING (row_id) JOIN tl ON tl.dim = ql.dim JOIN tn ON tn.row_id = tl.row_id
      GROUP BY 1, 2),
nb AS (SELECT s.q_id, s.t_id, t.label AS t_label, s.score,
              row_number() OVER (PARTITION BY s.q_id ORDER BY s.score DESC, s.t_id) AS rank
       FROM s JOIN t ON t.row_id = s.t_id QUALIFY rank <= {K})"""
    else:
        base += f"""
s AS (SELECT ql.row_id AS q_id, tl.row_id AS t_id, sqrt(sum((ql.v - tl.v) * (ql.v - tl.v))) AS score
      FROM ql JOIN tl ON tl.dim = ql.dim GROUP BY 1, 2),
nb AS (SELECT s.q_id, s.t_id, t.label AS t_label, s.score,
              row_number() OVER (PARTITION BY s.q_id ORDER BY s.score ASC, s.t_id) AS rank
       FROM s JOIN t ON t.row_id = s.t_id QUALIFY rank <= {K})"""
    return base


VOTE_SQL = knn_sql("cosine") + """,
v AS (SELECT q_id, t_label AS pred, count(*) AS votes, min(rank) AS first FROM nb GROUP BY 1, 2),
mv AS (SELECT q_id, pred, votes FROM v
       QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY votes DESC, first) = 1),
pairs AS (SELECT q.row_id, q.label, mv.pred FROM mv JOIN q ON q.row_id = mv.q_id)"""

PER_CLASS_SQL = VOTE_SQL + """,
ev AS (SELECT label AS cls, 1 AS t, 0 AS p, (label = pred)::INTEGER AS hit FROM pairs
       UNION ALL SELECT pred, 0, 1, 0 FROM pairs),
per AS (SELECT cls, sum(t) AS support, sum(p) AS predicted, sum(hit) AS tp FROM ev GROUP BY cls),
pr AS (SELECT cls, support, tp,
              CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                     ELSE 0.0::DOUBLE END AS f1 FROM pr)"""


def predictions(spark, sf):
    """``(row_id, label, pred)`` of cosine 5-NN on the validation split."""
    tr, va = split(spark, sf)
    pred = nb.knn_classify(va, tr, k=K)
    return pred.join(va.select("row_id", "label"), "row_id")


def _nb_out(n):
    return n.select(big("q_id").alias("q_id"), big("t_id").alias("t_id"), big("t_label").alias("t_label"),
                    big("rank").alias("rank"), rnd("score").alias("score"))


@register("knn_cosine_topk", knn_sql("cosine") + f"""
SELECT q_id, t_id, t_label::BIGINT AS t_label, rank::BIGINT AS rank, {r("score")} AS score FROM nb""")
def q_knn_cosine(spark, sf):
    tr, va = split(spark, sf)
    return _nb_out(nb.knn_topk(va, tr, k=K, metric="cosine"))


@register("knn_euclid_topk", knn_sql("euclidean") + f"""
SELECT q_id, t_id, t_label::BIGINT AS t_label, rank::BIGINT AS rank, {r("score")} AS score FROM nb""")
def q_knn_euclid(spark, sf):
    tr, va = split(spark, sf)
    return _nb_out(nb.knn_topk(va, tr, k=K, metric="euclidean"))


def _pruned(spark, sf, metric):
    """The validation rows against the train side on the path for train sides too large to ship."""
    tr, va = split(spark, sf)
    return _nb_out(nb.knn_topk(va, tr, k=K, metric=metric, broadcast_limit_bytes=0, block_rows=PIVOT_BLOCK))


@register("knn_cosine_pruned", knn_sql("cosine") + f"""
SELECT q_id, t_id, t_label::BIGINT AS t_label, rank::BIGINT AS rank, {r("score")} AS score FROM nb""")
def q_knn_cosine_pruned(spark, sf):
    return _pruned(spark, sf, "cosine")


@register("knn_euclid_pruned", knn_sql("euclidean") + f"""
SELECT q_id, t_id, t_label::BIGINT AS t_label, rank::BIGINT AS rank, {r("score")} AS score FROM nb""")
def q_knn_euclid_pruned(spark, sf):
    return _pruned(spark, sf, "euclidean")


@register("knn_lsh")
def q_knn_lsh(spark, sf):
    """Approximate (rows-only check; recall is asserted in pytest)."""
    tr, va = split(spark, sf)
    return _nb_out(nb.knn_lsh_topk(va, tr, k=K))


@register("majority_vote", VOTE_SQL + """
SELECT q_id, pred::BIGINT AS pred, votes::BIGINT AS votes FROM mv""")
def q_majority_vote(spark, sf):
    tr, va = split(spark, sf)
    v = nb.majority_vote(nb.knn_topk(va, tr, k=K))
    return v.select(big("q_id").alias("q_id"), big("pred").alias("pred"), big("votes").alias("votes"))


@register("knn_classify", VOTE_SQL + """
SELECT q_id AS row_id, pred::BIGINT AS pred FROM mv""")
def q_knn_classify(spark, sf):
    tr, va = split(spark, sf)
    return nb.knn_classify(va, tr, k=K).select("row_id", big("pred").alias("pred"))


@register("knn_proba", knn_sql("euclidean") + f""",
c AS (SELECT DISTINCT label AS cls FROM t),
qs AS (SELECT DISTINCT q_id FROM nb),
cnt AS (SELECT q_id, t_label, count(*) AS n FROM nb GROUP BY 1, 2)
SELECT qs.q_id AS row_id, c.cls::BIGINT AS cls, {r(f"coalesce(cnt.n, 0) / {K}")} AS p
FROM qs CROSS JOIN c LEFT JOIN cnt ON cnt.q_id = qs.q_id AND cnt.t_label = c.cls""")
def q_knn_proba(spark, sf):
    tr, va = split(spark, sf)
    classes = ev.distinct_labels(tr)
    pr = nb.knn_proba(va, tr, classes, k=K, metric="euclidean")
    cls = F.array(*[F.lit(int(c)) for c in classes])
    out = pr.select("row_id", F.posexplode("proba").alias("i", "p"))
    return out.select("row_id", big(F.element_at(cls, F.col("i") + 1)).alias("cls"), rnd("p").alias("p"))


@register("accuracy", VOTE_SQL + f"""
SELECT count(*)::BIGINT AS n, {r("avg((label = pred)::DOUBLE)")} AS accuracy FROM pairs""")
def q_accuracy(spark, sf):
    a = ev.accuracy(predictions(spark, sf))
    return a.select(big("n").alias("n"), rnd("accuracy").alias("accuracy"))


@register("weighted_f1", PER_CLASS_SQL + f"""
SELECT {r("sum(f1 * support) / sum(support)")} AS weighted_f1 FROM f""")
def q_weighted_f1(spark, sf):
    return ev.weighted_f1(predictions(spark, sf)).select(rnd("weighted_f1").alias("weighted_f1"))


@register("classification_report", PER_CLASS_SQL + f"""
SELECT cls::VARCHAR AS row, {r("precision")} AS precision, {r("recall")} AS recall, {r("f1")} AS f1,
       support::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {r("sum(tp) / sum(support)")}, sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', {r("avg(precision)")}, {r("avg(recall)")}, {r("avg(f1)")}, sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', {r("sum(precision * support) / sum(support)")},
       {r("sum(recall * support) / sum(support)")}, {r("sum(f1 * support) / sum(support)")},
       sum(support)::BIGINT FROM f""")
def q_report(spark, sf):
    rep = ev.classification_report(predictions(spark, sf))
    return rep.select("row", rnd("precision").alias("precision"), rnd("recall").alias("recall"),
                      rnd("f1").alias("f1"), big("support").alias("support"))


@register("confusion_matrix", VOTE_SQL + """
SELECT label::BIGINT AS label, pred::BIGINT AS pred, count(*)::BIGINT AS n FROM pairs GROUP BY 1, 2""")
def q_confusion(spark, sf):
    cm = ev.confusion_matrix(predictions(spark, sf))
    return cm.select(big("label").alias("label"), big("pred").alias("pred"), big("n").alias("n"))
