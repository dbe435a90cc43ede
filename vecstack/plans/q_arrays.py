"""Queries P1-P16 (projections / scalar functions), A1, A2, A9, W2, W4."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from vecstack.functions import arrays as A
from vecstack.operators import evaluate as ev
from vecstack.plans.registry import (EMB, LINEITEM_LABEL, big, explode_long, long_sql, r,
                                     register, rnd)
from vecstack.sources.tables import labelled_vectors, lineitem_labels, read_table

SIDE = 8            # the 64-float embedding is read as an 8×8 image
N_PROBA = 64        # probabilities = softmax of all entries


def emb(spark, sf):
    return labelled_vectors(spark, sf)


def with_proba(spark, sf):
    """``(row_id, label, p)`` — p = softmax of all ``N_PROBA`` entries."""
    df = emb(spark, sf).withColumn("z", F.col("features"))
    return A.softmax(df, "z", "p").drop("z")


PROBA_SQL = f"""
WITH e AS ({EMB}),
z AS ({long_sql("SELECT * FROM e", "f")}),
m AS (SELECT row_id, max(v) AS mx FROM z GROUP BY row_id),
x AS (SELECT z.row_id, z.label, z.dim AS cls, exp(z.v - m.mx) AS ex FROM z JOIN m USING (row_id)),
s AS (SELECT row_id, sum(ex) AS se FROM x GROUP BY row_id),
p AS (SELECT x.row_id, x.label, x.cls, x.ex / (s.se + 1e-12) AS p FROM x JOIN s USING (row_id))
"""


# P1 ------------------------------------------------------------------------
@register("truncate_columns", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f[1:49]")})
SELECT row_id, label::BIGINT AS label, dim, {r("v")} AS value FROM l""")
def q_truncate(spark, sf):
    df = emb(spark, sf).withColumn("t", A.truncate_features("features", 7 * 7))
    return explode_long(df, "t", keep=("row_id", big("label").alias("label")))


# P2 ------------------------------------------------------------------------
@register("pixel_grid", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")})
SELECT row_id, (dim // {SIDE})::BIGINT AS y, (dim % {SIDE})::BIGINT AS x, {r("v")} AS v FROM l""")
def q_pixel_grid(spark, sf):
    g = A.pixel_grid(emb(spark, sf), "features", SIDE)
    return g.select("row_id", big("y").alias("y"), big("x").alias("x"), rnd("v").alias("v"))


# P3 ------------------------------------------------------------------------
@register("concat_features", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT row_id, f || f[1:8] AS c FROM e", "c", "row_id")})
SELECT row_id, dim, {r("v")} AS value FROM l""")
def q_concat(spark, sf):
    df = emb(spark, sf).withColumn("c", A.concat_features(F.col("features"), F.slice("features", 1, 8)))
    return explode_long(df, "c")


# P4 ------------------------------------------------------------------------
@register("l2_normalize", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")}),
n AS (SELECT row_id, sqrt(sum(v * v)) + 1e-12 AS nrm FROM l GROUP BY row_id)
SELECT l.row_id, l.dim, {r("l.v / n.nrm")} AS value FROM l JOIN n USING (row_id)""")
def q_l2(spark, sf):
    return explode_long(A.l2_normalize(emb(spark, sf), "features", "fn"), "fn")


# P5 ------------------------------------------------------------------------
@register("one_hot", f"""
WITH e AS ({EMB}), c AS (SELECT DISTINCT label AS cls FROM e)
SELECT e.row_id, c.cls::BIGINT AS cls, (e.label = c.cls)::DOUBLE AS value FROM e, c""")
def q_one_hot(spark, sf):
    df = emb(spark, sf)
    classes = ev.distinct_labels(df)
    oh = df.withColumn("oh", A.one_hot("label", classes))
    out = oh.select("row_id", F.posexplode("oh").alias("i", "value"))
    cls = F.array(*[F.lit(int(c)) for c in classes])
    return out.select("row_id", big(F.element_at(cls, F.col("i") + 1)).alias("cls"), "value")


# P6 ------------------------------------------------------------------------
@register("label_filter", f"""
WITH e AS ({EMB}) SELECT row_id, label::BIGINT AS label FROM e WHERE label IN (3, 5)""")
def q_label_filter(spark, sf):
    return emb(spark, sf).where(A.label_filter("label", [3, 5])).select("row_id", big("label").alias("label"))


# P7 ------------------------------------------------------------------------
@register("label_binarize", f"""
WITH e AS ({EMB})
SELECT row_id, (label = 3)::BIGINT AS ovr3, (label IN (7, 9))::BIGINT AS ovr79,
       CASE WHEN label IN (3, 5) THEN (label = 3)::BIGINT ELSE -1 END AS pair35 FROM e""")
def q_label_binarize(spark, sf):
    df = emb(spark, sf)
    return df.select("row_id", big(A.label_binarize("label", [3])).alias("ovr3"),
                     big(A.label_binarize("label", [7, 9])).alias("ovr79"),
                     F.when(A.label_filter("label", [3, 5]), big(A.label_binarize("label", [3])))
                     .otherwise(F.lit(-1).cast("bigint")).alias("pair35"))   # -1: not in the pair


# P8 ------------------------------------------------------------------------
@register("softmax", PROBA_SQL + f"SELECT row_id, cls, {r('p')} AS p FROM p")
def q_softmax(spark, sf):
    return explode_long(with_proba(spark, sf), "p", dim="cls", value="p")


# P9 ------------------------------------------------------------------------
@register("logit", PROBA_SQL + f"""
, c AS (SELECT row_id, cls, greatest(least(p, 1 - 1e-12), 1e-12) AS q FROM p)
SELECT row_id, cls, {r("ln(q / (1 - q))")} AS z FROM c""")
def q_logit(spark, sf):
    df = with_proba(spark, sf).withColumn("z", A.array_logit("p"))
    return explode_long(df, "z", dim="cls", value="z")


# P10 -----------------------------------------------------------------------
@register("sigmoid", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")})
SELECT row_id, dim, {r("1 / (1 + exp(-(10 * v)))")} AS s FROM l""")
def q_sigmoid(spark, sf):
    df = emb(spark, sf).withColumn("s", F.transform("features", lambda x: A.sigmoid(F.lit(10.0) * x)))
    return explode_long(df, "s", value="s")


# P11 -----------------------------------------------------------------------
@register("temperature_scale", PROBA_SQL + f"""
, t AS (SELECT row_id, cls, pow(p, 1 / 1.15::DOUBLE) AS q FROM p),
ts AS (SELECT row_id, sum(q) AS sq FROM t GROUP BY row_id)
SELECT row_id, cls, {r("q / sq")} AS p FROM t JOIN ts USING (row_id)""")
def q_temperature(spark, sf):
    df = A.temperature_scale(with_proba(spark, sf), "p", "pt")
    return explode_long(df, "pt", dim="cls", value="p")


# P12 -----------------------------------------------------------------------
@register("clip", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")})
SELECT row_id, dim, {r("least(greatest(v, -0.1::DOUBLE), 0.1::DOUBLE)")} AS value FROM l""")
def q_clip(spark, sf):
    df = emb(spark, sf).withColumn("c", F.transform("features", lambda x: A.clip(x, -0.1, 0.1)))
    return explode_long(df, "c")


# P13 -----------------------------------------------------------------------
@register("polar", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")}),
g AS (SELECT row_id, dim // 2 AS j, max(CASE WHEN dim % 2 = 0 THEN v END) AS gx,
             max(CASE WHEN dim % 2 = 1 THEN v END) AS gy FROM l GROUP BY row_id, dim // 2)
SELECT row_id, j::BIGINT AS j, {r("sqrt(gx * gx + gy * gy)")} AS mag,
       {r("((degrees(atan2(gy, gx)) % 180) + 180) % 180")} AS ang FROM g""")
def q_polar(spark, sf):
    df = emb(spark, sf)
    df = df.select("row_id", F.arrays_zip(F.filter("features", lambda x, i: i % 2 == 0).alias("gx"),
                                          F.filter("features", lambda x, i: i % 2 == 1).alias("gy")).alias("z"))
    df = df.select("row_id", F.posexplode("z").alias("j", "g"))
    mag, ang = A.polar(F.col("g.gx"), F.col("g.gy"))
    return df.select("row_id", big("j").alias("j"), rnd(mag).alias("mag"), rnd(ang).alias("ang"))


# P14 -----------------------------------------------------------------------
@register("argmax_class", PROBA_SQL + """
, k AS (SELECT row_id, cls, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, cls) AS rn FROM p)
SELECT row_id, cls AS pred FROM k WHERE rn = 1""")
def q_argmax(spark, sf):
    df = with_proba(spark, sf)
    return df.select("row_id", big(A.argmax_class("p", list(range(N_PROBA)))).alias("pred"))


# P15 -----------------------------------------------------------------------
@register("renormalize", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")}),
s AS (SELECT row_id, sum(abs(v)) AS t FROM l GROUP BY row_id)
SELECT row_id, dim, {r("abs(v) / (t + 1e-12)")} AS value FROM l JOIN s USING (row_id)""")
def q_renormalize(spark, sf):
    df = emb(spark, sf).withColumn("a", F.transform("features", lambda x: F.abs(x)))
    return explode_long(A.renormalize(df, "a", "n"), "n")


# P16 -----------------------------------------------------------------------
@register("cast_float32", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")})
SELECT row_id, dim, {r("CAST(CAST(v * 3 AS FLOAT) AS DOUBLE)")} AS value FROM l""")
def q_cast_float32(spark, sf):
    df = emb(spark, sf).withColumn("c", A.cast_float32(F.transform("features", lambda x: x * 3)))
    return explode_long(df, F.col("c").cast("array<double>"))


# A1 ------------------------------------------------------------------------
@register("class_counts", f"""
SELECT {LINEITEM_LABEL}::BIGINT AS label, count(*)::BIGINT AS n FROM lineitem GROUP BY 1""")
def q_class_counts(spark, sf):
    c = ev.class_counts(lineitem_labels(spark, sf))
    return c.select(big("label").alias("label"), "n")


# A2 ------------------------------------------------------------------------
@register("gini", f"""
WITH c AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_linestatus, sum(n)::BIGINT AS n, {r("1 - sum(n * n)::DOUBLE / (sum(n) * sum(n))")} AS gini
FROM c GROUP BY 1""")
def q_gini(spark, sf):
    li = read_table(spark, sf, "lineitem")
    counts = li.groupBy("l_linestatus", "l_returnflag").agg(F.count("*").alias("n"))
    g = ev.gini(counts, ["l_linestatus"])
    return g.select("l_linestatus", big("n").alias("n"), rnd("gini").alias("gini"))


# A9 ------------------------------------------------------------------------
@register("distinct_labels", f"WITH e AS ({EMB}) SELECT DISTINCT label::BIGINT AS label FROM e")
def q_distinct_labels(spark, sf):
    return emb(spark, sf).select(big("label").alias("label")).distinct()


# W2 ------------------------------------------------------------------------
@register("topk_per_row", f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")}),
k AS (SELECT row_id, dim, v, row_number() OVER (PARTITION BY row_id ORDER BY v DESC, dim) AS rk FROM l)
SELECT row_id, rk::BIGINT AS rank, dim, {r("v")} AS value FROM k WHERE rk <= 3""")
def q_topk_per_row(spark, sf):
    l = emb(spark, sf).select("row_id", F.posexplode("features").alias("dim", "v"))
    w = Window.partitionBy("row_id").orderBy(F.col("v").desc(), F.col("dim"))
    k = l.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= 3)
    return k.select("row_id", big("rk").alias("rank"), big("dim").alias("dim"), rnd("v").alias("value"))


# W4 ------------------------------------------------------------------------
@register("argmax_group", PROBA_SQL + f"""
, k AS (SELECT row_id, cls, p, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, cls) AS rn FROM p)
SELECT row_id, cls, {r("p")} AS p FROM k WHERE rn = 1""")
def q_argmax_group(spark, sf):
    l = with_proba(spark, sf).select("row_id", F.posexplode("p").alias("cls", "p"))
    g = l.groupBy("row_id").agg(F.max_by(F.struct("cls", "p"), F.struct(F.col("p"), -F.col("cls"))).alias("b"))
    return g.select("row_id", big("b.cls").alias("cls"), rnd("b.p").alias("p"))
