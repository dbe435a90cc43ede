"""Queries F8-F15: scaler, group scaling, covariance, PCA, feature table build."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vecstack.operators import pca as P
from vecstack.operators import scale as SC
from vecstack.operators.image import Directional, Hog, Zonal, image_features
from vecstack.plans import q_image as QI
from vecstack.plans.registry import EMB, big, explode_long, long_sql, r, register, rnd
from vecstack.sources.tables import LINEITEM_FEATURES, labelled_vectors, lineitem_vectors

S = 8


def is_train():
    """Train split: row_id % 5 != 0 (built lazily: a Column needs an active session)."""
    return F.col("row_id") % 5 != 0


def _lineitem_stats_sql():
    parts = [f"SELECT {i}::BIGINT AS dim, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_pop({c}) + 1e-12', 4)} AS std "
             f"FROM lineitem" for i, c in enumerate(LINEITEM_FEATURES)]
    return "\nUNION ALL ".join(parts)


@register("scaler_fit", _lineitem_stats_sql())
def q_scaler_fit(spark, sf):
    m = SC.fit_scaler(lineitem_vectors(spark, sf))
    t = m.to_frame(spark)
    return t.select(big("dim").alias("dim"), rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"))


_SCALE_STATS = f"""
WITH e AS ({EMB}), l AS ({long_sql("SELECT * FROM e", "f", "row_id")}),
st AS (SELECT dim, avg(v) AS m, stddev_pop(v) + 1e-12 AS s FROM l WHERE row_id % 5 <> 0 GROUP BY dim)"""


@register("scaler_transform", _SCALE_STATS + f"""
SELECT l.row_id, l.dim, {r("(l.v - st.m) / st.s")} AS value FROM l JOIN st USING (dim)""")
def q_scaler_transform(spark, sf):
    df = labelled_vectors(spark, sf)
    model = SC.fit_scaler(df.where(is_train()))
    return explode_long(model.transform(df, "features", "z"), "z")


# F10 -------------------------------------------------------------------------
FAMILY_SPECS = [Hog(cell=2, bins=8, signed=False, border="constant", name="hog"),
                Directional(ratios=True, name="dir"), Zonal(grid=(4, 4), name="zon")]


def _groups_sql() -> str:
    zon_body = f"""
WITH e AS ({EMB}),
px AS (SELECT row_id, dim // {S} AS y, dim % {S} AS x, v FROM ({long_sql("SELECT * FROM e", "f", "row_id")})),
blk AS (SELECT row_id, (y // 2) * 4 + (x // 2) AS dim, sum(v) AS value FROM px GROUP BY 1, 2),
rs AS (SELECT row_id, y, sum(v) AS s FROM px GROUP BY 1, 2),
cs AS (SELECT row_id, x, sum(v) AS s FROM px GROUP BY 1, 2)
SELECT * FROM blk
UNION ALL SELECT row_id, 16, avg(s) FROM rs GROUP BY 1 UNION ALL SELECT row_id, 17, stddev_pop(s) FROM rs GROUP BY 1
UNION ALL SELECT row_id, 18, avg(s) FROM cs GROUP BY 1 UNION ALL SELECT row_id, 19, stddev_pop(s) FROM cs GROUP BY 1"""
    dir_body = QI._DIR_SQL + """
SELECT row_id, 0 AS dim, e0 AS value FROM en UNION ALL SELECT row_id, 1, e1 FROM en
UNION ALL SELECT row_id, 2, e2 FROM en UNION ALL SELECT row_id, 3, e3 FROM en
UNION ALL SELECT row_id, 4, e0 / (e1 + 1e-6) FROM en UNION ALL SELECT row_id, 5, e2 / (e3 + 1e-6) FROM en"""
    hog_body = QI.hog_sql(2, 8, False, "constant", raw=True) + "\nSELECT row_id, cell * 8 + bin AS dim, value FROM hogv"
    return f"""
WITH fam AS (
  SELECT row_id, 0 AS g, dim, value FROM ({hog_body})
  UNION ALL SELECT row_id, 1, dim, value FROM ({dir_body})
  UNION ALL SELECT row_id, 2, dim, value FROM ({zon_body})),
fs AS (SELECT g, dim, avg(value) AS m, stddev_pop(value) + 1e-12 AS s FROM fam WHERE row_id % 5 <> 0 GROUP BY 1, 2),
sc AS (SELECT fam.row_id, CASE fam.g WHEN 0 THEN fam.dim WHEN 1 THEN 128 + fam.dim ELSE 134 + fam.dim END AS dim,
              (fam.value - fs.m) / fs.s AS value FROM fam JOIN fs ON fs.g = fam.g AND fs.dim = fam.dim),
fin AS (SELECT dim, avg(value) AS m, stddev_pop(value) + 1e-12 AS s FROM sc WHERE row_id % 5 <> 0 GROUP BY dim)
SELECT sc.row_id, sc.dim::BIGINT AS dim, {r("(sc.value - fin.m) / fin.s")} AS value FROM sc JOIN fin USING (dim)"""


def family_frame(spark, sf):
    return image_features(labelled_vectors(spark, sf), FAMILY_SPECS, side=S)


@register("scale_groups", _groups_sql())
def q_scale_groups(spark, sf):
    fam = family_frame(spark, sf)
    out, _ = SC.scale_groups(fam, ["hog", "dir", "zon"], is_train())
    return explode_long(out, "features")


# F11-F14 ---------------------------------------------------------------------
_LONG_ALL = f"WITH e AS ({EMB}), l AS ({long_sql('SELECT * FROM e', 'f', 'row_id')})"


@register("covariance", _LONG_ALL + f"""
SELECT a.dim AS i, b.dim AS j, {r("covar_samp(a.v, b.v)", 9)} AS cov
FROM l a JOIN l b ON a.row_id = b.row_id AND a.dim <= b.dim GROUP BY 1, 2""")
def q_covariance(spark, sf):
    c = P.covariance(labelled_vectors(spark, sf))
    return c.select(big("i").alias("i"), big("j").alias("j"), rnd("cov", 9).alias("cov"))


@register("pca_fit", _LONG_ALL + f"""
SELECT a.dim AS i, b.dim AS j, {r("covar_samp(a.v, b.v)", 9)} AS value
FROM l a JOIN l b ON a.row_id = b.row_id AND a.dim <= b.dim GROUP BY 1, 2""")
def q_pca_fit(spark, sf):
    """the covariance put together again from the eigenpairs, V diag(λ) Vᵀ, entry by entry."""
    return _put_together(spark, P.fit_pca(labelled_vectors(spark, sf), variance_ratio=1.0))


def _put_together(spark, m):
    v = m.components
    whole = (v * m.eigenvalues[:v.shape[1]]) @ v.T
    rows = [(i, j, float(whole[i, j])) for i in range(len(whole)) for j in range(i, len(whole))]
    return spark.createDataFrame(rows, "i long, j long, value double").select("i", "j", rnd("value", 9).alias("value"))


@register("pca_fit_iterative", _LONG_ALL + f"""
SELECT a.dim AS i, b.dim AS j, {r("covar_samp(a.v, b.v)", 9)} AS value
FROM l a JOIN l b ON a.row_id = b.row_id AND a.dim <= b.dim GROUP BY 1, 2""")
def q_pca_fit_iterative(spark, sf):
    """F12 on the path for any number of dimensions: the eigenpairs of distributed products give the covariance again."""
    return _put_together(spark, P.fit_pca_iterative(labelled_vectors(spark, sf), variance_ratio=1.0))


@register("pca_project", _LONG_ALL + f""",
mu AS (SELECT dim, avg(v) AS m FROM l GROUP BY dim)
SELECT l.row_id, {r("sum((l.v - mu.m) * (l.v - mu.m))", 9)} AS sq_norm FROM l JOIN mu USING (dim) GROUP BY 1""")
def q_pca_project(spark, sf):
    """F13 invariant: with every component kept the projection is a rotation of x − mean."""
    df = labelled_vectors(spark, sf)
    m = P.fit_pca(df, variance_ratio=1.0)
    pr = m.transform(df, "features", "pc")
    return pr.select("row_id", rnd(F.aggregate("pc", F.lit(0.0), lambda a, x: a + x * x), 9).alias("sq_norm"))


@register("explained_variance", _LONG_ALL + f""",
c AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.v, b.v) AS v FROM l a JOIN l b ON a.row_id = b.row_id GROUP BY 1, 2)
SELECT (SELECT count(*) FROM c WHERE i = j)::BIGINT AS n_components,
       {r("(SELECT sum(v) FROM c WHERE i = j)", 9)} AS total, {r("(SELECT sum(v * v) FROM c)", 9)} AS squares,
       {r("(SELECT sum(x.v * y.v * z.v) FROM c x JOIN c y ON x.j = y.i JOIN c z ON y.j = z.i AND z.j = x.i)", 9)} AS cubes,
       true AS rising, 1.0::DOUBLE AS last_ratio""")
def q_explained_variance(spark, sf):
    """Cumulative-ratio table, checked by the power sums of the eigenvalues, which
    are the traces of C, C² and C³."""
    m = P.fit_pca(labelled_vectors(spark, sf), variance_ratio=0.95)
    t = P.explained_variance_table(spark, m)
    e = F.col("eigenvalue")
    ordered = F.sort_array(F.collect_list(F.struct("component", "cum_ratio")))
    rising = F.forall(F.sequence(F.lit(1), F.size(ordered) - 1), lambda i: ordered[i - 1]["cum_ratio"] <= ordered[i]["cum_ratio"])
    return t.agg(F.count("*").alias("n_components"), rnd(F.sum(e), 9).alias("total"), rnd(F.sum(e * e), 9).alias("squares"),
                 rnd(F.sum(e * e * e), 9).alias("cubes"), rising.alias("rising"), rnd(F.max("cum_ratio"), 9).alias("last_ratio"))
