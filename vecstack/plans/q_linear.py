"""Queries A6, M1, M2 (softmax regression), A7, A8, M13-M15 (calibration), M19, M20 (specialists)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vecstack.functions.arrays import sigmoid
from vecstack.operators import calibrate as C
from vecstack.operators import evaluate as ev
from vecstack.operators import linear as L
from vecstack.operators import specialists as SP
from vecstack.plans.q_arrays import N_PROBA, PROBA_SQL, with_proba
from vecstack.plans.registry import EMB, big, explode_long, long_sql, r, register, rnd
from vecstack.sources.tables import labelled_vectors

LR, REG, STEPS = 0.3, 1e-4, 400
PLATT_LR, PLATT_STEPS = 0.05, 200


_GD_HEAD = f"""e AS ({EMB}),
x AS MATERIALIZED ({long_sql("SELECT * FROM e", "f", "row_id")}),
cl AS (SELECT DISTINCT label AS k FROM e),
y AS MATERIALIZED (SELECT e.row_id, cl.k, (e.label = cl.k)::DOUBLE AS t FROM e, cl),
nn AS (SELECT count(*)::DOUBLE AS n FROM e),
dims AS (SELECT DISTINCT dim AS j FROM x UNION ALL SELECT -1)"""


def _residuals(weights: str) -> str:
    """``rr(row_id, k, r)``: softmax residuals at ``weights(j, k, w)``, the intercept at ``j = -1``."""
    return f"""sc AS (SELECT x.row_id, w.k, sum(x.v * w.w) AS s FROM x JOIN {weights} w ON w.j = x.dim GROUP BY 1, 2),
sb AS (SELECT sc.row_id, sc.k, sc.s + b.w AS s FROM sc JOIN {weights} b ON b.k = sc.k AND b.j = -1),
ex AS (SELECT row_id, k, exp(s - max(s) OVER (PARTITION BY row_id)) AS ex FROM sb),
rr AS (SELECT ex.row_id, ex.k, ex.ex / (sum(ex.ex) OVER (PARTITION BY ex.row_id) + 1e-12) - y.t AS r FROM ex
       JOIN y ON y.row_id = ex.row_id AND y.k = ex.k)"""


def gd_sql(steps: int, lr: float = LR, reg: float = REG) -> str:
    """Full-batch softmax gradient descent from zero, as a recursive CTE ``w(i, j, k, w)`` (intercepts at ``j = -1``)."""
    return f"""WITH RECURSIVE {_GD_HEAD},
w(i, j, k, w) AS (SELECT 0, j, k, 0.0::DOUBLE FROM dims, cl
  UNION ALL
  SELECT z.i, z.j, z.k, z.w FROM (
    WITH {_residuals("w")},
    g AS (SELECT x.dim AS j, rr.k, sum(x.v * rr.r) / any_value(n) AS g FROM x JOIN rr USING (row_id), nn GROUP BY 1, 2
          UNION ALL SELECT -1, k, avg(r) FROM rr GROUP BY k)
    SELECT w.i + 1 AS i, w.j, w.k, w.w - {lr}::DOUBLE * (g.g + CASE WHEN w.j >= 0 THEN {reg}::DOUBLE * w.w ELSE 0 END) AS w
    FROM w JOIN g ON g.j = w.j AND g.k = w.k WHERE w.i < {steps}) z)"""


def _train(spark, sf):
    """Fit rows and scored rows: the whole table is both."""
    df = labelled_vectors(spark, sf)
    return df, df


# A6 ------------------------------------------------------------------------
@register("softmax_gradient", f"""WITH {_GD_HEAD}, w0 AS (SELECT j, k, 0.0::DOUBLE AS w FROM dims, cl), {_residuals("w0")}
SELECT x.dim AS dim, k::BIGINT AS cls, {r("sum(v * r) / any_value(n)", 9)} AS grad FROM x JOIN rr USING (row_id), nn GROUP BY 1, 2
UNION ALL SELECT -1, k::BIGINT, {r("avg(r)", 9)} FROM rr GROUP BY k""")
def q_softmax_gradient(spark, sf):
    tr, _ = _train(spark, sf)
    classes = ev.distinct_labels(tr)
    d = len(tr.select("features").first()[0])
    gW, gb = L.softmax_gradient(tr, np.zeros((d, len(classes))), np.zeros(len(classes)), classes, REG)
    rows = [(int(j), int(c), float(gW[j, k])) for j in range(d) for k, c in enumerate(classes)]
    rows += [(-1, int(c), float(gb[k])) for k, c in enumerate(classes)]
    t = spark.createDataFrame(rows, "dim long, cls long, grad double")
    return t.select("dim", "cls", rnd("grad", 9).alias("grad"))


# M1 ------------------------------------------------------------------------
@register("logreg_fit", gd_sql(STEPS) + f"""
SELECT j AS dim, k::BIGINT AS cls, {r("w", 9)} AS weight FROM w WHERE i = {STEPS}""")
def q_logreg_fit(spark, sf):
    tr, _ = _train(spark, sf)
    m = L.fit_softmax_gd(tr, lr=LR, n_iter=STEPS, reg=REG, init="zeros")
    t = m.to_frame(spark)
    return t.select("dim", "cls", rnd("weight", 9).alias("weight"))


# M2 ------------------------------------------------------------------------
@register("logreg_predict", gd_sql(STEPS) + f""",
fin AS (SELECT j, k, w FROM w WHERE i = {STEPS}),
v AS ({EMB}), vx AS ({long_sql("SELECT * FROM v", "f", "row_id")}),
vs AS (SELECT vx.row_id, w.k, sum(vx.v * w.w) AS s FROM vx JOIN fin w ON w.j = vx.dim GROUP BY 1, 2),
vsb AS (SELECT s.row_id, s.k, s.s + b.w AS s FROM vs s JOIN fin b ON b.k = s.k AND b.j = -1),
vm AS (SELECT row_id, max(s) AS mx FROM vsb GROUP BY row_id),
ve AS (SELECT s.row_id, s.k, exp(s.s - m.mx) AS ex FROM vsb s JOIN vm m USING (row_id)),
vz AS (SELECT row_id, sum(ex) AS se FROM ve GROUP BY row_id),
vp AS (SELECT q.row_id, q.k, q.ex / (z.se + 1e-12) AS p FROM ve q JOIN vz z USING (row_id)),
vpred AS (SELECT row_id, k AS pred FROM vp QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k) = 1)
SELECT vp.row_id, vp.k::BIGINT AS cls, {r("vp.p", 9)} AS p, vpred.pred::BIGINT AS pred
FROM vp JOIN vpred USING (row_id)""")
def q_logreg_predict(spark, sf):
    tr, va = _train(spark, sf)
    m = L.fit_softmax_gd(tr, lr=LR, n_iter=STEPS, reg=REG, init="zeros")
    p = m.predict(va)
    cls = F.array(*[F.lit(int(c)) for c in m.classes])
    out = p.select("row_id", "pred", F.posexplode("proba").alias("i", "p"))
    return out.select("row_id", big(F.element_at(cls, F.col("i") + 1)).alias("cls"), rnd("p", 9).alias("p"),
                      big("pred").alias("pred"))


# A7 / A8 / M13 / M14 ---------------------------------------------------------
_ZT = PROBA_SQL.replace("WITH e AS", "WITH RECURSIVE e AS", 1) + """,
zt AS (SELECT row_id, cls AS k, ln(q / (1 - q)) AS z, (label = cls)::DOUBLE AS t
       FROM (SELECT *, greatest(least(p, 1 - 1e-12), 1e-12) AS q FROM p))"""


def _platt_sql(steps: int) -> str:
    return _ZT + f""",
g(i, k, a, b) AS (SELECT 0, k, 1.0::DOUBLE, 0.0::DOUBLE FROM (SELECT DISTINCT k FROM zt)
   UNION ALL
   SELECT g.i + 1, g.k,
          g.a - {PLATT_LR}::DOUBLE * avg((1 / (1 + exp(-(g.a * zt.z + g.b))) - zt.t) * zt.z),
          g.b - {PLATT_LR}::DOUBLE * avg(1 / (1 + exp(-(g.a * zt.z + g.b))) - zt.t)
   FROM g JOIN zt ON zt.k = g.k WHERE g.i < {steps} GROUP BY g.i, g.k, g.a, g.b)"""


def _classes():
    return list(range(N_PROBA))


@register("platt_gradient", _ZT + f"""
SELECT k::BIGINT AS cls, {r("avg((1 / (1 + exp(-z)) - t) * z)", 9)} AS grad_a,
       {r("avg(1 / (1 + exp(-z)) - t)", 9)} AS grad_b FROM zt GROUP BY k""")
def q_platt_gradient(spark, sf):
    df = with_proba(spark, sf)
    zt = C._z_t(df, "p", "label", _classes())
    ga, gb = C.platt_gradient(zt, np.ones(N_PROBA), np.zeros(N_PROBA))
    t = spark.createDataFrame([(k, float(ga[k]), float(gb[k])) for k in _classes()], "cls long, ga double, gb double")
    return t.select("cls", rnd("ga", 9).alias("grad_a"), rnd("gb", 9).alias("grad_b"))


@register("mean_abs_residual", PROBA_SQL + f"""
SELECT {r("avg(abs((label = cls)::DOUBLE - p))", 9)} AS mar FROM p""")
def q_mar(spark, sf):
    return C.mean_abs_residual(with_proba(spark, sf), "p", "label", _classes()).select(rnd("mar", 9).alias("mar"))


@register("platt_fit", _platt_sql(PLATT_STEPS) + f"""
SELECT k::BIGINT AS cls, {r("a", 9)} AS a, {r("b", 9)} AS b FROM g WHERE i = {PLATT_STEPS}""")
def q_platt_fit(spark, sf):
    m = C.fit_platt(with_proba(spark, sf), _classes(), proba="p", max_iter=PLATT_STEPS, lr=PLATT_LR)
    return m.to_frame(spark).select("cls", rnd("a", 9).alias("a"), rnd("b", 9).alias("b"))


@register("platt_transform", _platt_sql(PLATT_STEPS) + f""",
fin AS (SELECT k, a, b FROM g WHERE i = {PLATT_STEPS}),
c AS (SELECT zt.row_id, zt.k, 1 / (1 + exp(-(fin.a * zt.z + fin.b))) AS s FROM zt JOIN fin USING (k)),
cs AS (SELECT row_id, sum(s) AS ss FROM c GROUP BY row_id)
SELECT c.row_id, c.k::BIGINT AS cls, {r("c.s / (cs.ss + 1e-12)", 9)} AS p FROM c JOIN cs USING (row_id)""")
def q_platt_transform(spark, sf):
    df = with_proba(spark, sf)
    m = C.fit_platt(df, _classes(), proba="p", max_iter=PLATT_STEPS, lr=PLATT_LR)
    out = m.transform(df, "p", "pc")
    return explode_long(out, "pc", dim="cls", value="p", decimals=9)


# M15 -----------------------------------------------------------------------
def _lr_fit(df):
    return L.fit_softmax_lbfgs(df, reg=1e-4, max_iter=50)


def _lr_predict(model, df):
    return model.predict(df)


@register("isotonic_calibrate")
def q_isotonic(spark, sf):
    """Rows-only: cross-validated isotonic calibration of a softmax regression."""
    tr, va = _train(spark, sf)
    classes = ev.distinct_labels(tr)
    cal = C.fit_isotonic_cv(tr, classes, _lr_fit, _lr_predict, cv=3)
    out = cal.predict(va.select("row_id", "label", "features"))
    return explode_long(out, "proba", dim="cls", value="p")


# M19 / M20 -----------------------------------------------------------------
@register("specialist_fit")
def q_specialist_fit(spark, sf):
    """Rows-only: one-vs-rest (3, 7, 9) and pairwise (3v5, 7v9) binary LR coefficient table."""
    tr, _ = _train(spark, sf)
    specs = SP.fit_specialists(tr)
    return SP.specialists_frame(spark, specs)


@register("specialist_override", PROBA_SQL + f""",
w AS (SELECT row_id, p, cls, row_number() OVER (PARTITION BY row_id ORDER BY p DESC, cls) AS rn FROM p),
top AS (SELECT row_id, cls AS pred, p AS ppred FROM w WHERE rn = 1),
sp AS (SELECT row_id, 1 / (1 + exp(-(10 * f[11]))) AS p35, 1 / (1 + exp(-(10 * f[12]))) AS p79 FROM e)
SELECT top.row_id, top.pred::BIGINT AS pred,
       (CASE WHEN top.pred IN (3, 5) AND top.ppred < 0.7 THEN (CASE WHEN sp.p35 >= 0.5 THEN 3 ELSE 5 END)
             WHEN top.pred IN (7, 9) AND top.ppred < 0.7 THEN (CASE WHEN sp.p79 >= 0.5 THEN 7 ELSE 9 END)
             ELSE top.pred END)::BIGINT AS final
FROM top JOIN sp USING (row_id)""")
def q_specialist_override(spark, sf):
    df = with_proba(spark, sf)
    df = df.withColumn("pred", F.array_position("p", F.array_max("p")).cast("int") - 1)
    df = df.withColumn("p35", sigmoid(F.lit(10.0) * F.col("features")[10])) \
           .withColumn("p79", sigmoid(F.lit(10.0) * F.col("features")[11]))
    out = SP.apply_overrides(df, SP.PAIR_RULES, proba="p", pred="pred", out="final",
                             classes=_classes(), scores={(3, 5): "p35", (7, 9): "p79"})
    return out.select("row_id", big("pred").alias("pred"), big("final").alias("final"))
