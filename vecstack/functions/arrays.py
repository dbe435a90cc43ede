"""Array and scalar column functions over labelled vectors.

Everything here is a Catalyst expression (no Python UDF).  Functions that need
a per-row statistic before an element-wise step (norm, max, sum) pass it to the
lambda as a second array argument (``zip_with(x, array_repeat(stat, size(x)))``)
instead of referencing an outer column inside the lambda: Catalyst's
CollapseProject may inline an outer column into a lambda body, which would
re-evaluate the statistic once per element (and compound when nested).  As a
lambda argument it is evaluated once per row whatever the optimizer inlines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed numerical constants shared with the reference semantics.
NORM_EPS = 1e-12        # added to the L2 norm and to probability-row sums
LOGIT_CLIP = 1e-12      # probabilities are clipped to [1e-12, 1 - 1e-12]
TEMPERATURE = 1.15      # P ** (1 / 1.15) soft temperature


def const_array(vals, kind: str = "double") -> Column:
    """A constant ``array<kind>`` from one JSON string literal: one JVM call whatever the length,
    folded to a literal by the optimizer (shortest-repr doubles round-trip exactly)."""
    import json
    if len(vals) == 0:
        return F.array().cast(f"array<{kind}>")
    items = [float(v) for v in vals] if kind == "double" else [int(v) for v in vals]
    return F.from_json(F.lit(json.dumps({"a": items})), f"a array<{kind}>")["a"]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    """``array<float>`` → ``array<double>`` (do this before any arithmetic)."""
    return col_of(c).cast("array<double>")


def cast_float32(c) -> Column:
    """Compact storage type, applied at a sink only."""
    return col_of(c).cast("array<float>")


def truncate_features(c, n: int) -> Column:
    """Keep the first ``n`` entries (label is a separate column)."""
    return F.slice(col_of(c), 1, n)


def concat_features(*cols) -> Column:
    """Horizontal concatenation of feature families, in argument order."""
    return F.concat(*[col_of(c) for c in cols])


def pixel_grid(df: DataFrame, features: str, side: int, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Long (row_id, y, x, v) view of a row-major side×side image."""
    out = df.select(*keep, F.posexplode(features).alias("pos", "v"))
    return out.select(*keep,
                      F.floor(F.col("pos") / side).cast("int").alias("y"),
                      (F.col("pos") % side).cast("int").alias("x"),
                      "v")


def array_sum(c) -> Column:
    return F.aggregate(col_of(c), F.lit(0.0), lambda acc, x: acc + x)


def per_element(arr: Column, stat: Column, fn) -> Column:
    """``fn(x, stat)`` for every element, ``stat`` evaluated once per row."""
    return F.zip_with(arr, F.array_repeat(stat, F.size(arr)), fn)


def l2_normalize(df: DataFrame, c: str, out: str | None = None, eps: float = NORM_EPS) -> DataFrame:
    """X / (‖x‖₂ + eps)."""
    out = out or c
    x = F.col(c)
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)) + F.lit(eps)
    return df.withColumn(out, per_element(x, norm, lambda v, n: v / n))


def one_hot(label, classes: Sequence[int]) -> Column:
    """P5: indicator array in sorted class order (unrolled, codegen-friendly)."""
    lab = col_of(label)
    return F.array(*[(lab == F.lit(int(k))).cast("double") for k in classes])


def label_filter(label, members: Sequence[int]) -> Column:
    """Row mask ``label ∈ members``."""
    return col_of(label).isin([int(m) for m in members])


def label_binarize(label, positive: Sequence[int]) -> Column:
    """1 when ``label ∈ positive`` else 0 (INT)."""
    return col_of(label).isin([int(m) for m in positive]).cast("int")


def softmax(df: DataFrame, c: str, out: str | None = None, eps: float | None = NORM_EPS) -> DataFrame:
    """exp(z - max z) / (Σ + eps) per row (``eps=None``: plain sum)."""
    out = out or c
    e = f"__e_{out}"
    df = df.withColumn(e, per_element(F.col(c), F.array_max(c), lambda z, m: F.exp(z - m)))
    tot = array_sum(e) if eps is None else array_sum(e) + F.lit(eps)
    return df.withColumn(out, per_element(F.col(e), tot, lambda x, s: x / s)).drop(e)


def clip(x, lo: float, hi: float) -> Column:
    """least(greatest(x, lo), hi)."""
    return F.least(F.greatest(col_of(x), F.lit(float(lo))), F.lit(float(hi)))


def logit(p, eps: float = LOGIT_CLIP) -> Column:
    """ln(p / (1 - p)) after clipping to [eps, 1 - eps]."""
    q = clip(p, eps, 1.0 - eps)
    return F.log(q / (F.lit(1.0) - q))


def sigmoid(z) -> Column:
    """P10: 1 / (1 + e^-z)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_of(z)))


def renormalize(df: DataFrame, c: str, out: str | None = None, eps: float | None = NORM_EPS) -> DataFrame:
    """Row / (Σ row + eps); ``eps=None`` divides by the plain sum."""
    out = out or c
    total = array_sum(c) if eps is None else array_sum(c) + F.lit(eps)
    return df.withColumn(out, per_element(F.col(c), total, lambda x, s: x / s))


def temperature_scale(df: DataFrame, c: str, out: str | None = None, t: float = TEMPERATURE) -> DataFrame:
    """P ** (1/t), renormalised by the plain row sum (argmax unchanged)."""
    out = out or c
    tmp = f"__pow_{out}"
    df = df.withColumn(tmp, F.transform(F.col(c), lambda x: F.pow(x, F.lit(1.0 / t))))
    return renormalize(df, tmp, out, eps=None).drop(tmp)


def polar(gx, gy) -> tuple[Column, Column]:
    """Magnitude and unsigned orientation in degrees, in [0, 180)."""
    gx, gy = col_of(gx), col_of(gy)
    mag = F.sqrt(gx * gx + gy * gy)
    ang = F.pmod(F.degrees(F.atan2(gy, gx)), F.lit(180.0))
    return mag, ang


def argmax_class(p, classes: Sequence[int] | Column) -> Column:
    """Class of the first maximal probability."""
    p = col_of(p)
    cls = classes if isinstance(classes, Column) else F.array(*[F.lit(int(k)) for k in classes])
    return F.element_at(cls, F.array_position(p, F.array_max(p)).cast("int"))


def array_logit(c) -> Column:
    return F.transform(col_of(c), lambda p: logit(p))
