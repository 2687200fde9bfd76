"""Natural cubic spline through the known values of a series (M7, method
``cubic``), for series of any length.

The second derivatives at the known places solve a tridiagonal system.  It is cut
into blocks of consecutive places: a task eliminates the inside of its block and
leaves two rows, which tie the block's first and last unknown to the last one
before and the first one after it.  These interface rows (two a block) are solved
per series, and every block then gets its unknowns back.  A block's own three
right-hand sides are solved at once by cyclic reduction in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import blocked, carry_fill, materialize
from ..session import ship_package

BLOCK_KNOTS = 1 << 16


def tridiagonal(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Solve ``a[i] x[i-1] + b[i] x[i] + c[i] x[i+1] = d[i]`` (columns of ``d``) for a
    diagonally dominant system: even unknowns are taken out, the rest follows."""
    n = len(b)
    if n == 0:
        return np.zeros_like(d)
    if n == 1:
        return d / b[:, None]
    a, c = a.copy(), c.copy()
    a[0] = c[-1] = 0.0
    odd = np.arange(1, n, 2)
    after = np.minimum(odd + 1, n - 1)
    down = a[odd] / b[odd - 1]
    up = np.where(odd + 1 < n, c[odd] / b[after], 0.0)
    x = np.empty_like(d)
    x[odd] = tridiagonal(-down * a[odd - 1], b[odd] - down * c[odd - 1] - up * a[after], -up * c[after],
                         d[odd] - down[:, None] * d[odd - 1] - up[:, None] * d[after])
    even = np.arange(0, n, 2)
    left = np.where((even > 0)[:, None], x[np.maximum(even - 1, 0)], 0.0)
    right = np.where((even + 1 < n)[:, None], x[np.minimum(even + 1, n - 1)], 0.0)
    x[even] = (d[even] - a[even][:, None] * left - c[even][:, None] * right) / b[even][:, None]
    return x


def _equations(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(place, a, b, c, d) of a block's own knots; ``pdf`` has those and a knot on
    either side where there is one.  The curvature is 0 at both ends of a series."""
    pdf = pdf.sort_values("knot")
    x, y = pdf["x"].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float)
    own = np.flatnonzero(~pdf["halo"].to_numpy(dtype=bool))
    n = len(own)
    a, b, c, d = np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n)
    inner = np.flatnonzero((own > 0) & (own < len(x) - 1))
    at = own[inner]
    h0, h1 = x[at] - x[at - 1], x[at + 1] - x[at]
    a[inner], b[inner], c[inner] = h0, 2 * (h0 + h1), h1
    d[inner] = 6 * ((y[at + 1] - y[at]) / h1 - (y[at] - y[at - 1]) / h0)
    return pdf["knot"].to_numpy()[own], a, b, c, d


def _reduced(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(knots, x): x = u - before * v - after * w for the block's unknowns."""
    knot, a, b, c, d = _equations(pdf)
    rhs = np.zeros((len(b), 3))
    rhs[:, 0] = d
    rhs[0, 1], rhs[-1, 2] = a[0], c[-1]
    return knot, tridiagonal(a, b, c, rhs)


def _interface(pdf: pd.DataFrame) -> pd.DataFrame:
    """Unknowns before and after every block of one series, from the blocks' two
    rows: forward elimination of (first, last) pairs, then back."""
    pdf = pdf.sort_values("blk").reset_index(drop=True)
    u = pdf[["u0", "v0", "w0", "u1", "v1", "w1"]].to_numpy(dtype=float)
    n = len(u)
    # last[k] = p[k] - q[k] * first[k + 1], first[k] = r[k] - s[k] * first[k + 1]
    p, q, r, s = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    before = (0.0, 0.0)     # last of the block before as value - slope * first of this one
    for k, (u0, v0, w0, u1, v1, w1) in enumerate(u):
        # first = u0 - v0 * last_before - w0 * next, last_before = value - slope * first
        scale = 1 - v0 * before[1]
        r[k], s[k] = (u0 - v0 * before[0]) / scale, w0 / scale
        # last = u1 - v1 * (value - slope * first) - w1 * next
        p[k] = u1 - v1 * (before[0] - before[1] * r[k])
        q[k] = w1 + v1 * before[1] * s[k]
        before = (p[k], q[k])
    first, last = np.zeros(n + 1), np.zeros(n + 1)
    for k in range(n - 1, -1, -1):
        first[k], last[k] = r[k] - s[k] * first[k + 1], p[k] - q[k] * first[k + 1]
    pdf["before"] = np.concatenate([[0.0], last[:n - 1]])
    pdf["after"] = first[1:]
    return pdf


def second_derivatives(knots: DataFrame, keys: Sequence[str], block_knots: int = BLOCK_KNOTS) -> DataFrame:
    """(keys, x, y, m): the natural spline's second derivative at every known
    place; ``knots`` has the keys (one at least, none null), x (rising within a
    series) and y."""
    ship_package(knots.sparkSession)
    base = [knots.schema[k] for k in keys]
    bl = materialize(blocked(knots.select(*keys, "x", "y"), ["x"], keys, block_knots, back=1, fwd=1).select(
        *keys, "x", "y", F.col("_idx").alias("knot"), F.col("_blk").alias("blk"), F.col("_halo").alias("halo")))
    by, k = [*keys, "blk"], len(keys)
    ends = T.StructType([*base, T.StructField("blk", bl.schema["blk"].dataType), *[T.StructField(c, T.DoubleType())
                                                                                  for c in ("u0", "v0", "w0", "u1", "v1", "w1")]])

    def reduce_block(key, pdf):
        if pdf["halo"].all():
            return pd.DataFrame([], columns=ends.names)
        _, x = _reduced(pdf)
        return pd.DataFrame([[*key, *x[0], *x[-1]]], columns=ends.names)

    rows = bl.groupBy(*by).applyInPandas(reduce_block, ends)
    sides = T.StructType([*ends.fields[:k + 1], T.StructField("before", T.DoubleType()), T.StructField("after", T.DoubleType())])

    def between(pdf):
        return _interface(pdf)[sides.names]

    # Two numbers a block of a series: bounded by its length over the block size.
    borders = rows.groupBy(*keys).applyInPandas(between, sides)
    out = T.StructType([*base, T.StructField("x", knots.schema["x"].dataType), T.StructField("y", T.DoubleType()), T.StructField("m", T.DoubleType())])

    def finish_block(key, a, b):
        if not len(b):
            return pd.DataFrame([], columns=out.names)
        knot, x = _reduced(a)
        m = x[:, 0] - float(b["before"].iloc[0]) * x[:, 1] - float(b["after"].iloc[0]) * x[:, 2]
        own = a[~a["halo"].astype(bool)].sort_values("knot")
        return own.assign(m=m)[out.names]

    return bl.groupBy(*by).cogroup(borders.groupBy(*by)).applyInPandas(finish_block, out)


def _value(x: Column, p: Column, n: Column) -> Column:
    h = n["x"] - p["x"]
    a, b = (n["x"] - x) / h, (x - p["x"]) / h
    return a * p["y"] + b * n["y"] + ((a * a * a - a) * p["m"] + (b * b * b - b) * n["m"]) * h * h / 6


def fill_cubic(df: DataFrame, order: Sequence[str], column: str, keys: Sequence[str] = (), x_col: str | None = None,
               block_rows: int = 1 << 20, block_knots: int = BLOCK_KNOTS) -> DataFrame:
    """``df`` with the nulls of ``column`` between two known values of the series
    (``keys``, in ``order``) on its natural cubic spline; places are row numbers,
    or the numbers of ``x_col``, which must then rise in ``order``.  Nulls before
    the first and after the last known value stay, as do all of a series with one
    known value; with two the spline is a line."""
    # A series by one name that is never null, null keys and no keys included.
    named = df.withColumn("_series", F.to_json(F.struct(*[F.col(k) for k in keys])) if keys else F.lit(""))
    bl = materialize(blocked(named, order, ["_series"], block_rows).drop("_halo"))
    x = (F.col(x_col) if x_col else F.col("_idx")).cast("double")
    y = F.col(column).cast("double")
    y = F.when(~F.isnan(y), y)
    rows = bl.withColumn("_x", x).withColumn("_y", y)
    m = second_derivatives(rows.where("_y IS NOT NULL").select("_series", F.col("_x").alias("x"), F.col("_y").alias("y")), ["_series"], block_knots)
    met = m.select("_series", F.col("x").alias("_x"), F.lit(True).alias("_known"), F.struct("x", "y", "m").alias("_p"))
    known = rows.withColumn("_known", F.when(F.col("_y").isNotNull(), True)).join(met, ["_series", "_x", "_known"], "left")
    known = known.withColumn("_n", F.col("_p"))
    near = carry_fill(carry_fill(known, ["_p"], ["_series"], forward=True), ["_n"], ["_series"], forward=False)
    filled = F.when(F.col("_y").isNotNull(), F.col("_y")).when(
        F.col("_p").isNotNull() & F.col("_n").isNotNull(), _value(F.col("_x"), F.col("_p"), F.col("_n")))
    return near.select(*[filled.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])
