"""Column-expression helpers shared by all operators.  Everything here
returns a ``Column`` built from JVM functions, so it fuses into codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-8


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """pandas ``clip``: null stays null (``least``/``greatest`` skip nulls)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo) if not isinstance(lo, Column) else lo)
    if hi is not None:
        out = F.least(out, F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def safe_div(num, den) -> Column:
    """Division that yields null on a zero denominator (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def inf_to_null(c) -> Column:
    c = col(c)
    return F.when(c.isin(float("inf"), float("-inf")) | F.isnan(c), F.lit(None)).otherwise(c)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric (not boolean) columns, the rule ``select_dtypes(np.number)`` uses."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def bins_right_closed(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(include_lowest=True)``: (e0,e1] with e0 itself included,
    (e1,e2], ...; outside every bin is null.  ``Bucketizer`` is left-closed,
    so this is a CASE chain instead."""
    c = col(c)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (c >= lo) & (c <= hi) if i == 0 else (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def bins_right_closed_sql(c: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{c} >= {lo} AND {c} <= {hi}" if i == 0 else f"{c} > {lo} AND {c} <= {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " ELSE NULL END"


def rnd(c, digits: int = 6) -> Column:
    """Round half-even (numpy's rule); used only at the very end of a plan."""
    return F.bround(col(c).cast("double"), digits)


def stack_columns(names: Sequence[str], values: Sequence[Column], name_col="column",
                  value_col="value") -> Column:
    """An ``explode`` source that unpivots equally typed columns."""
    return F.explode(F.array(*[F.struct(F.lit(n).alias(name_col), v.alias(value_col))
                               for n, v in zip(names, values)]))


def round_binary(c, digits: int = 2) -> Column:
    """Round on the binary value (numpy's ``round`` and DuckDB's behaviour
    for values that are not exact ties), unlike ``round``/``bround`` which
    round the shortest decimal representation: 168.175 (stored as
    168.17499999...) gives 168.17."""
    p = 10.0 ** digits
    x = col(c).cast("double")
    return F.signum(x) * F.floor(F.abs(x) * p + 0.5) / p
