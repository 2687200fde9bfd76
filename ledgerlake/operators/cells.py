"""Wide-column cell table (S12-S15): a long DataFrame of
(row_key, family, qualifier, value, version) cells instead of a key-value
store.  Writes are appends; reads resolve the latest version per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TS = 9999999999  # reversed-timestamp row keys: newest first in key order


def reversed_key(code, epoch_seconds) -> F.Column:
    """``code#(9999999999 - ts)`` zero-padded to 10 digits."""
    return F.concat(code, F.lit("#"), F.lpad((F.lit(MAX_TS) - epoch_seconds).cast("string"), 10, "0"))


def to_cells(df: DataFrame, key: F.Column, family: str, qualifiers: Sequence[str], version) -> DataFrame:
    """Unpivot wide rows into cells (a put of every qualifier)."""
    st = F.explode(F.array(*[F.struct(F.lit(q).alias("qualifier"), F.col(q).cast("double").alias("value"))
                             for q in qualifiers])).alias("c")
    return df.select(key.alias("row_key"), st, F.lit(version).cast("long").alias("version")) \
             .select("row_key", F.lit(family).alias("family"), "c.qualifier", "c.value", "version")


def latest_cells(cells: DataFrame) -> DataFrame:
    """Last write wins per (row_key, family:qualifier)."""
    return cells.groupBy("row_key", "family", "qualifier").agg(F.max_by("value", "version").alias("value"))


def pivot_rows(cells: DataFrame, family: str, qualifiers: Sequence[str]) -> DataFrame:
    """Latest cells of one family as wide rows; the qualifier list is given,
    so ``pivot`` needs no extra distinct job."""
    lc = latest_cells(cells).where(F.col("family") == family)
    return lc.groupBy("row_key").pivot("qualifier", list(qualifiers)).agg(F.first("value"))


def prefix_scan(rows: DataFrame, prefix: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows whose key starts with ``prefix``, in key order, optional limit."""
    out = rows if prefix is None else rows.where(F.col("row_key").startswith(prefix))
    out = out.orderBy("row_key")
    return out.limit(limit) if limit else out


def point_get(rows: DataFrame, row_key: str) -> DataFrame:
    """One row by key (empty when absent)."""
    return rows.where(F.col("row_key") == row_key)


def scan_to_frame(rows: DataFrame, qualifiers: Sequence[str], code_col="stock_code", idx_col="date_idx") -> DataFrame:
    """Split the key into code and reversed timestamp, missing cells
    become 0, true time recovered as 9999999999 - idx."""
    parts = F.split("row_key", "#")
    return rows.select(parts.getItem(0).alias(code_col), parts.getItem(1).cast("long").alias(idx_col),
                       *[F.coalesce(F.col(q), F.lit(0.0)).alias(q) for q in qualifiers]) \
               .withColumn("epoch_seconds", F.lit(MAX_TS) - F.col(idx_col))
