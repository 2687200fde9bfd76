"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables; the SQL (when present) computes the same result on the same
Parquet files in DuckDB.  ``None`` marks operators with no SQL equivalent
(models, iterative or stateful jobs): only their row counts are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    """Import every plan module so that its queries register themselves."""
    import importlib
    for mod in PLAN_MODULES:
        importlib.import_module(f"{__package__}.{mod}")
    return REGISTRY


PLAN_MODULES = ["credit", "prep", "series", "text", "monitor", "ml_queries", "web", "io_queries", "dashboard"]
