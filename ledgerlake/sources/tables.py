"""Table scans over the Parquet warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, nan_to_null: bool = False) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``.

    With ``nan_to_null`` every floating column gets ``nanvl(c, null)`` so the
    pandas null model (NaN = missing) holds; the projection stays inside
    whole-stage codegen and does not block filter pushdown or pruning.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if not nan_to_null:
        return df
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
