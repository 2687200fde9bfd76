"""Staged files do not grow with the documents."""

from pyspark.sql import functions as F

from ledgerlake.plans.io_queries import stage_files


def test_files_follow_the_rows(spark):
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("web").alias("source"))
    sizes = [n for n in stage_files(docs, 100).rdd.glom().map(len).collect()]
    assert sum(sizes) == 8000 and max(sizes) < 1000          # one source, not one file
    assert stage_files(docs.limit(50), 100).rdd.getNumPartitions() == 4
