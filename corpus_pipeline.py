"""The corpus pipeline: quality rules, near-copies, benchmark leaks, mixing,
token output.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the session's shared folder and hands what it reads back to
the next.  Stages but the last return the columns of ``documents``.  What a
stage decides takes effect: rows that fail the rules, further copies and leaked
documents are gone, the mixture repeats under-weighted sources and its row
order (file by file) is the schedule's, and the tokens are written in that
order."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import forget, scratch_dir, scratch_scope
from ledgerlake.llm.decontam import drop_contaminated
from ledgerlake.llm.mix import mixed_rows
from ledgerlake.llm.quality import keep_good
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.llm.simhash import keep_one_per_group
from ledgerlake.llm.tokens import tokenise
from ledgerlake.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_group(docs, shingle=4, max_distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document and epoch its place and checksum in the token files, which
    follow the order of the stored rows."""
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")] if _stored(docs) else None
    return tokenise(docs, tokenizer_path=tokenizer_path(), end_id=2, order=order)


def _stored(docs: DataFrame) -> bool:
    """Whether the rows come from files, and so have a place in them."""
    return bool(docs.inputFiles())


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_copies), ("decontamination", decontaminate),
          ("source_mixing", mix), ("token_output", token_output)]

# The classifier, the link graph and the tokenizer have no SQL form; tested
# against a brute-force rendering instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Intermediate tables are deleted once the
    stage after them is written; the last stage's rows and token files stay."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        with contextlib.nullcontext() if (name, stage) == STAGES[-1] else scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            forget(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
