"""A corpus pipeline of five stages, each of which takes and gives whole tables.

Quality rules, near-duplicate removal, removal of repeated strings, benchmark decontamination
and packing.  All but the last return the columns of ``documents``; the last returns a row for
each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import decontaminate, jaccard_join, packing, quality_rules, suffix_dedup
from tidegrid.llm.common import saved


#: Rows that Spark hands to Python at a time, at most: whole texts are long, and several tasks share an executor's memory.
ROWS = 2000


def _short_batches(spark: SparkSession) -> None:
    """Sets the session's batches to ``ROWS`` rows, unless they are shorter already; the plans of all later stages heed it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS:
        spark.conf.set(name, str(ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group that near-duplicate links connect."""
    _short_batches(spark)
    return jaccard_join.keep_first(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that occur earlier; ``n_chars`` follows the text.

    Rows with a null id stay as they are.
    """
    _short_batches(spark)
    cut = suffix_dedup.remove_repeats(docs)
    changed = F.col("doc_id").isNotNull()
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))) if "n_chars" in cut.columns else cut


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    _short_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 2048 tokens."""
    _short_batches(spark)
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Stages two to five cannot be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each stage's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
