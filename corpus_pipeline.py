"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; the last one returns what the mix takes of each
document that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm import decontaminate, mixing, neardup, secrets, toxicity
from tabwise.llm.common import fold, table
from tabwise.session import drop_scratch, scratch_path

SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), toxicity.FOLDS) != 0)
    model = toxicity.train(docs, labels)
    scored = docs.select(F.struct("*").alias("row"), toxicity.toxicity(F.col("text"), model).alias("found"))
    return scored.filter(F.col("found.score") < 0.5).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, of repeated rows one row."""
    found = neardup.near_duplicates(docs.select("doc_id", "text"), SHINGLE).filter("kept")
    def key(id_: str, text: Column) -> list[Column]:
        return [F.coalesce(F.col(id_).cast("string"), F.lit("")).alias("id"), text.alias("text_key")]

    kept = found.select(*key("doc_id", F.col("text_key"))).distinct()
    keyed = docs.select(F.struct("*").alias("row"), *key("doc_id", F.xxhash64("text")))
    # Joined and deduplicated by the same key: one shuffle of the texts.
    return keyed.join(kept, ["id", "text_key"], "left_semi").dropDuplicates(["id", "text_key"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    found = decontaminate.find_contamination(rows, table(spark, sf_dir, "benchmark"))
    return found.filter(F.col("n_hit") == 0).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced by a mark."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document left."""
    return mixing.mix_sources(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix),
]

#: A trained model decides in the first stage: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``.

    The tables between them lie under the session's checkpoint folder, and go as
    soon as the next stage is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
