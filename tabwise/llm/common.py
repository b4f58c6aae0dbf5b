"""Column helpers shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.session import ensure_checkpoint_dir

#: Separators of plain words, and of alphanumeric words, as classes for a pattern.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
NON_WORD_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Prefix sums add up within blocks of this many entries, then over the blocks.
_BLOCK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, separators: str) -> Column:
    """The non-empty parts between runs of separators; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint into the session's shared folder, so that no later step recomputes."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def prefix_sums(numbers: Column) -> Column:
    """array(n0, n0+n1, ...) of an array of longs, in two levels so that long arrays stay cheap."""
    zero = F.array().cast("array<bigint>")

    def running(values: Column) -> Column:
        return F.aggregate(values, zero, lambda done, x: F.concat(
            done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + x)))

    count = F.size(numbers)
    blocks = F.when(count > 0, F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
        lambda b: running(F.slice(numbers, b * _BLOCK + 1, _BLOCK))))
    before = running(F.transform(blocks, lambda b: F.try_element_at(b, F.lit(-1))))
    return F.coalesce(F.flatten(F.transform(
        blocks, lambda b, i: F.transform(b, lambda x: x + F.when(i > 0, F.get(before, i - 1)).otherwise(0)))), zero)
