"""Dataset preparation for a labelled set: split, one-hot labels, rescaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwise.functions.arrays import one_hot, rescale
from tabwise.operators.ordinal import grouped_rank, with_ordinal

TRAINING = "training"
VALIDATION = "validation"


def class_split(df: DataFrame, label: str, order: str, validation_fraction: float = 0.3,
                subset_col: str = "subset") -> DataFrame:
    """Deterministic per-class split: the first ``floor(fraction * n)`` items of
    each class (by ``order``) are validation, the rest training.

    The per-class rank comes from a global sort, so a dominant class is still
    spread across tasks.
    """
    ranked = grouped_rank(df, [label], [order], "_tw_rank", "_tw_size")
    cut = F.floor(F.lit(float(validation_fraction)) * F.col("_tw_size"))
    return (ranked.withColumn(subset_col, F.when(F.col("_tw_rank") < cut, F.lit(VALIDATION))
                                            .otherwise(F.lit(TRAINING)))
                  .drop("_tw_rank", "_tw_size"))


def class_positions(df: DataFrame, label: str, position: str = "position") -> DataFrame:
    """(label, position): the distinct present labels, numbered from 0 in sorted order."""
    distinct = df.where(F.col(label).isNotNull()).select(label).distinct()
    return with_ordinal(distinct, [label], position).withColumn(position, F.col(position).cast("int"))


def class_index(df: DataFrame, label: str, position: str = "position") -> DataFrame:
    """Each row with its class's position (null without a label): the sparse one-hot form.

    A join on the label table, for any number of classes.
    """
    return df.join(class_positions(df, label, position), on=label, how="left").select(*df.columns, position)


def one_hot_labels(df: DataFrame, label: str, out: str = "one_hot") -> DataFrame:
    """0/1 vector per row over the classes in sorted order; all zeros without a label.

    As wide as there are classes: with very many of them use ``class_index``.
    """
    positions = class_positions(df, label, "_tw_position")
    width = positions.agg(F.count(F.lit(1)).cast("int").alias("_tw_width"))  # one row
    indexed = df.join(positions, on=label, how="left").crossJoin(F.broadcast(width))
    return indexed.select(*df.columns, one_hot("_tw_position", "_tw_width").alias(out))


def rescale_column(df: DataFrame, column: str, factor: float = 1.0 / 255,
                   out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, rescale(column, factor))
