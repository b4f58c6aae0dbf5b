"""Column cleaning: numeric conversion, rejects, imputation, mapping, point update."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.functions import convert as C
from tabwise.operators.ordinal import with_ordinal


def to_numeric(df: DataFrame, column: str, strip: str = "',",
               dtype: str = "double", strict: bool = True) -> DataFrame:
    """Strip separator characters, then cast (strict fails on bad text).

    A cell that is blank then is missing: null, not an error.
    """
    cleaned = C.strip_chars(column, strip) if strip else F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        cleaned = F.when(F.trim(cleaned) != "", cleaned)
    cast = C.to_number(cleaned, dtype) if strict else C.try_number(cleaned, dtype)
    return df.withColumn(column, cast)


def cast_rejects(df: DataFrame, column: str, dtype: str = "double") -> DataFrame:
    """Rows whose present value cannot be cast: the cells to inspect and fix."""
    return df.where(C.cast_reject(column, dtype))


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls (and NaN) with the column mean.

    The means are one global aggregate, i.e. one row: broadcasting it is bounded
    by construction.
    """
    def value(c):
        dtype = df.schema[c].dataType
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return F.nanvl(F.col(c), F.lit(None).cast(dtype))
        return F.col(c)

    means = df.agg(*[F.avg(value(c)).alias(f"_tw_mean_{i}") for i, c in enumerate(columns)])
    out = df.crossJoin(F.broadcast(means))
    for i, c in enumerate(columns):
        out = out.withColumn(c, F.coalesce(value(c).cast("double"), F.col(f"_tw_mean_{i}")))
    return out.drop(*[f"_tw_mean_{i}" for i in range(len(columns))])


def map_column(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace whole values by a dictionary; other values are kept."""
    return df.withColumn(column, C.map_values(column, mapping))


def map_column_by_table(df: DataFrame, column: str, lookup: DataFrame,
                        from_col: str = "from", to_col: str = "to") -> DataFrame:
    """Dictionary too large to inline: left join a lookup table, keep unmapped."""
    lk = lookup.select(F.col(from_col).alias("_tw_from"), F.col(to_col).alias("_tw_to"))
    out = df.join(lk, df[column] == lk["_tw_from"], "left")
    return out.withColumn(column, F.coalesce("_tw_to", column)).drop("_tw_from", "_tw_to")


def update_cell(df: DataFrame, column: str, key_col: str, key, value) -> DataFrame:
    """Set one cell, addressed by a stable key (Spark rows have no position)."""
    return df.withColumn(column, C.set_cell(column, key_col, key, value))


def cell_at(df: DataFrame, order_cols: list, position: int, column: str) -> DataFrame:
    """The cell at 0-based ``position`` in ``order_cols`` order (one row, or none).

    Spark rows have no index: the position is a consecutive ordinal over a
    global sort (``with_ordinal``), not a single-task window. Rows equal in
    ``order_cols`` stand in the order of a hash of the row, whatever the partitions.
    """
    indexed = with_ordinal(df, order_cols, "_tw_pos")
    return indexed.where(F.col("_tw_pos") == F.lit(position)).select(column)


def update_cell_at(df: DataFrame, order_cols: list, position: int, column: str,
                   value) -> DataFrame:
    """Set the cell at 0-based ``position`` (in ``order_cols`` order, ties as for ``cell_at``)."""
    indexed = with_ordinal(df, order_cols, "_tw_pos")
    out = indexed.withColumn(column, F.when(F.col("_tw_pos") == F.lit(position), F.lit(value))
                             .otherwise(F.col(column)))
    return out.select(*df.columns)
