"""Frequency tables, grouped aggregates, pivots with margins, shares, KPIs.

All of these are hash aggregates with a partial (map-side) phase, so a hot group
is combined inside each task before the shuffle and never lands whole in one task.
Null group keys are dropped first, as a pandas ``groupby`` / ``crosstab`` does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _non_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def _measure(df: DataFrame, c: str):
    # avg/sum skip null but not NaN: treat NaN as missing, like pandas.
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(c), F.lit(None).cast("double"))
    return F.col(c)


def value_counts(df: DataFrame, column: str, count_name: str = "count",
                 label: str | None = None) -> DataFrame:
    """Non-null values and their counts, most frequent first."""
    label = label or column
    out = (_non_null(df, column).groupBy(F.col(column).alias(label))
           .agg(F.count(F.lit(1)).alias(count_name)))
    return out.orderBy(F.desc(count_name), F.asc(label))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, null included (order not kept)."""
    return df.select(column).distinct()


def group_mean(df: DataFrame, by: str, columns: list[str], ordered: bool = True) -> DataFrame:
    """Mean per group, largest first on the first measure (``ordered=False``: no sort)."""
    out = _non_null(df, by).groupBy(by).agg(
        *[F.avg(_measure(df, c)).alias(c) for c in columns])
    return out if not ordered else out.orderBy(F.desc_nulls_last(columns[0]), F.asc(by))


def group_sum(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return _non_null(df, by).groupBy(by).agg(
        *[F.sum(_measure(df, c)).alias(c) for c in columns])


def top_k(df: DataFrame, order_col: str, k: int, tiebreak: str | None = None,
          ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``order_col`` (planned as TakeOrderedAndProject)."""
    primary = F.asc_nulls_last(order_col) if ascending else F.desc_nulls_last(order_col)
    keys = [primary] + ([F.asc(tiebreak)] if tiebreak else [])
    return df.orderBy(*keys).limit(k)


def pair_counts(df: DataFrame, row: str, column: str, count_name: str = "count") -> DataFrame:
    """(row, column, count): the long form of ``pivot_count``, for any number of labels."""
    return (_non_null(df, row, column).groupBy(row, column)
            .agg(F.count(F.lit(1)).alias(count_name)))


def pivot_count(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Two-key count spread wide, missing cells 0 (``groupby.count().unstack``).

    The big table is read once: (row, column) counts are aggregated with a
    map-side combine and checkpointed; the pivot values (when not given) and
    the pivot itself then read that small table. Spark refuses more than
    ``spark.sql.pivotMaxValues`` distinct pivot values; ``pair_counts`` is the
    form without that limit.
    """
    long = pair_counts(df, row, column, "_tw_n")
    if values is None:
        long = long.checkpoint(eager=True)
    pivoted = long.groupBy(row).pivot(column, values).agg(F.sum("_tw_n"))
    value_cols = [c for c in pivoted.columns if c != row]
    return pivoted.select(row, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(c)
                                 for c in value_cols])


def crosstab(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Contingency table of two columns (null labels dropped)."""
    return pivot_count(df, row, column, values)


def row_totals(table: DataFrame, row: str, total_name: str = "Total",
               min_total: float | None = None) -> DataFrame:
    """Add the row total of the value columns; keep rows with total > ``min_total``."""
    value_cols = [c for c in table.columns if c != row]
    out = table.withColumn(total_name, reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in value_cols]))
    if min_total is not None:
        out = out.where(F.col(total_name) > F.lit(min_total))
    return out


def add_margins(table: DataFrame, row: str, total_name: str = "Total",
                min_total: float | None = None, total_label: str = "total") -> DataFrame:
    """Row totals, an optional ``Total > min_total`` filter, then a column-totals row.

    The totals row sums the rows kept by the filter, and is labelled ``total_label``.
    """
    with_total = row_totals(table, row, total_name, min_total)
    value_cols = [c for c in with_total.columns if c != row]
    sums = with_total.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in value_cols])
    totals_row = sums.select(F.lit(total_label).cast("string").alias(row), *[F.col(f"`{c}`") for c in value_cols])
    body = with_total.withColumn(row, F.col(f"`{row}`").cast("string"))
    return body.unionByName(totals_row)


def crosstab_margins(df: DataFrame, row: str, column: str, values: list | None = None,
                     total_name: str = "Total", min_total: float | None = None,
                     total_label: str = "total") -> DataFrame:
    """Contingency table with row totals, an optional ``Total > min_total`` filter, and a column-totals row.

    The same table as ``add_margins`` over ``crosstab``, from one aggregate by grouping
    sets: cells and row totals (and the column labels, unless given) come from a single
    scan. The pivot and the totals row then work on that small table, which is
    shuffled once for both: three shuffles in all.
    """
    pairs = _non_null(df, row, column)
    sets = [[F.col(f"`{row}`"), F.col(f"`{column}`")], [F.col(f"`{row}`")]] + ([] if values is not None else [[F.col(f"`{column}`")]])
    long = pairs.groupingSets(sets, F.col(f"`{row}`"), F.col(f"`{column}`")).agg(
        F.count(F.lit(1)).alias("_tw_n"), F.grouping_id().alias("_tw_set"))
    no_column, no_row = 1, 2
    if values is None:
        long = long.checkpoint(eager=True)
        labels = long.where(F.col("_tw_set") == no_row).select(F.col(f"`{column}`").alias("label")).collect()
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        if len(labels) > most:
            raise ValueError(f"{column} has {len(labels)} labels, more than spark.sql.pivotMaxValues = {most}; see pair_counts")
        values = sorted(r.label for r in labels)

    def name(v) -> str:
        return str(v).lower() if isinstance(v, bool) else str(v)

    cells = [F.coalesce(F.sum(F.when((F.col("_tw_set") == 0) & (F.col(f"`{column}`") == F.lit(v)), F.col("_tw_n"))), F.lit(0))
             .cast("bigint").alias(f"_tw_{i}") for i, v in enumerate(values)]
    total = F.sum(F.when(F.col("_tw_set") == no_column, F.col("_tw_n"))).alias("_tw_total")
    table = long.where(F.col("_tw_set") != no_row).groupBy(F.col(f"`{row}`").alias("_tw_row")).agg(*cells, total)
    if min_total is not None:
        table = table.where(F.col("_tw_total") > F.lit(min_total))
    numbers = [f"_tw_{i}" for i in range(len(values))] + ["_tw_total"]
    names = [*map(name, values), total_name]
    body = table.select(F.col("_tw_row").cast("string").alias(row), *[F.col(c).alias(n) for c, n in zip(numbers, names)])
    totals = table.agg(*[F.sum(c).alias(c) for c in numbers]).select(
        F.lit(total_label).alias(row), *[F.col(c).alias(n) for c, n in zip(numbers, names)])
    return body.unionByName(totals)


def matrix_range(table: DataFrame, columns: list[str]) -> DataFrame:
    """Largest and smallest cell over a block of columns."""
    cells = [F.col(f"`{c}`") for c in columns]
    largest, smallest = (F.greatest(*cells), F.least(*cells)) if len(cells) > 1 else (cells[0], cells[0])
    return table.agg(F.max(largest).alias("max_value"), F.min(smallest).alias("min_value"))


def share_of_total(df: DataFrame, by: str, measures: list[str], total: str,
                   suffix: str = "_share", count_name: str | None = None) -> DataFrame:
    """Per-group sums of the measures and of the total, plus each measure's share.

    ``count_name`` adds the group's row count from the same aggregate.
    """
    aggs = [F.sum(_measure(df, c)).alias(c) for c in measures + [total]]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    sums = _non_null(df, by).groupBy(by).agg(*aggs)
    return sums.select("*", *[F.try_divide(F.col(m), F.col(total)).alias(m + suffix)
                              for m in measures])


def kpis(df: DataFrame, revenue: str, by: list[str] | None = None) -> DataFrame:
    """Revenue, item count and average ticket (revenue / count)."""
    aggs = [F.sum(_measure(df, revenue)).alias("revenue"), F.count(F.lit(1)).alias("quantity")]
    grouped = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return grouped.withColumn("avg_ticket", F.try_divide(F.col("revenue"), F.col("quantity")))
