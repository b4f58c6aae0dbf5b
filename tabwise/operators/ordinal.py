"""Consecutive ordinals and per-group ranks that do not funnel into one task.

``row_number()`` over a window without ``partitionBy`` moves every row into a
single task, and ``partitionBy(group)`` moves a hot group (say a third of all
rows) into one task. Here the ordering is a global range-partitioned sort,
spread over all tasks; each row's ordinal is its partition's offset plus its
position inside the partition. The offsets table has one row per partition, so
broadcasting it is bounded by the partition count, not by the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id() = partition index << 33 | row index in partition
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def row_order(df: DataFrame) -> list:
    """Two hashes of the row's contents (96 bits), to order rows by that are equal so far.

    Map columns take no part, as they cannot be hashed.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.xxhash64(*plain), F.hash(*plain)] if plain else []


def with_ordinal(df: DataFrame, order_cols: list, name: str = "ordinal",
                 cut_lineage: bool = True) -> DataFrame:
    """Add a 0-based consecutive ordinal following ``order_cols``.

    The sorted data is checkpointed to the session's checkpoint folder so the
    two reads below (offsets, rows) see the same partitions even if an executor
    is lost and a stage is recomputed. Ties go by a hash of the row: the same order
    however the rows are partitioned, and one that lets the range partitioner split a
    huge run of equal keys over many tasks. Rows equal in every column are
    interchangeable.
    """
    ordered = df.orderBy(*order_cols, *row_order(df))
    if cut_lineage:
        ordered = ordered.checkpoint(eager=True)
    tagged = (ordered
              .withColumn("_tw_mid", F.monotonically_increasing_id())
              .withColumn("_tw_pid", F.shiftright("_tw_mid", _ROW_BITS))
              .withColumn("_tw_row", F.col("_tw_mid").bitwiseAND(F.lit(_ROW_MASK))))
    counts = tagged.groupBy("_tw_pid").agg(F.count(F.lit(1)).alias("_tw_n"))
    before = Window.orderBy("_tw_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tw_pid", F.coalesce(F.sum("_tw_n").over(before), F.lit(0)).alias("_tw_off"))
    # One row per partition of the sorted data: a bounded broadcast.
    out = tagged.join(F.broadcast(offsets), "_tw_pid")
    return (out.withColumn(name, (F.col("_tw_off") + F.col("_tw_row")).cast("bigint"))
               .drop("_tw_mid", "_tw_pid", "_tw_row", "_tw_off"))


def grouped_rank(df: DataFrame, group_cols: list[str], order_cols: list,
                 rank_name: str = "rank", size_name: str | None = None) -> DataFrame:
    """0-based ``row_number() - 1`` within each group, skew-proof.

    Equivalent to ``row_number() over (partition by group order by order_cols)``
    but the sort is global, so a hot group is spread over many tasks. Group
    starts come from a per-group aggregate joined back on the group key; AQE
    broadcasts that side when it is measured small and splits skewed partitions
    otherwise. ``size_name`` also returns the group size.
    """
    ranked = with_ordinal(df, [*group_cols, *order_cols], "_tw_ord")
    aliases = {g: f"_tw_g{i}" for i, g in enumerate(group_cols)}
    starts = (ranked.groupBy(*group_cols)
              .agg(F.min("_tw_ord").alias("_tw_start"), F.count(F.lit(1)).alias("_tw_gn"))
              .select(*[F.col(g).alias(a) for g, a in aliases.items()], "_tw_start", "_tw_gn"))
    cond = reduce(lambda a, b: a & b,
                  [ranked[g].eqNullSafe(starts[a]) for g, a in aliases.items()])
    out = ranked.join(starts, cond).withColumn(
        rank_name, (F.col("_tw_ord") - F.col("_tw_start")).cast("bigint"))
    if size_name:
        out = out.withColumnRenamed("_tw_gn", size_name)
    return out.drop("_tw_ord", "_tw_start", "_tw_gn", *aliases.values())


def with_running_weight(df: DataFrame, order_cols: list, weight: str,
                        name: str = "weight_before") -> DataFrame:
    """Add the sum of ``weight`` over all rows before this one in the global order.

    The weighted form of ``with_ordinal``: used on pre-aggregated
    (value, count) rows, so a rank lookup sorts distinct values, not raw rows.
    Within a partition the running sum is a window over that partition's rows
    (one sorted partition per window group, so no group exceeds a partition).
    """
    ordered = df.orderBy(*order_cols).checkpoint(eager=True)
    tagged = (ordered
              .withColumn("_tw_mid", F.monotonically_increasing_id())
              .withColumn("_tw_pid", F.shiftright("_tw_mid", _ROW_BITS)))
    totals = tagged.groupBy("_tw_pid").agg(F.sum(weight).alias("_tw_w"))
    before = Window.orderBy("_tw_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_tw_pid", F.coalesce(F.sum("_tw_w").over(before), F.lit(0)).alias("_tw_off"))
    inside = Window.partitionBy("_tw_pid").orderBy("_tw_mid").rowsBetween(
        Window.unboundedPreceding, -1)
    local = tagged.withColumn("_tw_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    out = local.join(F.broadcast(offsets), "_tw_pid")  # one row per partition
    return (out.withColumn(name, (F.col("_tw_off") + F.col("_tw_in")).cast("bigint"))
               .drop("_tw_mid", "_tw_pid", "_tw_off", "_tw_in"))
