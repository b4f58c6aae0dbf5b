"""Table profiling: missing values, numeric summary, histograms, column info.

Each profile reads the table once with one wide aggregate (partial + final, so
the work is spread over all tasks) and turns the single result row into one row
per column. Exact quartiles come from rounds of counting, not from a per-column buffer of
all values in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.operators.selection import Range, select_ranks
from tabwise.schemas import is_numeric


def numeric_column_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def numeric_columns(df: DataFrame) -> DataFrame:
    """Only the integer and floating-point columns (``select_dtypes``)."""
    return df.select(*numeric_column_names(df))


def column_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Contiguous columns from ``start`` to ``end``, both included (label slice)."""
    cols = df.columns
    i = cols.index(start) if start else 0
    j = cols.index(end) if end else len(cols) - 1
    if j < i:
        return df.select()
    return df.select(*cols[i:j + 1])


def _present(df: DataFrame, c: str):
    """The value, with NaN read as missing for floating-point columns."""
    dtype = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def _rows(structs: list) -> DataFrame:
    return F.inline(F.array(*structs))


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column: missing count and percent of rows (null without rows), fewest missing first."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_tw_rows"),
                  *[F.count_if(_present(df, c).isNull()).alias(f"_tw_m{i}")
                    for i, c in enumerate(cols)])
    long = wide.select(_rows([
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.col(f"_tw_m{i}").alias("missing_count"),
                 F.try_divide(F.lit(100.0) * F.col(f"_tw_m{i}"), F.col("_tw_rows")).alias("missing_pct"))
        for i, c in enumerate(cols)]))
    return long.orderBy("missing_count", "position")


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, type and non-null count, plus table shape."""
    cols = df.columns
    n_cols = len(cols)
    wide = df.agg(F.count(F.lit(1)).alias("_tw_rows"),
                  *[F.count(F.col(c)).alias(f"_tw_n{i}") for i, c in enumerate(cols)])
    return wide.select(_rows([
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                 F.col(f"_tw_n{i}").alias("non_null"),
                 F.col("_tw_rows").alias("n_rows"), F.lit(n_cols).alias("n_columns"))
        for i, c in enumerate(cols)]))


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(_tw_cid, value) rows of the present numeric values; the column is keyed by
    its position (an int hashes and sorts faster than the name)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_tw_cid"), _present(df, c).cast("double").alias("value"))
        for i, c in enumerate(cols)])).alias("_tw_s")).select("_tw_s.*")
    return long.where(F.col("value").isNotNull())


def describe(df: DataFrame, columns: list[str] | None = None,
             quantiles: tuple = (0.25, 0.5, 0.75), exact: bool = True,
             accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per column.

    ``exact`` quartiles interpolate linearly between ranked values, which are found
    by rounds of counting (``selection``): a few scans of the columns, no sort and no
    shuffle of rows. The report is then a small local table. ``exact=False`` uses
    ``percentile_approx`` (bounded memory per column, rank error at most
    1/``accuracy``, returns data values, no interpolation) and stays lazy.
    """
    cols = columns or numeric_column_names(df)
    values = [_present(df, c).cast("double") for c in cols]
    wide = df.agg(*[e for i, v in enumerate(values) for e in (
        F.count(v).alias(f"_tw_c{i}"), F.avg(v).alias(f"_tw_a{i}"), F.stddev_samp(v).alias(f"_tw_s{i}"),
        F.min(v).alias(f"_tw_lo{i}"), F.max(v).alias(f"_tw_hi{i}"))])
    moments = wide.select(_rows([
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.col(f"_tw_c{i}").alias("count"), F.col(f"_tw_a{i}").alias("mean"),
                 F.col(f"_tw_s{i}").alias("std"), F.col(f"_tw_lo{i}").alias("min"),
                 F.col(f"_tw_hi{i}").alias("max"))
        for i, c in enumerate(cols)]))
    qnames = [_qname(q) for q in quantiles]
    if not exact:
        qs = approx_quantiles(_long_values(df, cols), "_tw_cid", "value", quantiles, accuracy)
        # Both sides hold one row per column.
        out = moments.join(qs, moments["position"] == qs["_tw_cid"], "left")
        return out.select("column", "count", "mean", "std", "min", *qnames, "max", "position")
    rows = moments.collect()  # one row per column
    found = column_quantiles(df, cols, quantiles, {r.position: (r["min"], r["max"], r["count"]) for r in rows})
    schema = T.StructType([*moments.schema.fields, *[T.StructField(q, T.DoubleType()) for q in qnames]])
    out = df.sparkSession.createDataFrame([(*r, *found[r.position]) for r in rows], schema)
    return out.select("column", "count", "mean", "std", "min", *qnames, "max", "position")


def column_quantiles(df: DataFrame, cols: list[str], quantiles: tuple,
                     spans: dict[int, tuple]) -> dict[int, list[float | None]]:
    """Per column position its exact quantiles, interpolated linearly; null without values.

    ``spans`` holds smallest, largest and number of the present values, infinite ones included.
    """
    values, infinite, ranges, wanted = [_present(df, c).cast("double") for c in cols], {}, [], {}
    endless = [i for i, (low, high, n) in spans.items() if n and (math.isinf(low) or math.isinf(high))]
    if endless:  # ranks are counted among the finite values, between the infinite ones
        finite = {i: F.when(F.abs(values[i]) < float("inf"), values[i]) for i in endless}
        row = df.agg(*[e for i, v in finite.items() for e in (
            F.count_if(values[i] == float("-inf")).alias(f"below{i}"), F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}"))]).first()
        infinite = {i: row[f"below{i}"] for i in endless}
        values = [finite.get(i, v) for i, v in enumerate(values)]
    for i, (low, high, n) in spans.items():
        if n:
            if i in infinite:
                low, high, inside = row[f"low{i}"], row[f"high{i}"], row[f"n{i}"]
            else:
                inside = n
            if inside:
                ranges.append(Range(i, low, high, 0, inside))
            wanted[i] = {k for q in quantiles for k in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))}
    inside = {r.column: r.inside for r in ranges}
    ranks = [(i, k - infinite.get(i, 0)) for i, found in wanted.items() for k in found
             if 0 <= k - infinite.get(i, 0) < inside.get(i, 0)]
    known = select_ranks(df, values, ranges, ranks)

    def at(i: int, k: int) -> float:
        k -= infinite.get(i, 0)
        return known[i, k] if (i, k) in known else float("-inf") if k < 0 else float("inf")

    def quantile(i: int, n: int, q: float) -> float:
        place = q * (n - 1)
        low, high = at(i, math.floor(place)), at(i, math.ceil(place))
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {i: [quantile(i, n, float(q)) if n else None for q in quantiles] for i, (_, _, n) in spans.items()}


def _qname(q: float) -> str:
    return "q" + f"{q * 100:g}".replace(".", "_")


def exact_quantiles(long: DataFrame, group: str, value: str,
                    quantiles: tuple = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles with linear interpolation, per group.

    Values are first collapsed to (group, value, count) (map-side partial
    aggregation) and sorted globally, once; each row covers the ranks
    [before, before + count). The weight of every (group, partition) is a small
    table, one row per sorted partition and group: it tells each group's size and
    which partitions hold a needed rank. Only those are ranked row by row, and only
    rows covering a needed rank survive, so the final aggregate is tiny.
    """
    counted = long.groupBy(group, value).agg(F.count(F.lit(1)).alias("_tw_w"))
    ordered = counted.orderBy(group, value).checkpoint(eager=True)
    tagged = ordered.withColumn("_tw_pid", F.spark_partition_id())
    totals = tagged.groupBy(group, "_tw_pid").agg(F.sum("_tw_w").alias("_tw_pw"))
    along = Window.partitionBy(group).orderBy("_tw_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = (totals.withColumn("_tw_before", F.coalesce(F.sum("_tw_pw").over(along), F.lit(0)))
              .withColumn("_tw_n", F.sum("_tw_pw").over(Window.partitionBy(group))))
    ranks = [f(F.lit(float(q)) * (F.col("_tw_n") - 1)) for q in quantiles for f in (F.floor, F.ceil)]

    def any_in(low, high):
        return reduce(lambda a, b: a | b, [(low <= k) & (k <= high) for k in ranks])

    holding = totals.where(any_in(F.col("_tw_before"), F.col("_tw_before") + F.col("_tw_pw") - 1))
    inside = Window.partitionBy(group, "_tw_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    # At most two rows per group and quantile: a bounded broadcast.
    ranked = (tagged.join(F.broadcast(holding), [group, "_tw_pid"])
              .withColumn("_tw_lo", F.col("_tw_before") + F.coalesce(F.sum("_tw_w").over(inside), F.lit(0)))
              .withColumn("_tw_hi", F.col("_tw_lo") + F.col("_tw_w") - 1))
    pos = {q: F.lit(float(q)) * (F.col("_tw_n") - 1) for q in quantiles}

    def covers(idx):
        return (F.col("_tw_lo") <= idx) & (idx <= F.col("_tw_hi"))

    kept = ranked.where(any_in(F.col("_tw_lo"), F.col("_tw_hi")))
    aggs = []
    for i, q in enumerate(quantiles):
        aggs.append(F.max(F.when(covers(F.floor(pos[q])), F.col(value))).alias(f"_tw_l{i}"))
        aggs.append(F.max(F.when(covers(F.ceil(pos[q])), F.col(value))).alias(f"_tw_h{i}"))
    per = kept.groupBy(group).agg(F.max("_tw_n").alias("_tw_n"), *aggs)
    outs = []
    for i, q in enumerate(quantiles):
        p = F.lit(float(q)) * (F.col("_tw_n") - 1)
        lo, hi = F.col(f"_tw_l{i}"), F.col(f"_tw_h{i}")
        outs.append((lo + (hi - lo) * (p - F.floor(p))).alias(_qname(q)))
    return per.select(group, *outs)


def approx_quantiles(long: DataFrame, group: str, value: str,
                     quantiles: tuple = (0.25, 0.5, 0.75), accuracy: int = 10_000) -> DataFrame:
    """Approximate quantiles per group (Greenwald-Khanna sketches, merged per task)."""
    arr = F.percentile_approx(F.col(value), list(quantiles), accuracy).alias("_tw_q")
    per = long.groupBy(group).agg(arr)
    return per.select(group, *[F.col("_tw_q")[i].alias(_qname(q)) for i, q in enumerate(quantiles)])


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width histogram of each numeric column, empty bins kept as 0.

    Edges are ``min + i * (max - min) / bins`` with the last edge at max; a value
    falls in the bin whose left edge it reaches, the last bin is closed. A column
    whose min equals max is widened by 0.5 on both sides.
    """
    cols = columns or numeric_column_names(df)
    rng_wide = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.min(_present(df, c).cast("double")).alias(f"_tw_lo{i}"),
        F.max(_present(df, c).cast("double")).alias(f"_tw_hi{i}"))])
    ranges = rng_wide.select(_rows([
        F.struct(F.lit(i).alias("_tw_cid"), F.lit(c).alias("column"),
                 F.col(f"_tw_lo{i}").alias("_tw_mn"), F.col(f"_tw_hi{i}").alias("_tw_mx"))
        for i, c in enumerate(cols)]))
    def widened(low, high):
        same = high == low
        first, last = F.when(same, low - 0.5).otherwise(low), F.when(same, high + 0.5).otherwise(high)
        return first, last, (last - first) / F.lit(bins)

    first, last, step = widened(F.col("_tw_mn"), F.col("_tw_mx"))
    ranges = ranges.select("_tw_cid", "column", first.alias("bin_lo0"), last.alias("bin_hi0"), step.alias("_tw_step"))
    # The ranges of all columns are one row: a bounded broadcast, and one pass.
    cells = []
    for i, c in enumerate(cols):
        value = _present(df, c).cast("double")
        low, _, width = widened(F.col(f"_tw_lo{i}"), F.col(f"_tw_hi{i}"))
        # The edge is width * k + low: a division comes within one bin of it.
        place = F.greatest(F.lit(0.0), F.least(F.lit(bins - 1.0), F.try_divide(value - low, width)))
        near = F.floor(place).cast("int") + 1
        bin_no = (F.when((near > 1) & (value < (near - 1) * width + low), near - 1)
                  .when((near < bins) & (value >= near * width + low), near + 1).otherwise(near))
        cells.append(F.struct(F.lit(i).alias("_tw_cid"), F.when(value.isNotNull(), bin_no).alias("bin")))
    binned = df.crossJoin(F.broadcast(rng_wide)).select(F.inline(F.array(*cells))).where(F.col("bin").isNotNull())
    counts = binned.groupBy("_tw_cid", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = ranges.crossJoin(F.broadcast(
        df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))))
    out = grid.join(counts, ["_tw_cid", "bin"], "left").fillna(0, subset=["count"])
    return out.select(
        "column", "bin",
        ((F.col("bin") - 1) * F.col("_tw_step") + F.col("bin_lo0")).alias("bin_lo"),
        F.when(F.col("bin") == bins, F.col("bin_hi0"))
         .otherwise(F.col("bin") * F.col("_tw_step") + F.col("bin_lo0")).alias("bin_hi"),
        "count")
