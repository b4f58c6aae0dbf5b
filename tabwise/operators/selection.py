"""Exact order statistics by distributed selection: no sort, no shuffle of rows.

For every wanted rank there is a range of values that holds it and the number of
values below that range. A round divides each range into a fixed number of
buckets, counts every bucket with its smallest and largest value in one partial
aggregate, and goes on with the bucket the rank falls in. Buckets are of equal width;
where that hardly parted the values (a few far ones stretch the range), the next
round divides by the logarithm instead. A range with one distinct value is done,
one with few values is finished from these. What comes back from a round does not
grow with the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
#: Ranges of at most so many values are finished from the values themselves.
FEW = 512
#: A round that leaves more than this share of a range's values has hardly parted them.
_HARDLY = 1 / 16


@dataclass(frozen=True)
class Range:
    """Values of one column from low to high, both included: how many lie below, how many inside."""

    column: int
    low: float
    high: float
    below: int
    inside: int
    by_log: bool = False


def _signed_log(v: Column) -> Column:
    # ln of the smallest double is above -745, so that this grows with v on both sides of 0.
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 746))


def _python_log(v: float) -> float:
    return 0.0 if v == 0 else math.copysign(math.log(abs(v)) + 746, v)


def _bucket(v: Column, r: Range) -> Column:
    low, high, x = r.low, r.high, v
    if r.by_log and _python_log(r.low) < _python_log(r.high):
        low, high, x = _python_log(r.low), _python_log(r.high), _signed_log(v)
    width = high - low
    if math.isinf(width):  # halves, whose difference is finite
        low, width, x = low / 2, high / 2 - low / 2, x / 2
    place = F.floor((x - F.lit(low)) / F.lit(width) * BUCKETS)
    return F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), place)).cast("int")


def _rows_in(values: list[Column], ranges: list[Range], tag) -> Column:
    """array of (range number, value, tag) of a row's values that lie in a range."""
    cells = []
    for i, r in enumerate(ranges):
        v = values[r.column]
        cells.append(F.when(v.between(r.low, r.high), F.struct(
            F.lit(i).alias("r"), v.alias("value"), tag(v, r).alias("bucket"))))
    return F.filter(F.array(*cells), lambda x: x.isNotNull())


def select_ranks(df: DataFrame, values: list[Column], ranges: list[Range],
                 wanted: Iterable[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """The value at each wanted (column, 0-based rank) among the column's finite values.

    ``values`` are double columns without NaN, ``ranges`` hold per column its smallest
    and largest finite value and their number (``below`` 0). Null values don't count.
    """
    whole = {r.column: r for r in ranges}
    at = {(c, k): whole[c] for c, k in wanted}
    found: dict[tuple[int, int], float] = {}
    while True:
        for key, r in list(at.items()):
            if r.low == r.high:
                found[key] = r.low
                del at[key]
        if not at:
            return found
        few = sorted({r for r in at.values() if r.inside <= FEW}, key=lambda r: (r.column, r.low))
        more = sorted({r for r in at.values() if r.inside > FEW}, key=lambda r: (r.column, r.low))
        if few:
            inside = df.select(F.explode(_rows_in(values, few, lambda v, r: F.lit(0))).alias("x")).select("x.r", "x.value")
            # At most FEW values a range.
            held = {row.r: row.sorted for row in inside.groupBy("r").agg(F.sort_array(F.collect_list("value")).alias("sorted")).collect()}
            for key, r in list(at.items()):
                if r in few:
                    found[key] = held[few.index(r)][key[1] - r.below]
                    del at[key]
        if more:
            counted = (df.select(F.explode(_rows_in(values, more, _bucket)).alias("x")).groupBy("x.r", "x.bucket")
                       .agg(F.count(F.lit(1)).alias("n"), F.min("x.value").alias("low"), F.max("x.value").alias("high")))
            so_far = Window.partitionBy("r").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
            placed = counted.withColumn("below", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
            # Only the buckets that a rank falls in come back.
            ranks = {i: sorted({k - r.below for (c, k), own in at.items() if own == r}) for i, r in enumerate(more)}
            hit = F.lit(False)
            for i, offsets in ranks.items():
                inside = F.lit(False)
                for k in offsets:
                    inside = inside | ((F.col("below") <= k) & (F.lit(k) < F.col("below") + F.col("n")))
                hit = hit | ((F.col("r") == i) & inside)
            buckets = placed.where(hit).collect()
            for key, r in list(at.items()):
                if r in more:
                    i, k = more.index(r), key[1] - r.below
                    b = next(b for b in buckets if b.r == i and b.below <= k < b.below + b.n)
                    at[key] = Range(r.column, b.low, b.high, r.below + b.below, b.n,
                                    not r.by_log and b.n > _HARDLY * r.inside)
