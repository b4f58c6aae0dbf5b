"""Order statistics by counting, histograms, margins, tables side by side, ties."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabwise.operators import clean, enrich, ordinal, profile, selection, summarize


def shapes(seed, n=3000):
    """Columns of doubles that are hard to part: heavy tails, few values, both signs, tiny and huge ones."""
    rng = random.Random(seed)
    return {
        "uniform": [rng.random() for _ in range(n)],
        "one": [7.25] * n,
        "few": [float(rng.randrange(4)) for _ in range(n)],
        "powers": [rng.choice([-1, 1]) * 2.0 ** rng.randrange(-1070, 1020) for _ in range(n)],
        "far": [rng.gauss(0, 1) for _ in range(n - 1)] + [1e308],
        "both_far": [rng.gauss(0, 1e-5) for _ in range(n - 2)] + [1.7e308, -1.7e308],
        "steps": [1.0 + i * 2.0**-52 for i in range(n)],
        "tiny": [5e-324 * rng.randrange(9) for _ in range(n)],
        "zeros": [0.0] * (n - 3) + [-1.0, 1e-300, 4.0],
        "missing": [None if rng.random() < 0.5 else float("nan") if rng.random() < 0.1 else rng.random() for _ in range(n)],
    }


@pytest.mark.parametrize("few,buckets", [(1, 4), (40, 64), (512, 4096)])
def test_selected_quantiles(spark, monkeypatch, few, buckets):
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    data = shapes(few, 300 if buckets == 4 else 3000)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(5)
    quantiles = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r.column: r for r in profile.describe(df, quantiles=quantiles).collect()}
    for c, values in data.items():
        present = sorted(v for v in values if v is not None and v == v)
        for q in quantiles:
            place = q * (len(present) - 1)
            low, high = present[int(np.floor(place))], present[int(np.ceil(place))]
            wanted = low if low == high else low + (high - low) * (place - np.floor(place))
            assert got[c]["q" + f"{q * 100:g}".replace(".", "_")] == wanted, (c, q)


def test_quantiles_among_infinite_values(spark):
    inf = float("inf")
    cells = {"a": [-inf, -inf, 1.0, 2.0, inf], "b": [inf] * 5, "c": [-inf, 0.0, None, None, None], "d": [None] * 5}
    df = spark.createDataFrame(list(zip(*cells.values())), "a double, b double, c double, d double")
    got = {r.column: r for r in profile.describe(df, quantiles=(0.0, 0.25, 0.5, 0.75, 1.0)).collect()}
    assert [got["a"][q] for q in ("q0", "q25", "q50", "q75", "q100")] == [-inf, -inf, 1.0, 2.0, inf]
    assert got["b"].q50 == inf and got["c"].q0 == -inf and got["c"].q100 == 0.0 and got["d"].q50 is None


def test_describe_neither_sorts_nor_shuffles_rows(spark, tmp_dir):
    df = spark.range(0, 200_000, numPartitions=4).select((F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    seen = []
    inside = selection._rows_in
    selection._rows_in = lambda *a: seen.append(1) or inside(*a)
    try:
        row = profile.describe(df).first()
    finally:
        selection._rows_in = inside
    assert len(seen) <= 2  # one round of counting, one that finishes
    values = sorted(i * 7919 % 100_003 for i in range(200_000))
    assert row.q50 == (values[99_999] + values[100_000]) / 2
    assert profile.describe(df.limit(0)).first()["count"] == 0


@pytest.mark.parametrize("bins", [1, 7, 10, 100])
def test_histogram_bins_by_arithmetic(spark, bins):
    rng = random.Random(bins)
    columns = {"grid": [i / 10 for i in range(-50, 51)] * 5, "wide": [rng.choice([1e-9, 1.0, 1e9]) * rng.random() for _ in range(505)],
               "large": [1e300 * rng.random() for _ in range(505)], "same": [3.0] * 505}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(3)
    got = profile.histogram(df, list(columns), bins).collect()
    for c, values in columns.items():
        low, high = min(values), max(values)
        low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
        step = (high - low) / bins
        wanted = [0] * bins
        for v in values:
            wanted[sum(v >= k * step + low for k in range(1, bins))] += 1
        assert [r["count"] for r in sorted((r for r in got if r.column == c), key=lambda r: r.bin)] == wanted


@pytest.mark.parametrize("low", [None, 60])
def test_margins_equal_those_of_the_pivot(spark, low):
    rng = random.Random(9)
    rows = [(rng.choice(["p1", "p2", "p.3", None]), rng.choice(["g1", "g 2", "total", None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "platform string, genre string").repartition(4)
    old = summarize.add_margins(summarize.crosstab(df, "platform", "genre"), "platform", "Sum", low)
    for values in (None, ["g 2", "g1", "total"]):
        new = summarize.crosstab_margins(df, "platform", "genre", values, "Sum", low)
        assert sorted(new.columns) == sorted(old.columns)
        assert sorted(map(tuple, new.select(old.columns).collect()), key=repr) == sorted(map(tuple, old.collect()), key=repr)


def test_margins_need_three_shuffles(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")] * 50, "r string, c string").repartition(4)
    given = summarize.crosstab_margins(df, "r", "c", ["x", "y"])
    given.collect()
    plan = given._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    # Counts, pivot, totals row; the second reading of the pivot reuses its shuffle. One more deals the test's rows.
    assert final.count("+- Exchange ") == 4 and "ReusedExchange" in final
    assert summarize.crosstab_margins(df.limit(0), "r", "c").collect()[0].Total is None
    numbers = spark.createDataFrame([(1, True), (1, False), (2, True)], "r int, c boolean")
    assert set(map(tuple, summarize.crosstab_margins(numbers, "r", "c").select("r", "true", "Total").collect())) == {
        ("1", 1, 2), ("2", 1, 1), ("total", 2, 3)}


def test_bind_columns_aligns_labels(spark):
    a = spark.createDataFrame([("x", 1), ("y", None), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("y", "b"), ("z", "c")], "k string, v string")
    c = spark.createDataFrame([("x", [1.5]), (None, None)], "k string, `odd.name` array<double>")
    out = enrich.bind_columns({"a": a, "b": b, "c": c}, "k")
    assert out.columns == ["k", "a_v", "b_v", "odd.name"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("x", 1, None, [1.5]), ("y", None, "b", None), ("z", None, "c", None), (None, 3, None, None)], key=repr)
    assert enrich.bind_columns({"a": a, "only": b.select("k")}, "k").count() == 4
    assert enrich.bind_columns({"a": a.limit(0), "b": b.limit(0)}, "k").collect() == []


def test_bind_columns_shuffles_once_and_says_what_repeats(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 5), (None, 4)], "k string, v int")
    b = spark.createDataFrame([("x", "b")], "k string, w string")
    with pytest.raises(PySparkException, match="a repeats the label"):
        enrich.bind_columns({"a": a, "b": b}, "k").collect()
    out = enrich.bind_columns({"a": a, "b": b, "again": b.withColumnRenamed("w", "x")}, "k", repeated="smallest")
    assert set(map(tuple, out.collect())) == {("x", 1, "b", "b"), (None, 4, None, None)}
    assert out._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan[plan.index("Final Plan"):plan.index("Initial Plan")].count("Exchange ") == 1
    with pytest.raises(ValueError):
        enrich.bind_columns({"a": a}, "k", repeated="any")


def test_found_or_key_only_checks_names_and_pads(spark):
    keys = spark.createDataFrame([("7", "AM"), ("8", "SP")], "cnpj string, uf string")
    with pytest.raises(ValueError, match="uf"):
        enrich.found_or_key_only(keys, keys, "cnpj")
    registry = spark.createDataFrame([("0007", 1), ("07", 2)], "cnpj string, n int")
    got = enrich.found_or_key_only(keys, registry, "cnpj", pad_width=4, one_per_key=True)
    assert got.columns == ["cnpj", "uf", "n"]
    assert sorted(map(tuple, got.collect()), key=repr) == [("0007", "AM", 1), ("0008", "SP", None)]


def test_ties_stand_in_one_order_however_rows_are_dealt(spark):
    rows = [(1, c, {"m": i}) for i, c in enumerate("abcdefgh")]
    df = spark.createDataFrame(rows, "k int, c string, m map<string,int>")
    seen = {tuple(clean.cell_at(df.repartition(n), ["k"], i, "c").first().c for i in (0, 3, 7)) for n in (1, 2, 3, 5)}
    assert len(seen) == 1
    assert sorted(r.o for r in ordinal.with_ordinal(df.repartition(3), ["k"], "o").collect()) == list(range(8))
