"""Sinks: loads that survive a rerun, layouts for several keys, buckets, statistics, counts from the write."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabwise.operators import enrich
from tabwise.sources import writers


def test_a_load_is_appended_once(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    a, b = spark.range(5).withColumn("uf", F.lit("AM")), spark.range(5, 8).withColumn("uf", F.lit("SP"))
    assert writers.loads(spark, table) == []
    assert writers.append_once(a, table, "a", partition_by=["uf"])
    assert not writers.append_once(a, table, "a", partition_by=["uf"])
    assert writers.append_once(b, table, "b", partition_by=["uf"])
    got = spark.read.parquet(table)
    assert sorted(r.id for r in got.collect()) == list(range(8)) and set(got.columns) == {"id", "uf", "load"}
    assert {(r.load, r.uf) for r in got.collect()} == {("a", "AM"), ("b", "SP")}
    assert writers.loads(spark, table) == ["a", "b"]
    for bad in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            writers.append_once(a, table, bad)
    with pytest.raises(ValueError):
        writers.append_once(a.withColumn("load", F.lit(1)), table, "c")


def test_a_broken_load_leaves_nothing_and_can_be_run_again(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    df = spark.range(0, 40, numPartitions=4)
    breaks = df.withColumn("v", F.when(F.col("id") == 39, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        writers.append_once(breaks, table, "x")
    assert writers.loads(spark, table) == []
    assert writers.append_once(df.withColumn("v", F.col("id")), table, "x")
    assert spark.read.parquet(table).count() == 40


def test_of_two_drivers_one_publishes(spark, tmp_dir, monkeypatch):
    table = os.path.join(tmp_dir, "t")
    df = spark.range(3)

    class Late:
        """Writes like ``df``, but another driver publishes the load meanwhile."""
        sparkSession, columns = spark, df.columns

        @property
        def write(self):
            assert writers.append_once(df, table, "x")
            return df.write

    assert not writers.append_once(Late(), table, "x")
    assert spark.read.parquet(table).count() == 3
    assert os.listdir(os.path.join(table, "_staging")) == []


def test_fingerprints_follow_the_files(spark, tmp_dir):
    def put(name, text, when):
        path = os.path.join(tmp_dir, name)
        with open(path, "w") as fh:
            fh.write(text)
        os.utime(path, (when, when))

    put("a.csv", "1", 100)
    put("b.csv", "2", 100)
    first = writers.source_fingerprint(spark, tmp_dir)
    assert first == writers.source_fingerprint(spark, tmp_dir) and writers.source_fingerprint(spark, tmp_dir, "a*") != first
    put("b.csv", "3", 200)
    assert writers.source_fingerprint(spark, tmp_dir) != first
    writers.append_once(spark.range(1), os.path.join(tmp_dir, "t"), first)


def test_one_layout_skips_files_for_each_key(spark, tmp_dir):
    n = 4000
    df = spark.range(0, n, numPartitions=4).select(
        "id", F.concat(F.lit("n"), F.lpad((F.col("id") * 7919 % n).cast("string"), 5, "0")).alias("name"),
        F.when(F.col("id") % 50 != 0, (F.col("id") * 104729 % n) / 3).alias("score"), F.lit("hot").alias("same"))
    path = writers.clustered_write_multi(df, os.path.join(tmp_dir, "t"), ["id", "name", "score"], num_partitions=27)
    files = glob.glob(path + "/*.parquet")
    assert len(files) > 16 and spark.read.parquet(path).count() == n
    stats = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(4)}
            stats.append({k: (s.min, s.max) for k, s in columns.items() if s is not None and s.has_min_max})
    for key, value in (("id", 1234), ("name", "n02000"), ("score", 500.0)):
        hit = sum(key not in s or s[key][0] <= value <= s[key][1] for s in stats)
        assert hit <= len(stats) * 0.6, key  # three keys: about 27^(2/3) of 27 ranges hold a value
    assert spark.read.parquet(path).where("id = 1234").count() == 1
    # Equal keys, nulls and empty tables have a layout too.
    same = writers.clustered_write_multi(df, os.path.join(tmp_dir, "s"), ["same", "score"], num_partitions=4)
    assert spark.read.parquet(same).count() == n
    none = writers.clustered_write_multi(df.limit(0), os.path.join(tmp_dir, "e"), ["id"])
    assert spark.read.parquet(none).count() == 0


def test_bucketed_registry_is_not_shuffled(spark, tmp_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k) for k in (key, "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    registry = spark.range(0, 500).select(F.col("id").cast("string").alias("cnpj"), (F.col("id") * 2).alias("n"))
    registry = registry.unionByName(spark.createDataFrame([(None, 1)], "cnpj string, n long"))
    stored = writers.save_bucketed(registry, "registry_test", os.path.join(tmp_dir, "r"), "cnpj", 4, pad_width=14)
    keys = spark.range(490, 510).select(F.col("id").cast("string").alias("cnpj"))
    for k in before:
        spark.conf.set(k, "-1")
    try:
        out = enrich.lookup_join(keys, stored, "cnpj", pad_width=14, stored_padded=True)
        assert sorted((r.cnpj, r.n) for r in out.collect() if r.found) == [(f"{i:014}", 2 * i) for i in range(490, 500)]
        assert out.count() == 20
        plan = out._jdf.queryExecution().executedPlan().toString()
        initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
        assert "SortMergeJoin" in initial and initial.count("Exchange") == 1 and "Bucketed: true" in initial
        # The same registry as plain files is shuffled.
        plain = enrich.lookup_join(keys, registry, "cnpj", pad_width=14)
        assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE registry_test")


def test_statistics_choose_the_side_to_broadcast(spark, tmp_dir):
    conf = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "4000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    big = spark.range(0, 20_000).select("id", (F.col("id") % 1000).alias("k"), F.lit("padding " * 4).alias("pad"))
    names = spark.range(0, 1000).select(F.col("id").alias("k"), F.concat(F.lit("name "), F.col("id")).alias("name"))
    writers.save_table(big, "stats_big", os.path.join(tmp_dir, "big"))
    writers.save_table(names, "stats_names", os.path.join(tmp_dir, "names"))
    sql = "SELECT b.id, n.name FROM {big} b JOIN {names} n ON b.k = n.k WHERE n.name IN ('name 3', 'name 5')"
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stored = spark.sql(sql.format(big="stats_big", names="stats_names"))
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan  # by the estimated rows behind the filter
        for name, df in (("plain_big", "big"), ("plain_names", "names")):
            spark.read.parquet(os.path.join(tmp_dir, df)).createOrReplaceTempView(name)
        plain = spark.sql(sql.format(big="plain_big", names="plain_names"))
        assert "SortMergeJoin" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect())) and stored.count() == 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE stats_big")
        spark.sql("DROP TABLE stats_names")


def test_rows_are_counted_by_the_write(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 100, numPartitions=3).mapInArrow(count, "id long")
    meta = writers.write_with_metadata(df, os.path.join(tmp_dir, "t"), "01/02/2022")
    assert sorted(map(tuple, meta.collect())) == [("CNPJ", "01/02/2022"), ("cnpj_qtde", "100")]
    assert seen.value == 100  # one pass over the data
    assert dict(map(tuple, writers.write_with_metadata(df.limit(0), os.path.join(tmp_dir, "e"), "x").collect()))["cnpj_qtde"] == "0"
