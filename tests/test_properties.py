"""Property tests (hypothesis): padding, lookup join, histogram, ordinals."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabwise.functions import pad_key
from tabwise.operators import enrich, ordinal, profile

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789", min_size=1, max_size=20)),
                min_size=1, max_size=30))
def test_pad_is_idempotent_and_never_shortens(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    once = [r[0] for r in df.select(pad_key("k")).collect()]
    twice = [r[0] for r in spark.createDataFrame([(k,) for k in once], "k string")
             .select(pad_key("k")).collect()]
    assert once == twice
    for k, p in zip(keys, once):
        assert (p is None) == (k is None)
        if k is not None:
            assert len(p) == max(14, len(k)) and p.endswith(k)


@SETTINGS
@given(st.lists(st.integers(0, 20), max_size=40), st.sets(st.integers(0, 20), max_size=15))
def test_left_join_keeps_key_count(spark, keys, registry_keys):
    k = spark.createDataFrame([(x,) for x in keys], "id int")
    r = spark.createDataFrame([(x, x * 2) for x in registry_keys], "id int, v int")
    out = enrich.lookup_join(k, r, "id").collect()
    assert len(out) == len(keys)
    assert sum(1 for row in out if row.found) == sum(1 for x in keys if x in registry_keys)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1,
                max_size=60))
def test_histogram_counts_sum_to_present(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = sum(1 for v in values if v is not None)
    h = profile.histogram(df, ["v"], 10).collect()
    if present == 0:
        assert all(r["count"] == 0 for r in h)
    else:
        assert len(h) == 10 and sum(r["count"] for r in h) == present


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 1000)), max_size=50))
def test_grouped_rank_is_a_permutation_per_group(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int") if rows else spark.createDataFrame([], "g string, v int")
    out = ordinal.grouped_rank(df, ["g"], ["v"], "rk", "n").collect()
    for g in {r.g for r in out}:
        ranks = sorted(r.rk for r in out if r.g == g)
        assert ranks == list(range(len(ranks)))
        assert all(r.n == len(ranks) for r in out if r.g == g)
