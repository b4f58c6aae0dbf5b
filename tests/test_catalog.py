"""The query catalogue: smoke entry, plan shape, and the SQL oracle at sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tabwise.plans import catalog
from tabwise.plans.tables import TABLES

from conftest import SF_SMALL

FILE_QUERIES = {"unzip_lines", "labelled_files", "registry_load", "registry_layouts", "scan_quoted_newlines"}  # land raw files with Python in tasks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cnpj", "doc_id", "uf", "fonte", "n_chars", "descricao", "quality",
                          "toxic", "registro_n_chars", "found"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())


def test_filter_pushdown_and_pruning(spark):
    df = E.queries()["filter_eq_like"](spark, SF_SMALL)
    plan = plan_of(df)
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "EqualTo(p_type,PROMO)" in pushed[:pushed.index("]")]
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:int>" in plan
    from tabwise.operators import filters
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    keys = filters.prospect(docs, "lang", catalog.PROSPECT_STATE, "text", catalog.PROSPECT_KEYWORDS)
    assert "EqualTo(lang,en)" in plan_of(keys.select("doc_id"))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan_of(keys.select("doc_id"))


def test_filter_on_enriched_attribute_becomes_inner_join(spark):
    df = E.queries()["enrich_then_filter"](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in optimized and "LeftOuter" not in optimized


def test_no_python_in_non_file_plans(spark):
    for name, fn in catalog.queries().items():
        if name in FILE_QUERIES:
            continue
        plan = plan_of(fn(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)
