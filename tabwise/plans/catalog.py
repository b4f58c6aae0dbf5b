"""Query catalogue: every operator key as a plan over the driver tables, with the
equivalent SQL (DuckDB dialect) used as the correctness oracle.

Doubles that come out of arithmetic or aggregation are rounded with
``round_half_up`` (plain IEEE operations), written identically in the SQL, so
both engines produce the same bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.functions import text as TX
from tabwise.functions import convert as CV
from tabwise.functions.arrays import rescale
from tabwise.functions.formats import fmt_decimals, fmt_int, fmt_percent, round_half_up
from tabwise.functions.json import json_field, pretty_json
from tabwise.operators import clean, enrich, filters, prepare, profile, summarize
from tabwise.plans import fixtures
from tabwise.plans.tables import load
from tabwise.schemas import (CODE_TABLE_COLUMNS, CODE_TABLE_SUFFIXES, COMPANY_COLUMNS, KEY_WIDTH,
                             LARGE_TABLE_SUFFIXES, PARTNER_COLUMNS, SHEET_COLUMNS, SHEET_COLUMNS_15, SHEET_SCHEMA,
                             SIMPLE_TAX_COLUMNS)
from tabwise.session import scratch_path
from tabwise.sources import readers, writers
from tabwise.streaming import stream_append_load

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r(x: str, d: int = 4) -> str:
    """SQL twin of ``round_half_up``."""
    v = f"CAST(({x}) AS DOUBLE)"
    return (f"(CASE WHEN abs({v}) * {10 ** d} >= CAST(9007199254740992 AS DOUBLE) THEN {v} "
            f"ELSE floor({v} * {10 ** d} + 0.5) / {10 ** d} END)")


def sql_pad(x: str, width: int = 14) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < {width} THEN lpad({s}, {width}, '0') ELSE {s} END)"


R = round_half_up
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
PART_SEL = ", ".join(PART_COLS)

# ---------------------------------------------------------------------------
# Flagship: prospecting. State filter + any-of name keywords, padded key, left
# join to the registry, fixed sheet layout with cleaned text.
# ---------------------------------------------------------------------------
PROSPECT_STATE = "en"
PROSPECT_KEYWORDS = ["LICENSE", "THORRE", "RETITION", "NTERTI"]
_kw_sql = " OR ".join(f"upper(d.text) LIKE '%{k}%'" for k in PROSPECT_KEYWORDS)


@query("prospect", f"""
SELECT {sql_pad('d.doc_id')} AS cnpj, d.doc_id AS doc_id, d.lang AS uf, d.source AS fonte,
       d.n_chars AS n_chars, translate(d.text, chr(10) || ';', '  ') AS descricao,
       l.quality AS quality, l.toxic AS toxic, l.quality AS registro_n_chars, l.doc_id IS NOT NULL AS found
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang = '{PROSPECT_STATE}' AND ({_kw_sql})
""")
def q_prospect(spark, sf):
    docs = load(spark, sf, "documents")
    keys = filters.prospect(docs, "lang", PROSPECT_STATE, "text", PROSPECT_KEYWORDS)
    joined = enrich.lookup_join(keys.withColumn("cnpj", F.col("doc_id").cast("string")), _registry(spark, sf),
                                "cnpj", record_col="rec", pad_width=KEY_WIDTH)
    return enrich.record_layout(joined, [
        ("cnpj", "cnpj", None, False),
        ("doc_id", "doc_id", None, False),
        ("uf", "lang", None, False),
        ("fonte", "source", None, False),
        ("n_chars", "n_chars", None, False),
        ("descricao", "text", None, True),
        ("quality", "rec.quality", None, False),
        ("toxic", "rec.toxic", None, False),
        ("registro_n_chars", "rec.n_chars", None, False),
        ("found", "found", None, False),
    ])


def _registry(spark, sf):
    """The landed registry: text keys without padding, and a column name that the keys have as well."""
    return load(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("cnpj"), "quality", "toxic", F.col("quality").alias("n_chars"))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
@query("filter_eq_like", f"""
SELECT {PART_SEL} FROM part WHERE p_type = 'PROMO' AND upper(p_name) LIKE '%WIDGET%'
""")
def q_filter_eq_like(spark, sf):
    part = load(spark, sf, "part")
    return filters.filter_contains(filters.filter_equals(part, "p_type", "PROMO"),
                                   "p_name", "WIDGET").select(*PART_COLS)


@query("filter_suffix", f"""
SELECT {PART_SEL} FROM part WHERE p_type = 'SMALL' AND upper(p_name) LIKE '%RING'
""")
def q_filter_suffix(spark, sf):
    part = load(spark, sf, "part")
    return filters.filter_suffix(filters.filter_equals(part, "p_type", "SMALL"),
                                 "p_name", "ring").select(*PART_COLS)


KEYWORDS = ["GEAR", "BOLT", "ANVIL", "ROD"]


@query("filter_keywords", f"""
SELECT {PART_SEL} FROM part
WHERE p_type = 'STANDARD' AND ({' OR '.join(f"upper(p_name) LIKE '%{k}%'" for k in KEYWORDS)})
""")
def q_filter_keywords(spark, sf):
    part = load(spark, sf, "part")
    return filters.prospect(part, "p_type", "STANDARD", "p_name", KEYWORDS).select(*PART_COLS)


@query("filter_code", f"""
SELECT {PART_SEL} FROM part WHERE CAST(p_size AS VARCHAR) = '11'
""")
def q_filter_code(spark, sf):
    return filters.filter_code(load(spark, sf, "part"), "p_size", "11").select(*PART_COLS)


CODE_SET = ["11", "23", "7", "not a code"]
_CODES_SQL = "(" + ", ".join(f"'{c}'" for c in CODE_SET) + ")"


@query("code_in_exact", f"""
SELECT {PART_SEL} FROM part WHERE CAST(p_size AS VARCHAR) IN {_CODES_SQL}
""")
def q_code_in_exact(spark, sf):
    return load(spark, sf, "part").where(TX.code_in("p_size", CODE_SET)).select(*PART_COLS)


@query("code_in_list", f"""
SELECT p_partkey, codes FROM (
  SELECT p_partkey, CAST(p_size AS VARCHAR) || ', ' || CAST(p_partkey % 30 AS VARCHAR) AS codes FROM part)
WHERE split_part(codes, ', ', 1) IN {_CODES_SQL} OR split_part(codes, ', ', 2) IN {_CODES_SQL}
""")
def q_code_in_list(spark, sf):
    listed = load(spark, sf, "part").select("p_partkey", F.concat_ws(
        ", ", F.col("p_size").cast("string"), (F.col("p_partkey") % 30).cast("string")).alias("codes"))
    return listed.where(TX.code_in("codes", CODE_SET, multi_valued=True))


@query("filter_rlike", f"""
SELECT {PART_SEL} FROM part WHERE regexp_matches(p_name, '(?i)^(red|blue) ')
""")
def q_filter_rlike(spark, sf):
    return filters.filter_rlike(load(spark, sf, "part"), "p_name", "^(RED|BLUE) ").select(*PART_COLS)


IN_SEGMENTS = ["BUILDING", "MACHINERY"]
IN_NATIONS = ["NATION_1", "NATION_5", "NATION_7", "NATION_12"]
_IN_SQL = """
SELECT c.c_custkey AS c_custkey, c.c_mktsegment AS c_mktsegment, n.n_name AS n_name
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND n.n_name IN ('NATION_1', 'NATION_5', 'NATION_7', 'NATION_12')
"""


@query("sql_in_filter", _IN_SQL.format(customer="customer", nation="nation"))
def q_sql_in_filter(spark, sf):
    load(spark, sf, "customer").createOrReplaceTempView("tw_customer")
    load(spark, sf, "nation").createOrReplaceTempView("tw_nation")
    return spark.sql(_IN_SQL.format(customer="tw_customer", nation="tw_nation"))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------
@query("select_reorder", """
SELECT o_orderstatus AS status, o_orderpriority AS priority, o_orderkey AS order_id,
       o_custkey AS customer_id, o_totalprice AS total_price
FROM orders
""")
def q_select_reorder(spark, sf):
    orders = load(spark, sf, "orders").drop("o_orderdate")
    renamed = orders.withColumnsRenamed({
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
        "o_totalprice": "total_price", "o_orderpriority": "priority"})
    return renamed.select("status", "priority", "order_id", "customer_id", "total_price")


@query("column_range", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def q_column_range(spark, sf):
    return profile.column_range(load(spark, sf, "lineitem"), "l_quantity", "l_tax")


@query("numeric_columns", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
""")
def q_numeric_columns(spark, sf):
    return profile.numeric_columns(load(spark, sf, "customer"))


# The record of the registry, as the driver tables can fill it, and its place in the sheet.
_SHEET_SOURCES = {
    "cnpj": ("rec.key", f"{sql_pad('c.c_custkey')}"),
    "razao_social": ("rec.name", "c.c_name"),
    "nome_fantasia": ("rec.name", "c.c_name"),
    "atividade_principal_codigo": ("rec.activity.code", "CAST(c.c_custkey % 97 AS VARCHAR)"),
    "atividade_principal_descricao": ("rec.activity.text", "lower(c.c_mktsegment)"),
    "situacao_cadastral": ("rec.segment", "c.c_mktsegment"),
    "capital_social": ("rec.balance", "c.c_acctbal"),
    "porte": ("rec.segment", "c.c_mktsegment"),
    "codigo_natureza_juridica": ("rec.nature_code", "CAST(c.c_nationkey AS BIGINT)"),
    "data_abertura": ("rec.opened", "CAST(1970 + c.c_custkey % 50 AS VARCHAR) || '-01-01'"),
    "bairro": ("rec.address.district", "'D' || CAST(c.c_custkey % 13 AS VARCHAR)"),
    "cep": ("rec.address.zip", "lpad(CAST(c.c_custkey AS VARCHAR), 8, '0')"),
    "municipio": ("rec.address.city", "'M' || CAST(c.c_nationkey AS VARCHAR)"),
    "uf": ("rec.address.state", "n.n_name"),
    "ddd_telefone_1": ("rec.phone", "CAST(c.c_custkey % 90 + 10 AS VARCHAR)"),
    "descricao_situacao_cadastral": ("rec.segment", "c.c_mktsegment"),
}


def _sheet_sql(columns: list[str]) -> str:
    return (f"SELECT {', '.join(f'{_SHEET_SOURCES[c][1]} AS {c}' for c in columns)} "
            "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")


def _records(spark, sf):
    cust = load(spark, sf, "customer")
    nation = load(spark, sf, "nation")
    key = F.col("c_custkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.struct(key.alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                 F.col("c_acctbal").cast("string").alias("balance"),
                 F.col("c_nationkey").cast("string").alias("nature_code"),
                 F.concat((key % 50 + 1970).cast("string"), F.lit("-01-01")).alias("opened"),
                 (key % 90 + 10).cast("string").alias("phone"),
                 F.struct((key % 97).cast("string").alias("code"),
                          F.lower("c_mktsegment").alias("text")).alias("activity"),
                 F.struct(F.concat(F.lit("D"), (key % 13).cast("string")).alias("district"),
                          F.lpad(key.cast("string"), 8, "0").alias("zip"),
                          F.concat(F.lit("M"), F.col("c_nationkey").cast("string")).alias("city"),
                          F.col("n_name").alias("state")).alias("address")).alias("rec"))


def _sheet(records, columns):
    spec = []
    for c in columns:
        source = TX.pad_key("rec.key") if c == "cnpj" else _SHEET_SOURCES[c][0]
        spec.append((c, source, SHEET_SCHEMA[c].dataType.simpleString(), c == "razao_social"))
    return enrich.record_layout(records, spec)


@query("record_layout", _sheet_sql(SHEET_COLUMNS))
def q_record_layout(spark, sf):
    return _sheet(_records(spark, sf), SHEET_COLUMNS)


@query("record_layout_15", _sheet_sql(SHEET_COLUMNS_15))
def q_record_layout_15(spark, sf):
    return _sheet(_records(spark, sf), SHEET_COLUMNS_15)


@query("composite_key", """
SELECT l_orderkey, l_linenumber,
       CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS cnpj
FROM lineitem
""")
def q_composite_key(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     TX.concat_key("l_orderkey", "l_partkey", "l_linenumber").alias("cnpj"))


# ---------------------------------------------------------------------------
# Enrichment (lookup join)
# ---------------------------------------------------------------------------
_ENRICH_SQL = f"""
SELECT {sql_pad('d.doc_id')} AS cnpj, d.doc_id AS doc_id, d.lang AS lang, d.source AS source,
       l.quality AS quality, l.toxic AS toxic, l.doc_id IS NOT NULL AS found
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def _enriched(spark, sf, registry=None, stored_padded=False):
    keys = load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("cnpj"), "doc_id", "lang", "source", "n_chars")
    out = enrich.lookup_join(keys, registry or _registry(spark, sf), "cnpj", record_col="rec", pad_width=KEY_WIDTH,
                             stored_padded=stored_padded)
    return out.select("cnpj", "doc_id", "lang", "source", F.col("rec.quality").alias("quality"),
                      F.col("rec.toxic").alias("toxic"), "found")


@query("enrich_lookup", _ENRICH_SQL)
def q_enrich_lookup(spark, sf):
    return _enriched(spark, sf)


@query("enrich_then_filter", _ENRICH_SQL + " WHERE l.quality = 1")
def q_enrich_then_filter(spark, sf):
    return _enriched(spark, sf).where(F.col("quality") == 1)


@query("union_missing", """
SELECT d.doc_id AS doc_id, d.lang AS lang, l.quality AS quality, l.toxic AS toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
UNION ALL
SELECT d.doc_id, d.lang, NULL, NULL FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def q_union_missing(spark, sf):
    keys = load(spark, sf, "documents").select("doc_id", "lang")
    registry = load(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return enrich.found_or_key_only(keys, registry, "doc_id").select(
        "doc_id", "lang", "quality", "toxic")


# ---------------------------------------------------------------------------
# Text expressions
# ---------------------------------------------------------------------------
@query("pad_key", f"""
SELECT o_orderkey, {sql_pad('o_orderkey')} AS cnpj FROM orders
""")
def q_pad_key(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", TX.pad_key("o_orderkey").alias("cnpj"))


@query("clean_text", """
SELECT page_id, translate(html, chr(10) || ';', '  ') AS html_clean FROM pages
""")
def q_clean_text(spark, sf):
    return load(spark, sf, "pages").select("page_id", TX.clean_text("html").alias("html_clean"))


@query("clean_text_observed", """
SELECT page_id, replace(html, ';', ' ') AS html_clean FROM pages
""")
def q_clean_text_observed(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", TX.clean_text_observed("html").alias("html_clean"))


@query("split_date_text", """
SELECT o_orderkey, datum, split_part(datum, ' ', 2) AS month, split_part(datum, ' ', 4) AS year
FROM (SELECT o_orderkey, strftime(o_orderdate, '%a %b %d, %Y %H:%M') AS datum FROM orders)
""")
def q_split_date_text(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "EEE MMM dd, yyyy HH:mm").alias("datum"))
    return o.select("o_orderkey", "datum", TX.split_nth("datum", " ", 1).alias("month"),
                    TX.split_nth("datum", " ", 3).alias("year"))


@query("split_last", """
SELECT c_custkey, location, split_part(location, ', ', -1) AS country
FROM (SELECT c.c_custkey, concat_ws(', ', c.c_name, c.c_mktsegment, n.n_name) AS location
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
""")
def q_split_last(spark, sf):
    c = load(spark, sf, "customer")
    n = load(spark, sf, "nation")
    loc = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.concat_ws(", ", "c_name", "c_mktsegment", "n_name").alias("location"))
    return loc.select("c_custkey", "location", TX.split_last("location", ", ").alias("country"))


# ---------------------------------------------------------------------------
# Conversion, rejects, imputation, mapping, point update
# ---------------------------------------------------------------------------
def _price_text():
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    body = F.concat((cents / 100000).cast("bigint").cast("string"), F.lit(","),
                    F.lpad(((cents / 100).cast("bigint") % 1000).cast("string"), 3, "0"),
                    F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("'"), body)).otherwise(body)


_PRICE_SQL = """
CASE WHEN o_orderpriority = '1-URGENT' THEN '''' ELSE '' END ||
CAST(c // 100000 AS VARCHAR) || ',' || lpad(CAST((c // 100) % 1000 AS VARCHAR), 3, '0') || '.' ||
lpad(CAST(c % 100 AS VARCHAR), 2, '0')
"""


@query("to_numeric", f"""
SELECT o_orderkey, cost_text, CAST(replace(replace(cost_text, '''', ''), ',', '') AS DOUBLE) AS cost
FROM (SELECT o_orderkey, {_PRICE_SQL} AS cost_text
      FROM (SELECT o_orderkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders))
""")
def q_to_numeric(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", _price_text().alias("cost_text"))
    return clean.to_numeric(o.withColumn("cost", F.col("cost_text")), "cost", strip="',")


@query("cast_rejects", """
SELECT event_id, event_type, value
FROM (SELECT *, CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) || 'x'
                     ELSE CAST(value AS VARCHAR) END AS value_text FROM events)
WHERE value_text IS NOT NULL AND try_cast(value_text AS DOUBLE) IS NULL
""")
def q_cast_rejects(spark, sf):
    ev = load(spark, sf, "events")
    spoilt = ev.withColumn("value_text", F.when(
        F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit("x")))
        .otherwise(F.col("value").cast("string")))
    return clean.cast_rejects(spoilt, "value_text").select("event_id", "event_type", "value")


@query("truncate_int", """
SELECT c_nationkey, CAST(trunc(avg(c_acctbal)) AS BIGINT) AS mean_balance
FROM customer GROUP BY c_nationkey
""")
def q_truncate_int(spark, sf):
    means = summarize.group_mean(load(spark, sf, "customer"), "c_nationkey", ["c_acctbal"], ordered=False)
    return means.select("c_nationkey", CV.truncate_int("c_acctbal").alias("mean_balance"))


@query("impute_mean", f"""
WITH m AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)
SELECT event_id, {r("coalesce(v, (SELECT avg(v) FROM m))")} AS value FROM m
""")
def q_impute_mean(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
        .cast("double").alias("value"))
    return clean.impute_mean(ev, ["value"]).select("event_id", R("value").alias("value"))


PRIORITY_NAMES = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}


@query("map_values", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
       WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS priority
FROM orders
""")
def q_map_values(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return clean.map_column(o, "priority", PRIORITY_NAMES)


_SITES = [*CV.LAUNCH_SITE_COUNTRIES, "Kazakhstan"]


@query("map_launch_sites", f"""
SELECT o_orderkey, CASE site {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in CV.LAUNCH_SITE_COUNTRIES.items())}
       ELSE site END AS country
FROM (SELECT o_orderkey, [{', '.join(f"'{x}'" for x in _SITES)}][CAST(o_orderkey % {len(_SITES)} AS INTEGER) + 1] AS site
      FROM orders)
""")
def q_map_launch_sites(spark, sf):
    site = F.element_at(F.array(*[F.lit(x) for x in _SITES]), (F.col("o_orderkey") % len(_SITES) + 1).cast("int"))
    o = load(spark, sf, "orders").select("o_orderkey", site.alias("country"))
    return clean.map_column(o, "country", CV.LAUNCH_SITE_COUNTRIES)


@query("cell_update", """
SELECT c_custkey, CASE WHEN c_custkey = 42 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_cell_update(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return clean.update_cell(c, "c_mktsegment", "c_custkey", 42, "AUTOMOBILE")


@query("cell_at", """
SELECT c_mktsegment FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1 OFFSET 42
""")
def q_cell_at(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return clean.cell_at(c, [F.desc("c_acctbal"), F.asc("c_custkey")], 42, "c_mktsegment")


# ---------------------------------------------------------------------------
# Aggregations, pivots, margins, shares, KPIs
# ---------------------------------------------------------------------------
@query("value_counts", """
SELECT o_orderstatus AS status, count(*) AS qty FROM orders
WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus
""")
def q_value_counts(spark, sf):
    return summarize.value_counts(load(spark, sf, "orders"), "o_orderstatus", "qty", "status")


@query("distinct_values", """
SELECT DISTINCT event_type FROM events
""")
def q_distinct_values(spark, sf):
    return summarize.distinct_values(load(spark, sf, "events"), "event_type")


@query("group_mean", f"""
SELECT c_nationkey, {r('avg(c_acctbal)')} AS c_acctbal FROM customer
WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey
""")
def q_group_mean(spark, sf):
    m = summarize.group_mean(load(spark, sf, "customer"), "c_nationkey", ["c_acctbal"], ordered=False)
    return m.select("c_nationkey", R("c_acctbal").alias("c_acctbal"))


LI_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("group_sum", f"""
SELECT l_returnflag, {', '.join(f"{r(f'sum({c})')} AS {c}" for c in LI_MEASURES)}
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""")
def q_group_sum(spark, sf):
    li = load(spark, sf, "lineitem")
    block = profile.column_range(li, "l_quantity", "l_tax").columns
    sums = summarize.group_sum(li, "l_returnflag", block)
    return sums.select("l_returnflag", *[R(c).alias(c) for c in block])


HAVING_MIN = 60


@query("having_top", f"""
SELECT c_nationkey AS nation, count(*) AS customers FROM customer
WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey HAVING count(*) > {HAVING_MIN}
""")
def q_having_top(spark, sf):
    vc = summarize.value_counts(load(spark, sf, "customer"), "c_nationkey", "customers", "nation")
    return vc.where(F.col("customers") > HAVING_MIN)


@query("top_k", f"""
SELECT n.n_name AS n_name, {r('avg(c.c_acctbal)')} AS mean_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY avg(c.c_acctbal) DESC, n.n_name LIMIT 10
""")
def q_top_k(spark, sf):
    c = load(spark, sf, "customer")
    n = load(spark, sf, "nation")
    joined = c.join(n, c.c_nationkey == n.n_nationkey).select("n_name", "c_acctbal")
    means = joined.groupBy("n_name").agg(F.avg("c_acctbal").alias("mean_balance"))
    top = summarize.top_k(means, "mean_balance", 10, tiebreak="n_name")
    return top.select("n_name", R("mean_balance").alias("mean_balance"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _count_cols(col: str, values: list[str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {col} = '{v}') AS \"{v}\"" for v in values)


@query("pivot_count", f"""
SELECT o_orderstatus, {_count_cols('o_orderpriority', PRIORITIES)}
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
GROUP BY o_orderstatus
""")
def q_pivot_count(spark, sf):
    return summarize.pivot_count(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("pair_counts", """
SELECT c_custkey % 1000 AS bucket, c_acctbal AS balance, count(*) AS customers
FROM customer WHERE c_acctbal IS NOT NULL AND c_custkey IS NOT NULL GROUP BY 1, 2
""")
def q_pair_counts(spark, sf):
    c = load(spark, sf, "customer").select((F.col("c_custkey") % 1000).alias("bucket"),
                                           F.col("c_acctbal").alias("balance"))
    return summarize.pair_counts(c, "bucket", "balance", "customers")


_CROSSTAB_SQL = f"""
SELECT p_brand, {_count_cols('p_type', P_TYPES)}
FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY p_brand
"""


@query("crosstab", _CROSSTAB_SQL)
def q_crosstab(spark, sf):
    return summarize.crosstab(load(spark, sf, "part"), "p_brand", "p_type")


MARGIN_MIN = 80
_TYPE_SUM = " + ".join(f'"{t}"' for t in P_TYPES)
_MARGINS_SQL = f"""
WITH ct AS ({_CROSSTAB_SQL}),
kept AS (SELECT *, {_TYPE_SUM} AS "Total" FROM ct WHERE {_TYPE_SUM} > {MARGIN_MIN})
SELECT p_brand, {', '.join(f'"{t}"' for t in P_TYPES)}, "Total" FROM kept
UNION ALL
SELECT 'total', {', '.join(f'CAST(sum("{t}") AS BIGINT)' for t in P_TYPES)},
       CAST(sum("Total") AS BIGINT) FROM kept
"""


@query("crosstab_margins", _MARGINS_SQL)
def q_crosstab_margins(spark, sf):
    return summarize.crosstab_margins(load(spark, sf, "part"), "p_brand", "p_type", min_total=MARGIN_MIN)


@query("matrix_range", f"""
WITH ct AS ({_CROSSTAB_SQL}),
kept AS (SELECT * FROM ct WHERE {_TYPE_SUM} > {MARGIN_MIN})
SELECT max(greatest({', '.join(f'"{t}"' for t in P_TYPES)})) AS max_value,
       min(least({', '.join(f'"{t}"' for t in P_TYPES)})) AS min_value FROM kept
""")
def q_matrix_range(spark, sf):
    ct = summarize.crosstab(load(spark, sf, "part"), "p_brand", "p_type")
    types = [c for c in ct.columns if c != "p_brand"]
    kept = summarize.row_totals(ct, "p_brand", "Total", min_total=MARGIN_MIN)
    return summarize.matrix_range(kept, profile.column_range(kept, types[0], types[-1]).columns)


SHARE_MEASURES = ["disc_amt", "net_amt", "tax_amt"]


def _shares(spark, sf, count_name=None):
    li = load(spark, sf, "lineitem").select(
        "l_returnflag",
        (F.col("l_extendedprice") * F.col("l_discount")).alias("disc_amt"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("net_amt"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tax_amt"),
        F.col("l_extendedprice").alias("gross"))
    return summarize.share_of_total(li, "l_returnflag", SHARE_MEASURES, "gross",
                                    count_name=count_name)


_SHARES_SQL = """
SELECT l_returnflag, sum(l_extendedprice * l_discount) AS disc_amt,
       sum(l_extendedprice * (1 - l_discount)) AS net_amt,
       sum(l_extendedprice * l_tax) AS tax_amt, sum(l_extendedprice) AS gross
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
"""


@query("share_of_total", f"""
SELECT l_returnflag, {', '.join(f'{r(m)} AS {m}' for m in SHARE_MEASURES + ['gross'])},
       {', '.join(f'{r(f"{m} / nullif(gross, 0)")} AS {m}_share' for m in SHARE_MEASURES)}
FROM ({_SHARES_SQL})
""")
def q_share_of_total(spark, sf):
    s = _shares(spark, sf)
    return s.select("l_returnflag", *[R(c).alias(c) for c in s.columns if c != "l_returnflag"])


@query("format_cells", f"""
SELECT l_returnflag,
       {', '.join(f"printf('%.1f', {r(m, 1)}) AS {m}_txt" for m in SHARE_MEASURES)},
       {', '.join(f"printf('%.2f%%', {r(f'({m} / nullif(gross, 0)) * 100', 2)}) AS {m}_pct" for m in SHARE_MEASURES)},
       printf('%d', n) AS lines_txt
FROM (SELECT l_returnflag, sum(l_extendedprice * l_discount) AS disc_amt,
             sum(l_extendedprice * (1 - l_discount)) AS net_amt,
             sum(l_extendedprice * l_tax) AS tax_amt, sum(l_extendedprice) AS gross,
             count(*) AS n
      FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag)
""")
def q_format_cells(spark, sf):
    s = _shares(spark, sf, count_name="n")
    return s.select("l_returnflag",
                    *[fmt_decimals(m, 1).alias(f"{m}_txt") for m in SHARE_MEASURES],
                    *[fmt_percent(f"{m}_share", 2).alias(f"{m}_pct") for m in SHARE_MEASURES],
                    fmt_int("n").alias("lines_txt"))


@query("kpi_ticket", f"""
SELECT o_orderstatus, {r('sum(o_totalprice)')} AS revenue, count(*) AS quantity,
       {r('sum(o_totalprice) / nullif(count(*), 0)')} AS avg_ticket
FROM orders GROUP BY o_orderstatus
""")
def q_kpi_ticket(spark, sf):
    k = summarize.kpis(load(spark, sf, "orders"), "o_totalprice", by=["o_orderstatus"])
    return k.select("o_orderstatus", R("revenue").alias("revenue"), "quantity",
                    R("avg_ticket").alias("avg_ticket"))


KPI_TEMPLATE = ("<p>Status %s</p><p>Revenue: R$%.2f</p><p>Items sold: %d</p>"
                "<p>Average ticket: R$%.2f</p>")


@query("kpi_report", f"""
SELECT o_orderstatus,
       printf('{KPI_TEMPLATE}', o_orderstatus, {r('sum(o_totalprice)', 2)}, count(*),
              {r('sum(o_totalprice) / nullif(count(*), 0)', 2)}) AS report
FROM orders GROUP BY o_orderstatus
""")
def q_kpi_report(spark, sf):
    k = summarize.kpis(load(spark, sf, "orders"), "o_totalprice", by=["o_orderstatus"])
    return k.select("o_orderstatus", F.format_string(
        KPI_TEMPLATE, F.col("o_orderstatus"), R("revenue", 2), F.col("quantity"),
        R("avg_ticket", 2)).alias("report"))


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------
def _events_with_gaps(spark, sf):
    """events with missing cells: value where the type is 'error', props for 'view'."""
    ev = load(spark, sf, "events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
         .cast("double").alias("value"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("props"))
         .cast("string").alias("props"))


_EV_GAPS = """(SELECT event_id, ts, user_id, event_type,
        CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
        CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props FROM events)"""
_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _missing_pred(c: str) -> str:
    return f"{c} IS NULL OR isnan({c})" if c == "value" else f"{c} IS NULL"


@query("missing_profile", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, "
    f"count(*) FILTER (WHERE {_missing_pred(c)}) AS missing_count, "
    f"{r(f'CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {_missing_pred(c)}) / count(*)')} "
    f"AS missing_pct FROM {_EV_GAPS}"
    for i, c in enumerate(_EV_COLS)))
def q_missing_profile(spark, sf):
    m = profile.missing_profile(_events_with_gaps(spark, sf))
    return m.select("position", "column", "missing_count", R("missing_pct").alias("missing_pct"))


LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(table: str, cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column, count({c}) AS count, {r(f'avg({x})')} AS mean, "
            f"{r(f'stddev_samp({x})')} AS std, min({x}) AS min, "
            f"{r(f'quantile_cont({x}, 0.25)')} AS q25, {r(f'quantile_cont({x}, 0.5)')} AS q50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS q75, max({x}) AS max, {i} AS position "
            f"FROM {table}")
    return " UNION ALL ".join(parts)


@query("describe", _describe_sql("lineitem", LI_NUMERIC))
def q_describe(spark, sf):
    d = profile.describe(load(spark, sf, "lineitem"), LI_NUMERIC)
    return d.select("column", "count", R("mean").alias("mean"), R("std").alias("std"), "min",
                    R("q25").alias("q25"), R("q50").alias("q50"), R("q75").alias("q75"),
                    "max", "position")


HIST_COLS = ["event_id", "user_id", "value"]
BINS = 10


def _hist_sql(table: str, cols: list[str], bins: int = BINS) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        edges = " + ".join(f"CAST(v >= {i} * step + lo AS INTEGER)" for i in range(1, bins))
        parts.append(f"""
SELECT '{c}' AS column, g.bin AS bin, {r('(g.bin - 1) * step + lo')} AS bin_lo,
       {r(f'CASE WHEN g.bin = {bins} THEN hi ELSE g.bin * step + lo END')} AS bin_hi,
       coalesce(k.cnt, 0) AS count
FROM (SELECT lo, hi, (hi - lo) / {bins} AS step FROM
        (SELECT CASE WHEN max({x}) = min({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo,
                CASE WHEN max({x}) = min({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS hi
         FROM {table})) s
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1})) g
LEFT JOIN (SELECT b, count(*) AS cnt FROM
             (SELECT 1 + {edges} AS b FROM
                (SELECT {x} AS v, lo, step FROM {table},
                   (SELECT lo, (hi - lo) / {bins} AS step FROM
                      (SELECT CASE WHEN max({x}) = min({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo,
                              CASE WHEN max({x}) = min({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS hi
                       FROM {table}))
                 WHERE {x} IS NOT NULL AND NOT isnan({x})))
           GROUP BY b) k ON k.b = g.bin""")
    return " UNION ALL ".join(parts)


@query("histogram", _hist_sql("events", HIST_COLS))
def q_histogram(spark, sf):
    h = profile.histogram(load(spark, sf, "events"), HIST_COLS, BINS)
    return h.select("column", "bin", R("bin_lo").alias("bin_lo"), R("bin_hi").alias("bin_hi"),
                    "count")


ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
               ("o_orderpriority", "string")]


@query("column_profile", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, "
    f"count(*) AS n_rows, {len(ORDER_TYPES)} AS n_columns FROM orders"
    for i, (c, t) in enumerate(ORDER_TYPES)))
def q_column_profile(spark, sf):
    return profile.column_profile(load(spark, sf, "orders"))


# ---------------------------------------------------------------------------
# JSON
# ---------------------------------------------------------------------------
@query("json_field", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_field(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", json_field("props", "k INT", "k").alias("k"))


@query("json_map_rows", """
SELECT e.event_id AS event_id, j.key AS key, CAST(j.value AS INTEGER) AS value
FROM events e LEFT JOIN LATERAL (SELECT * FROM json_each(e.props)) j ON true
""")
def q_json_map_rows(spark, sf):
    return readers.json_map_rows(load(spark, sf, "events"), "props", "int", keep=["event_id"])


@query("json_array_table", """
SELECT event_id, 'type' AS field, event_type AS text FROM events
UNION ALL
SELECT event_id, 'user' AS field, CAST(user_id AS VARCHAR) AS text FROM events
""")
def q_json_array_table(spark, sf):
    ev = load(spark, sf, "events")
    doc = ev.select("event_id", F.to_json(F.array(
        F.struct(F.lit("type").alias("field"), F.col("event_type").alias("text")),
        F.struct(F.lit("user").alias("field"), F.col("user_id").cast("string").alias("text")),
    )).alias("doc"))
    return readers.json_array_rows(doc, "doc", "field string, text string", keep=["event_id"])


@query("json_pretty", """
SELECT c_custkey,
       '{' || chr(10) || '  "c_custkey" : ' || CAST(c_custkey AS VARCHAR) || ',' || chr(10) ||
       '  "c_mktsegment" : "' || c_mktsegment || '",' || chr(10) ||
       '  "c_name" : "' || c_name || '",' || chr(10) ||
       '  "c_nationkey" : ' || CAST(c_nationkey AS VARCHAR) || chr(10) || '}' AS doc
FROM customer
""")
def q_json_pretty(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", pretty_json("c_name", "c_nationkey", "c_custkey",
                                             "c_mktsegment").alias("doc"))


# ---------------------------------------------------------------------------
# Dataset preparation
# ---------------------------------------------------------------------------
@query("class_split", """
SELECT vec_id, label, CASE WHEN rn < floor(CAST(0.3 AS DOUBLE) * n) THEN 'validation' ELSE 'training' END AS subset
FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM embeddings)
""")
def q_class_split(spark, sf):
    emb = load(spark, sf, "embeddings").select("vec_id", "label")
    return prepare.class_split(emb, "label", "vec_id", 0.3)


@query("one_hot", """
SELECT e.vec_id AS vec_id, c.pos AS position, CASE WHEN e.label = c.label THEN 1 ELSE 0 END AS hot
FROM embeddings e CROSS JOIN
     (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS pos
      FROM (SELECT DISTINCT label FROM embeddings)) c
""")
def q_one_hot(spark, sf):
    emb = load(spark, sf, "embeddings").select("vec_id", "label")
    oh = prepare.one_hot_labels(emb, "label", "one_hot")
    return oh.select("vec_id", F.posexplode("one_hot").alias("position", "hot"))


@query("array_rescale", f"""
SELECT vec_id, CAST(position AS INTEGER) AS position, {r('CAST(x AS DOUBLE) * (CAST(1 AS DOUBLE) / 255)', 8)} AS value
FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS position, unnest(embedding) AS x
      FROM embeddings)
""")
def q_array_rescale(spark, sf):
    emb = load(spark, sf, "embeddings")
    scaled = emb.select("vec_id", rescale("embedding", 1.0 / 255).alias("scaled"))
    return scaled.select("vec_id", F.posexplode("scaled").alias("position", "value")).select(
        "vec_id", "position", R("value", 8).alias("value"))


# ---------------------------------------------------------------------------
# Sources and sinks: land driver data as files, read them back
# ---------------------------------------------------------------------------
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_TEXT_COLS = [*LI_COLS, "complemento"]


@query("scan_csv_header", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def q_scan_csv_header(spark, sf):
    path = scratch_path(spark, "customer-csv")
    # The file has another column order than the schema asks for.
    turned = load(spark, sf, "customer").select("c_mktsegment", "c_acctbal", "c_name", "c_custkey", "c_nationkey")
    with fixtures.landing():
        turned.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return readers.read_csv_header(spark, path, CUSTOMER_SCHEMA)


@query("scan_csv_inferred", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS code, c_name, c_nationkey, c_acctbal,
       c_acctbal > 0 AS in_credit, DATE '2020-01-01' + CAST(c_custkey % 400 AS INTEGER) AS since,
       CASE WHEN c_nationkey > 10 THEN c_nationkey END AS sparse, c_custkey * 1000000007 AS large,
       CASE WHEN c_custkey % 2 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END AS mixed,
       'bigint,string,string,bigint,double,boolean,date,bigint,bigint,string' AS types
FROM customer
""")
def q_scan_csv_inferred(spark, sf):
    """Types found from all cells: codes with leading zeros and mixed columns stay text."""
    path = scratch_path(spark, "inferred-csv")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    made = load(spark, sf, "customer").select(
        key, F.lpad(key.cast("string"), 14, "0").alias("code"), "c_name", nation, "c_acctbal",
        (F.col("c_acctbal") > 0).alias("in_credit"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 400).cast("int")).alias("since"),
        F.when(nation > 10, nation).alias("sparse"), (key * 1000000007).alias("large"),
        F.when(key % 2 == 0, "n/a").otherwise(nation.cast("string")).alias("mixed"))
    with fixtures.landing():
        made.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    found = readers.read_csv_inferred(spark, path)
    types = ",".join(t for _, t in found.dtypes)
    return found.withColumn("c_nationkey", F.col("c_nationkey").cast("int")).withColumn("types", F.lit(types))


@query("scan_quoted_newlines", """
SELECT doc_id, source, text FROM documents
""")
def q_scan_quoted_newlines(spark, sf):
    """Whole texts as cells: newlines, quotes and separators in them."""
    path = scratch_path(spark, "quoted-csv")
    with fixtures.landing():
        (load(spark, sf, "documents").select("doc_id", "source", "text").write.option("header", True)
            .option("quote", '"').option("escape", '"').option("quoteAll", True).option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                           T.StructField("text", T.StringType())])
    return readers.read_csv_header(spark, path, schema, multi_line=True)


def _lineitem_extract(spark, sf):
    """lineitem as the raw extract: all text, plus an always-blank column."""
    li = load(spark, sf, "lineitem")
    return li.select(*LI_COLS, F.lit("").alias("complemento"))


_EXTRACT_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS cnpj,
       {', '.join(LI_COLS)}, '' AS complemento
FROM lineitem
"""


def _extract_result(df, like):
    """Every landed column, back in the type it had."""
    return df.select(TX.concat_key("l_orderkey", "l_partkey", "l_linenumber").alias("cnpj"),
                     *[CV.to_number(c, like.schema[c].dataType.simpleString()).alias(c) for c in LI_COLS],
                     "complemento")


@query("scan_delimited_text", _EXTRACT_SQL)
def q_scan_delimited_text(spark, sf):
    path = scratch_path(spark, "extract")
    fixtures.land_delimited(_lineitem_extract(spark, sf), path)
    landed = readers.read_delimited_text(spark, path, LI_TEXT_COLS, glob="*.csv")
    return _extract_result(landed, load(spark, sf, "lineitem"))


@query("unzip_lines", _EXTRACT_SQL)
def q_unzip_lines(spark, sf):
    path = scratch_path(spark, "archives")
    lines = fixtures.as_text(_lineitem_extract(spark, sf)).select(
        F.to_csv(F.struct(*LI_TEXT_COLS), {"sep": ";", "quote": '"', "escape": '"'})
        .alias("line"))
    fixtures.land_zip_archives(lines, path, ".ESTABELE")
    raw = readers.read_zip_lines(spark, path, member_suffix=".ESTABELE")
    return _extract_result(readers.parse_delimited_lines(raw, "line", LI_TEXT_COLS), load(spark, sf, "lineitem"))


@query("scan_rejects", """
SELECT CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_partkey AS VARCHAR) ||
       CASE l_linenumber WHEN 1 THEN '' ELSE ';3;4' END AS rejected
FROM lineitem WHERE l_linenumber IN (1, 2)
""")
def q_scan_rejects(spark, sf):
    """Rows with a cell too few or too many are set aside with their raw line."""
    path = scratch_path(spark, "ragged")
    li = load(spark, sf, "lineitem")
    tail = F.when(F.col("l_linenumber") == 1, "").when(F.col("l_linenumber") == 2, ";3;4").otherwise(";x")
    with fixtures.landing():
        li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(";"), F.col("l_partkey").cast("string"), tail)
                  ).write.text(path)
    landed = readers.read_delimited_text(spark, path, ["a", "b", "c"], ragged="keep")
    return landed.where(F.col("rejected").isNotNull()).select("rejected")


@query("registry_load", """
SELECT lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c.c_name AS razao_social,
       CAST(c.c_nationkey AS VARCHAR) AS natureza_juridica, n.n_name AS natureza_descricao,
       CAST(c.c_acctbal AS DOUBLE) AS capital_social, '' AS ente_federativo_responsavel
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_registry_load(spark, sf):
    """The 7-column company layout and a code table, landed and picked by their file suffixes."""
    path = scratch_path(spark, "registry")
    cust, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    companies = cust.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0"), "c_name", "c_nationkey", F.lit("49"), "c_acctbal",
        F.lit("05"), F.lit("")).toDF(*COMPANY_COLUMNS)
    fixtures.land_zip_archives(_csv_lines(companies), path + "/companies", LARGE_TABLE_SUFFIXES["empresas"])
    codes = nation.select("n_nationkey", "n_name").toDF(*CODE_TABLE_COLUMNS)
    fixtures.land_zip_archives(_csv_lines(codes), path + "/codes", CODE_TABLE_SUFFIXES["natureza_juridica"], archives=1)

    def landed(folder, suffix, columns):
        lines = readers.read_zip_lines(spark, path + folder, member_suffix=suffix)
        return readers.parse_delimited_lines(lines, "line", columns)

    table = landed("/companies", LARGE_TABLE_SUFFIXES["empresas"], COMPANY_COLUMNS)
    code = landed("/codes", CODE_TABLE_SUFFIXES["natureza_juridica"], CODE_TABLE_COLUMNS)
    return table.join(code, table.natureza_juridica == code.codigo).select(
        "cnpj_basico", "razao_social", "natureza_juridica", F.col("descricao").alias("natureza_descricao"),
        CV.to_number("capital_social_str").alias("capital_social"), "ente_federativo_responsavel")


def _csv_lines(df):
    return fixtures.as_text(df).select(F.to_csv(F.struct("*"), {
        "sep": ";", "quote": '"', "escape": '"'}).alias("line"))


def _simple_sql(n: str) -> str:
    return f"CASE WHEN {n} % 3 = 0 THEN 'S' ELSE 'N' END"


@query("registry_layouts", f"""
SELECT 'partner' AS layout, lpad(CAST(s.s_suppkey AS VARCHAR), 8, '0') AS cnpj_basico, s.s_name AS nome,
       CAST(s.s_nationkey AS VARCHAR) AS pais, n.n_name AS descricao, '' AS opcao, '' AS exclusao
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
UNION ALL
SELECT 'simples', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), '', '', '', {_simple_sql('c_custkey')}, '00000000' FROM customer
UNION ALL
SELECT k.kind, '', '', CAST(n_nationkey AS VARCHAR), n_name || ' ' || k.kind, '', ''
FROM nation, (VALUES {', '.join(f"('{k}')" for k in sorted(CODE_TABLE_SUFFIXES))}) AS k(kind)
""")
def q_registry_layouts(spark, sf):
    """Partners (11 columns), the simple tax regime (7) and all six code tables, picked by their suffixes."""
    path = scratch_path(spark, "registry-layouts")
    supplier, nation, customer = (load(spark, sf, t) for t in ("supplier", "nation", "customer"))
    partners = supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lit("2"), "s_name", F.lit("***000000**"), F.lit("49"),
        F.lit("20200131"), "s_nationkey", F.lit("***000000**"), F.lit(""), F.lit("00"), F.lit("4")).toDF(*PARTNER_COLUMNS)
    simple = customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.when(F.col("c_custkey") % 3 == 0, "S").otherwise("N"),
        F.lit("20180101"), F.lit("00000000"), F.lit("N"), F.lit("00000000"), F.lit("00000000")).toDF(*SIMPLE_TAX_COLUMNS)
    fixtures.land_zip_archives(_csv_lines(partners), path + "/large", LARGE_TABLE_SUFFIXES["socios"])
    # The published member ends in a part date, .SIMPLES.CSV.D20910.
    fixtures.land_zip_archives(_csv_lines(simple), path + "/simples", LARGE_TABLE_SUFFIXES["simples"] + ".D20910")
    for kind, suffix in CODE_TABLE_SUFFIXES.items():
        codes = nation.select("n_nationkey", F.concat("n_name", F.lit(f" {kind}"))).toDF(*CODE_TABLE_COLUMNS)
        fixtures.land_zip_archives(_csv_lines(codes), f"{path}/{kind}", suffix, archives=1)

    # All archives in one place: a member's name tells its table.
    parts = {k: readers.read_registry(spark, path + "/*", k) for k in ("socios", "simples", *CODE_TABLE_SUFFIXES)}
    text = lambda c: F.lit(c) if c == "" else F.col(c)

    def shaped(df, layout, name, country, meaning, option, left):
        return df.select(F.lit(layout).alias("layout"), text("" if layout in CODE_TABLE_SUFFIXES else "cnpj_basico").alias("cnpj_basico"),
                         text(name).alias("nome"), text(country).alias("pais"), text(meaning).alias("descricao"),
                         text(option).alias("opcao"), text(left).alias("exclusao"))

    country = parts["pais"].withColumn("descricao", F.regexp_replace("descricao", " pais$", ""))
    partner = parts["socios"].join(country, parts["socios"].pais == country.codigo)
    out = shaped(partner, "partner", "nome_socio", "pais", "descricao", "", "").unionByName(
        shaped(parts["simples"], "simples", "", "", "", "opcao_simples", "data_exclusao_simples"))
    for kind in CODE_TABLE_SUFFIXES:
        out = out.unionByName(shaped(parts[kind], kind, "", "codigo", "descricao", "", ""))
    return out


@query("json_landed", """
SELECT c.c_custkey AS c_custkey, c.c_name AS c_name, n.n_name AS state
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_json_landed(spark, sf):
    """JSON arrays from landed files; the state is two levels down."""
    path = scratch_path(spark, "json")
    cust, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    element = F.struct("c_custkey", "c_name", F.struct(F.struct(F.col("n_name").alias("name")).alias("state")).alias("place"))
    rows = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.floor(F.col("c_custkey") / 1000).alias("file"), element.alias("e"))
    # One array per file, as the remote service returns them: pages of a thousand keys.
    with fixtures.landing():
        (rows.groupBy("file").agg(F.to_json(F.collect_list("e")).alias("value"))
            .write.partitionBy("file").text(path))
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("place", T.StructType([T.StructField("state", T.StructType([
            T.StructField("name", T.StringType())]))]))])
    landed = readers.read_json_array(spark, path, schema)
    return landed.select("c_custkey", "c_name", F.col("place.state.name").alias("state"))


@query("code_table_load", """
SELECT CAST(p_partkey AS VARCHAR) AS codigo, p_name AS descricao FROM part
""")
def q_code_table_load(spark, sf):
    path = scratch_path(spark, "codes")
    codes = load(spark, sf, "part").select(F.col("p_partkey").alias(CODE_TABLE_COLUMNS[0]),
                                           F.col("p_name").alias(CODE_TABLE_COLUMNS[1]))
    fixtures.land_delimited(codes, path)
    return readers.read_code_table(spark, path)


@query("labelled_files", """
SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings
""")
def q_labelled_files(spark, sf):
    path = scratch_path(spark, "labelled")
    emb = load(spark, sf, "embeddings").select(
        "vec_id", "label", F.array_join(F.col("embedding").cast("array<string>"), ",").alias("body"))
    fixtures.land_labelled_files(emb, path, "label", "vec_id", "body")
    files = readers.read_labelled_files(spark, path, glob="*.txt")
    return files.select(
        F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint").alias("vec_id"), "label",
        F.size(F.split(F.col("content").cast("string"), ",")).alias("dims"))


@query("export_sheet", f"""
SELECT row_number() OVER (ORDER BY cnpj) - 1 AS index, * FROM ({_ENRICH_SQL})
""")
def q_export_sheet(spark, sf):
    path = scratch_path(spark, "sheet")
    enriched = _enriched(spark, sf)
    writers.export_sheet(enriched, path, ["cnpj"])
    schema = T.StructType([T.StructField("index", T.LongType())] + [
        T.StructField(f.name, f.dataType) for f in enriched.schema.fields])
    return readers.read_csv_header(spark, path, schema)


_APPEND_SQL = f"""
SELECT l_returnflag, l_linestatus, count(*) AS lines, {r('sum(l_quantity)')} AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""


def _append_result(df):
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), R(F.sum("l_quantity")).alias("qty"))


@query("append_load", _APPEND_SQL)
def q_append_load(spark, sf):
    path = scratch_path(spark, "append")
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus",
                                            "l_quantity")
    is_open = F.col("l_linestatus") == "O"
    writers.append_load(li.where(is_open), path)
    writers.append_load(li.where(~is_open | F.col("l_linestatus").isNull()), path)
    return _append_result(spark.read.parquet(path))


@query("append_rerun", _APPEND_SQL)
def q_append_rerun(spark, sf):
    """Two loads; the first breaks down before it is published and is run again, both are then repeated."""
    root = scratch_path(spark, "append-once")
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    is_open = F.col("l_linestatus") == "O"
    loads = {}
    for name, rows in (("open", li.where(is_open)), ("rest", li.where(~is_open | F.col("l_linestatus").isNull()))):
        fixtures.land_delimited(rows, f"{root}/{name}")
        loads[name] = (writers.source_fingerprint(spark, f"{root}/{name}"),
                       readers.read_delimited_text(spark, f"{root}/{name}", li.columns))
    table = f"{root}/table"
    fails = F.when(F.col("l_orderkey") != "", F.raise_error(F.lit("broken load"))).cast("string")
    load_id, rows = loads["open"]
    try:
        writers.append_once(rows.withColumn("l_quantity", fails), table, load_id)
    except Exception as e:  # noqa: BLE001
        if "broken load" not in str(e):
            raise
    for _ in range(2):
        for load_id, rows in loads.values():
            writers.append_once(rows, table, load_id)
    loaded = spark.read.parquet(table)
    return _append_result(loaded.withColumn("l_quantity", CV.to_number("l_quantity")))


@query("stream_append_load", _APPEND_SQL)
def q_stream_append_load(spark, sf):
    root = scratch_path(spark, "stream")
    cols = ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"]
    li = load(spark, sf, "lineitem").select(*cols)
    is_open = F.col("l_linestatus") == "O"
    src, target, ckpt = f"{root}/landing", f"{root}/table", f"{root}/_checkpoint"
    # First landing, first run; second landing into the same folder, second run
    # with the same checkpoint picks up only the new files.
    fixtures.land_delimited(li.where(is_open), src)
    stream_append_load(spark, src, cols, target, ckpt, glob="*.csv")
    fixtures.land_delimited(li.where(~is_open | F.col("l_linestatus").isNull()), src,
                            mode="append")
    stream_append_load(spark, src, cols, target, ckpt, glob="*.csv")
    loaded = spark.read.parquet(target)
    return _append_result(loaded.withColumn("l_quantity", CV.to_number("l_quantity")))


@query("write_guard", """
SELECT *, true AS second_write_refused FROM customer
""")
def q_write_guard(spark, sf):
    path = scratch_path(spark, "guarded")
    cust = load(spark, sf, "customer")
    writers.guarded_write(cust, path)
    try:
        writers.guarded_write(cust, path)
        refused = False
    except AnalysisException as e:
        refused = e.getCondition() == "PATH_ALREADY_EXISTS"
    return spark.read.parquet(path).withColumn("second_write_refused", F.lit(refused))


@query("compressed_write", """
SELECT * FROM lineitem
""")
def q_compressed_write(spark, sf):
    path = scratch_path(spark, "zstd")
    li = load(spark, sf, "lineitem")
    writers.compressed_write(li, path, codec="zstd")
    return spark.read.parquet(path)


CLUSTER_NATIONS = [1, 5, 7, 12]


@query("clustered_write", f"""
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
WHERE c_nationkey IN ({', '.join(map(str, CLUSTER_NATIONS))})
  AND c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def q_clustered_write(spark, sf):
    path = scratch_path(spark, "clustered")
    writers.clustered_write(load(spark, sf, "customer"), path, "c_custkey",
                            partition_by=["c_nationkey"])
    table = spark.read.schema(CUSTOMER_SCHEMA).parquet(path)
    return (table.where(F.col("c_nationkey").isin(CLUSTER_NATIONS)
                        & F.col("c_mktsegment").isin(IN_SEGMENTS))
                 .select("c_custkey", "c_nationkey", "c_mktsegment"))


@query("clustered_lookup", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey BETWEEN 100 AND 140
""")
def q_clustered_lookup(spark, sf):
    """A lookup by the key that the layout sorts by: statistics skip the other row groups."""
    path = scratch_path(spark, "clustered-key")
    writers.clustered_write(load(spark, sf, "customer"), path, "c_custkey")
    return spark.read.schema(CUSTOMER_SCHEMA).parquet(path).where(F.col("c_custkey").between(100, 140))


@query("clustered_multi", """
SELECT 'c_custkey' AS looked_up_by, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey BETWEEN 100 AND 140
UNION ALL SELECT 'c_name', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_name BETWEEN 'Customer#000000050' AND 'Customer#000000090'
UNION ALL SELECT 'c_acctbal', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_acctbal BETWEEN 100 AND 200
""")
def q_clustered_multi(spark, sf):
    """One layout, looked up by each of three keys."""
    path = scratch_path(spark, "clustered-multi")
    writers.clustered_write_multi(load(spark, sf, "customer"), path, ["c_custkey", "c_name", "c_acctbal"])
    table = spark.read.schema(CUSTOMER_SCHEMA).parquet(path)
    found = {"c_custkey": F.col("c_custkey").between(100, 140),
             "c_name": F.col("c_name").between("Customer#000000050", "Customer#000000090"),
             "c_acctbal": F.col("c_acctbal").between(100, 200)}
    parts = [table.where(p).withColumn("looked_up_by", F.lit(k)) for k, p in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("enrich_bucketed", _ENRICH_SQL)
def q_enrich_bucketed(spark, sf):
    """The registry saved once in buckets of its padded key; lookups shuffle their keys only."""
    path = scratch_path(spark, "registry-buckets")
    registry = writers.save_bucketed(_registry(spark, sf), f"registry_{path.split('/')[-2]}", path, "cnpj", 8, KEY_WIDTH)
    return _enriched(spark, sf, registry, stored_padded=True)


@query("sql_stored_tables", _IN_SQL.format(customer="customer", nation="nation"))
def q_sql_stored_tables(spark, sf):
    """The same SQL over catalogue tables with statistics."""
    path = scratch_path(spark, "stored")
    names = {t: f"{t}_{path.split('/')[-2]}" for t in ("customer", "nation")}
    for t, name in names.items():
        writers.save_table(load(spark, sf, t), name, f"{path}/{t}")
    return spark.sql(_IN_SQL.format(**names))


@query("bind_columns", """
WITH c AS (SELECT c_nationkey AS nation, count(*) AS n, sum(c_custkey) AS keys FROM customer WHERE c_nationkey > 3 GROUP BY 1
           UNION ALL SELECT NULL, count(*), sum(c_custkey) FROM customer WHERE c_nationkey <= 3),
     s AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier WHERE s_nationkey < 20 GROUP BY 1
           UNION ALL SELECT NULL, count(*) FROM supplier WHERE s_nationkey >= 20),
     l AS (SELECT nation FROM c UNION SELECT nation FROM s UNION SELECT n_nationkey FROM nation)
SELECT l.nation AS nation, c.n AS customers_n, CAST(c.keys AS BIGINT) AS keys, s.n AS suppliers_n, x.n_name AS n_name
FROM l LEFT JOIN c ON l.nation IS NOT DISTINCT FROM c.nation LEFT JOIN s ON l.nation IS NOT DISTINCT FROM s.nation
       LEFT JOIN nation x ON l.nation = x.n_nationkey
""")
def q_bind_columns(spark, sf):
    """Three tables side by side by nation; each lacks labels that others have, and null is a label."""
    cust, supp, nation = (load(spark, sf, t) for t in ("customer", "supplier", "nation"))
    key = F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("nation")
    customers = cust.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))
    key = F.when(F.col("s_nationkey") < 20, F.col("s_nationkey")).alias("nation")
    suppliers = supp.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    names = nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return enrich.bind_columns({"customers": customers, "suppliers": suppliers, "names": names}, "nation")


@query("describe_customer", _describe_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"]))
def q_describe_customer(spark, sf):
    d = profile.describe(load(spark, sf, "customer"))
    return d.select("column", "count", R("mean").alias("mean"), R("std").alias("std"), "min",
                    R("q25").alias("q25"), R("q50").alias("q50"), R("q75").alias("q75"),
                    "max", "position")


@query("dataset_metadata", """
SELECT 'reference_date' AS referencia, '21/11/2022' AS valor
UNION ALL SELECT 'row_count', CAST(count(*) AS VARCHAR) FROM orders
""")
def q_dataset_metadata(spark, sf):
    return writers.dataset_metadata(load(spark, sf, "orders"), "21/11/2022",
                                    date_key="reference_date", count_key="row_count")


@query("written_metadata", """
SELECT 'reference_date' AS referencia, '21/11/2022' AS valor
UNION ALL SELECT 'row_count', CAST(count(*) AS VARCHAR) FROM orders
""")
def q_written_metadata(spark, sf):
    """The rows are counted while the table is written."""
    return writers.write_with_metadata(load(spark, sf, "orders"), scratch_path(spark, "orders"), "21/11/2022",
                                       date_key="reference_date", count_key="row_count")
