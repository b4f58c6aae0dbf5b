"""Column expressions on tiny literal frames holding the edge rows."""

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from tabwise.functions import (
    cast_reject, clean_text, clean_text_observed, code_equals, concat_key, contains_any,
    ends_with_ci, fmt_decimals, fmt_int, fmt_percent, json_field, like_any, map_values,
    one_hot, pad_key, pretty_json, rescale, rlike_ci, round_half_up, set_cell,
    split_last, split_nth, strip_chars, to_number, truncate_int, try_number,
)


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_pad_key_never_truncates(spark):
    df = spark.createDataFrame([("191",), ("12345678901234",), ("1234567890123456",), (None,)], "k string")
    assert col_values(df, pad_key("k")) == [
        "00000000000191", "12345678901234", "1234567890123456", None]


def test_pad_key_numeric_and_idempotent(spark):
    df = spark.createDataFrame([(191,), (0,)], "k bigint")
    once = col_values(df, pad_key("k"))
    assert once == ["00000000000191", "00000000000000"]
    df2 = spark.createDataFrame([(v,) for v in once], "k string")
    assert col_values(df2, pad_key("k")) == once


def test_clean_text_variants(spark):
    df = spark.createDataFrame([("a;b\nc",), (None,)], "t string")
    assert col_values(df, clean_text("t")) == ["a b c", None]
    assert col_values(df, clean_text_observed("t")) == ["a b\nc", None]


def test_keyword_predicates(spark):
    df = spark.createDataFrame(
        [("Seguranca Ltda",), ("ACME SEGURANÇA",), ("vigilancia",), ("x_y",), (None,)], "n string")
    hits = df.where(contains_any("n", ["SEGURANCA", "VIGILANCIA"])).collect()
    assert sorted(r.n for r in hits) == ["Seguranca Ltda", "vigilancia"]  # accents not folded
    assert df.where(contains_any("n", ["_"])).count() == 1  # '_' is literal, not a wildcard
    assert df.where(ends_with_ci("n", "ltda")).count() == 1
    assert df.where(like_any("n", ["%ANCA%"])).count() == 1
    assert df.where(rlike_ci("n", "^vig")).count() == 1


def test_code_equals_across_types(spark):
    df = spark.createDataFrame([(6190601,), (123,)], "c bigint")
    assert df.where(code_equals("c", "6190601")).count() == 1
    df2 = spark.createDataFrame([("6190601",), ("abc",)], "c string")
    assert df2.where(code_equals("c", "6190601")).count() == 1


def test_split_helpers(spark):
    df = spark.createDataFrame([("Fri Aug 07, 2020 05:12 UTC",), ("short",), (None,)], "d string")
    assert col_values(df, split_nth("d", " ", 1)) == ["Aug", None, None]
    assert col_values(df, split_nth("d", " ", 3)) == ["2020", None, None]
    loc = spark.createDataFrame([("Site 1, Baikonur, Kazakhstan",), ("Yellow Sea",)], "l string")
    assert col_values(loc, split_last("l", ", ")) == ["Kazakhstan", "Yellow Sea"]
    dots = spark.createDataFrame([("a.b.c",)], "s string")
    assert col_values(dots, split_last("s", ".")) == ["c"]  # separator is literal


def test_concat_key_null_if_any_part_null(spark):
    df = spark.createDataFrame([("12345678", "0001", "95"), ("1", None, "2")], "a string, b string, c string")
    assert col_values(df, concat_key("a", "b", "c")) == ["12345678000195", None]


def test_numeric_conversion(spark):
    df = spark.createDataFrame([("5,000.0",), ("1'200",), ("abc",), (None,)], "t string")
    assert col_values(df, try_number(strip_chars("t", "',"))) == [5000.0, 1200.0, None, None]
    assert col_values(df, cast_reject("t")) == [True, True, True, False]
    with pytest.raises((NumberFormatException, SparkRuntimeException, Exception)):
        df.select(to_number("t")).collect()


def test_truncate_int_toward_zero(spark):
    df = spark.createDataFrame([(3.9,), (-3.9,)], "x double")
    assert col_values(df, truncate_int("x")) == [3, -3]


def test_map_values_keeps_unmapped(spark):
    df = spark.createDataFrame([("New Mexico",), ("Kazakhstan",), (None,)], "c string")
    out = col_values(df, map_values("c", {"New Mexico": "USA", "Yellow Sea": "China"}))
    assert out == ["USA", "Kazakhstan", None]


def test_set_cell(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert col_values(df, set_cell("v", "k", 2, "z")) == ["a", "z"]


def test_formats_and_rounding(spark):
    df = spark.createDataFrame([(0.12345, 12.25, 7)], "s double, x double, n long")
    row = df.select(fmt_percent("s"), fmt_decimals("x", 1), fmt_int("n"),
                    round_half_up(F.lit(1.005), 2)).first()
    assert row[0] == "12.35%"
    assert row[1] == "12.3"
    assert row[2] == "7"
    assert row[3] == 1.0  # the double nearest to 1.005 is below it


def test_rounding_keeps_large_infinite_and_missing_values(spark):
    values = [1e15, 2.3e16, -2.3e16, 9.2e14, float("inf"), float("-inf"), float("nan"), None, 0.5, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 4)).collect()]
    assert [repr(g) for g in got] == [repr(v) for v in values]
    assert [r[0] for r in df.select(fmt_decimals("x", 1)).collect()][6:8] == ["NaN", None]


def test_keys_that_landed_as_numbers(spark):
    df = spark.createDataFrame([(191.0, 19131243000197.0, 7, "A.B")], "a double, b double, c int, d string")
    got = df.select(*[pad_key(c) for c in "abcd"]).first()
    assert tuple(got) == ("00000000000191", "19131243000197", "00000000000007", "00000000000A.B")


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"USDBRL": {"bid": "5.10"}, "EURBRL": {"bid": "5.50"}}',)], "j string")
    assert col_values(df, json_field("j", "USDBRL struct<bid:string>", "USDBRL", "bid")) == ["5.10"]
    n = spark.createDataFrame([(1, "b")], "z int, a string")
    assert col_values(n, pretty_json("z", "a")) == ['{\n  "a" : "b",\n  "z" : 1\n}']
    deep = spark.createDataFrame([(None, ((2, None),))], "k string, s struct<t:struct<z:int,b:string>>")
    assert col_values(deep, pretty_json("s", "k", schema=deep.schema)) == [
        '{\n  "k" : null,\n  "s" : {\n    "t" : {\n      "b" : null,\n      "z" : 2\n    }\n  }\n}']


def test_array_helpers(spark):
    df = spark.createDataFrame([([255.0, 0.0], "b", ["a", "b", "c"])],
                               "v array<double>, l string, k array<string>")
    assert col_values(df, rescale("v"))[0] == [1.0, 0.0]
    assert col_values(df, one_hot(F.lit(1), F.lit(3)))[0] == [0, 1, 0]
    assert col_values(df, one_hot(F.lit(None).cast("int"), F.lit(2)))[0] == [0, 0]
    assert col_values(df, one_hot(F.lit(0), F.lit(0)))[0] == []


def test_code_in(spark):
    from tabwise.functions import code_in
    df = spark.createDataFrame([("4751201",), ("1111111,4752100",), ("9999999",), (None,)], "c string")
    codes = ["4751201", "4752100"]
    assert col_values(df, code_in("c", codes)) == [True, False, False, None]
    assert col_values(df, code_in("c", codes, multi_valued=True)) == [True, True, False, None]


def test_launch_site_preset(spark):
    from tabwise.functions.convert import LAUNCH_SITE_COUNTRIES
    df = spark.createDataFrame([("Yellow Sea",), ("Kazakhstan",)], "c string")
    assert col_values(df, map_values("c", LAUNCH_SITE_COUNTRIES)) == ["China", "Kazakhstan"]
