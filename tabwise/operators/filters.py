"""Row filters of the prospecting scripts: state, name keywords, codes.

Chained ``filter``/``where`` calls are merged by Catalyst into one predicate;
plain equality reaches the scan as a pushed filter, while ``upper(...)`` keeps
the keyword part above the scan (it must see the raw text).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tabwise.functions import text as T


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def filter_contains(df: DataFrame, column: str, keyword: str) -> DataFrame:
    """Case-blind ``upper(c) LIKE '%KW%'``."""
    return df.where(T.contains_any(column, [keyword]))


def filter_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    """Case-blind ``upper(c) LIKE '%SUFFIX'``."""
    return df.where(T.ends_with_ci(column, suffix))


def filter_keywords(df: DataFrame, column: str, keywords: list[str]) -> DataFrame:
    """Rows whose text holds any of the keywords (case-blind)."""
    return df.where(T.contains_any(column, keywords))


def filter_code(df: DataFrame, column: str, code: str) -> DataFrame:
    """Code equality with the code given as text, whatever the column type.

    On a whole-number column the code is compared as a number, so that the filter
    reaches the scan; a code that is no canonical number matches nothing there.
    """
    text, dtype = str(code), df.schema[column].dataType
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        bits = {ByteType: 7, ShortType: 15, IntegerType: 31, LongType: 63}[type(dtype)]
        number = int(text) if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", text) else None
        if number is None or not -(1 << bits) <= number < 1 << bits:
            return df.where(F.lit(False))
        return df.where(F.col(column) == F.lit(number).cast(dtype))
    return df.where(T.code_equals(column, code))


def filter_rlike(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Case-blind regex search."""
    return df.where(T.rlike_ci(column, regex))


def prospect(df: DataFrame, state_col: str, state, name_col: str,
             keywords: list[str]) -> DataFrame:
    """State equality AND any name keyword: the prospecting filter."""
    return filter_keywords(filter_equals(df, state_col, state), name_col, keywords)
