"""Column types found from all rows, in one pass.

A cell that could be read as a type has that type's bit; a missing cell has all
of them. What a column can be is the bitwise AND over its cells, an aggregate
whose partial results merge in any order: so one partial aggregate over the text
finds the types of all columns, without a sample and without a shuffle of rows.

A type is offered only where the text comes back: codes with leading zeros or a plus
sign, and integers with more digits than the type holds, stay text. Decimals are
read as the nearest double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BOOLEAN, _LONG, _DOUBLE, _DATE, _TIMESTAMP = (1 << i for i in range(5))
_ALL = (1 << 5) - 1
#: Tried in this order: the first type that every cell allows is the column's.
_ORDER = ((_BOOLEAN, T.BooleanType()), (_LONG, T.LongType()), (_DOUBLE, T.DoubleType()), (_DATE, T.DateType()),
          (_TIMESTAMP, T.TimestampType()))

_INTEGER = "^(?:0|-?[1-9][0-9]{0,18})$"
_DECIMAL = r"^-?(?:(?:0|[1-9][0-9]*)(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]{1,3})?$"
_NOT_FINITE = "^(?:NaN|-?Infinity)$"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = _DAY + r"[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?$"
#: Integers of so many digits are exact as doubles.
_DOUBLE_DIGITS = 15


def _bits(cell: Column) -> Column:
    digits = F.length(F.replace(cell, F.lit("-"), F.lit("")))
    whole = F.when(cell.try_cast("bigint").isNull(), 0).when(digits <= _DOUBLE_DIGITS, _LONG | _DOUBLE).otherwise(_LONG)
    return (F.when(cell.isNull() | (cell == ""), _ALL)
            .when(cell.rlike(_INTEGER), whole)
            .when(cell.rlike(_DECIMAL), F.when(cell.rlike("^-?[0-9]+$") | (F.abs(cell.try_cast("double")) == float("inf")), 0)
                  .otherwise(_DOUBLE))
            .when(cell.rlike(_NOT_FINITE), _DOUBLE)
            .when(F.lower(cell).isin("true", "false"), _BOOLEAN)
            .when(cell.rlike(_DAY + "$"), F.when(cell.try_cast("date").isNull(), 0).otherwise(_DATE | _TIMESTAMP))
            .when(cell.rlike(_TIME), F.when(cell.try_cast("timestamp").isNull(), 0).otherwise(_TIMESTAMP))
            .otherwise(0))


def infer_types(df: DataFrame, columns: list[str] | None = None, dates: bool = True) -> T.StructType:
    """The schema of ``df`` with the types that all cells of its text columns allow.

    Boolean, bigint, double, date and timestamp, in this order; else text, also
    where every cell is missing (null or empty) and in an empty table. Columns that
    are no text keep their type. ``columns`` limits the search, ``dates`` off leaves
    dates and timestamps text.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not text:
        return df.schema
    cells = [F.col(f"`{c}`") for c in text]
    row = df.agg(*[F.bit_and(_bits(c)).alias(f"b{i}") for i, c in enumerate(cells)],
                 *[F.max(F.when(c != "", True)).alias(f"any{i}") for i, c in enumerate(cells)]).first()
    skipped = 0 if dates else _DATE | _TIMESTAMP
    found = {}
    for i, c in enumerate(text):
        bits = (row[f"b{i}"] or 0) & ~skipped if row[f"any{i}"] else 0
        found[c] = next((kind for bit, kind in _ORDER if bits & bit), T.StringType())
    return T.StructType([T.StructField(f.name, found.get(f.name, f.dataType), True) for f in df.schema.fields])


def with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the types of ``schema``; an empty cell of a column that is no text is null."""
    return df.select(*[
        (F.when(F.col(f"`{f.name}`") != "", F.col(f"`{f.name}`")).cast(f.dataType)
         if isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType)
         else F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields])
