"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(c, schema_ddl: str, *path: str) -> Column:
    """Parse JSON text with an explicit schema and pick a nested field."""
    out = F.from_json(_col(c), schema_ddl)
    for p in path:
        out = out.getField(p) if not isinstance(p, int) else out.getItem(p)
    return out


def sorted_fields(c: Column, dtype: T.DataType) -> Column:
    """The value with the fields of every struct in it in sorted order."""
    if isinstance(dtype, T.StructType):
        fields = [sorted_fields(c[f.name], f.dataType).alias(f.name)
                  for f in sorted(dtype.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: sorted_fields(x, dtype.elementType))
    return c


def pretty_json(*cols: str, schema: T.StructType | None = None) -> Column:
    """Indented JSON text of the given columns, keys in sorted order, null fields kept.

    With the frame's ``schema`` the keys of nested objects are sorted too.
    """
    parts = [F.col(f"`{n}`") if schema is None else sorted_fields(F.col(f"`{n}`"), schema[n].dataType).alias(n)
             for n in sorted(cols)]
    return F.to_json(F.struct(*parts), {"pretty": "true", "ignoreNullFields": "false"})
