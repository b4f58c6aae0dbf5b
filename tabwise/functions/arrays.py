"""Array expressions for dataset preparation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rescale(arr, factor: float = 1.0 / 255) -> Column:
    """Multiply every element by ``factor`` (as double)."""
    return F.transform(_col(arr), lambda x: x.cast("double") * F.lit(factor))


def one_hot(position, width) -> Column:
    """0/1 array of ``width`` entries with a 1 at ``position``; all zeros for a null position."""
    at = F.coalesce(_col(position), F.lit(-1))
    places = F.filter(F.sequence(F.lit(0), _col(width)), lambda i: i < _col(width))
    return F.transform(places, lambda i: (i == at).cast("int"))
