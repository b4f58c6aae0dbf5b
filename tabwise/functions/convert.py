"""Casting, value mapping and point updates."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Whole-value maps of the launch-data clean-up, as published.
# ---------------------------------------------------------------------------
LAUNCH_SITE_COUNTRIES = {
    "Shahrud Missile Test Site": "Iran",
    "New Mexico": "USA",
    "Yellow Sea": "China",
    "Pacific Missile Range Facility": "USA",
    "Pacific Ocean": "Multi National",
    "Barents Sea": "Russia",
    "Gran Canaria": "USA",
}
COMPANY_NAME_FIXES = {"Arm??e de l'Air": "Arme de l'Air"}
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars(c, chars: str) -> Column:
    """Delete every character of ``chars`` from the text."""
    return F.translate(_col(c), chars, "")


def to_number(c, dtype: str = "double") -> Column:
    """Strict cast: under ANSI mode a malformed value fails the job."""
    return _col(c).cast(dtype)


def try_number(c, dtype: str = "double") -> Column:
    """Tolerant cast: malformed values become null."""
    return _col(c).try_cast(dtype)


def cast_reject(c, dtype: str = "double") -> Column:
    """True where a present value cannot be cast to ``dtype``."""
    return _col(c).isNotNull() & _col(c).try_cast(dtype).isNull()


def truncate_int(c) -> Column:
    """Drop the fraction, toward zero, as a 64-bit integer."""
    return _col(c).cast("bigint")


def map_values(c, mapping: dict) -> Column:
    """Whole-value replacement by a dictionary; unmapped values are kept.

    The dictionary is a literal map inside the expression, so it travels with the
    task and needs no join. For maps too large to inline, join a lookup table.
    """
    if not mapping:
        return _col(c)
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(F.try_element_at(m, _col(c)), _col(c))


def set_cell(c, key_col, key, value) -> Column:
    """Point update: ``value`` where ``key_col == key``, the old value elsewhere."""
    return F.when(_col(key_col) == F.lit(key), F.lit(value)).otherwise(_col(c))
