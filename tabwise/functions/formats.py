"""Number formatting and deterministic rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int = 4) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` as double.

    Plain IEEE operations, so any engine evaluating the same formula gets the same
    bits (``round`` differs between engines on representation ties). From
    ``|x| * 10^d = 2^53`` on a double has no digit left to round: such values, the
    infinities and NaN (which compares as the largest) are kept as they are.
    """
    scale = 10 ** digits
    x = _col(c).cast("double")
    rounded = (F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")
    return F.when(F.abs(x) * F.lit(scale) >= F.lit(float(1 << 53)), x).otherwise(rounded)


def _present(c, text: Column) -> Column:
    return F.when(_col(c).isNotNull(), text)


def fmt_int(c) -> Column:
    """Whole number as text; null stays null, here and below."""
    return _present(c, F.format_string("%d", _col(c).cast("bigint")))


def fmt_decimals(c, digits: int = 1) -> Column:
    return _present(c, F.format_string(f"%.{digits}f", round_half_up(c, digits)))


def fmt_percent(c, digits: int = 2) -> Column:
    """Share as percent text, e.g. 0.1234 -> '12.34%'."""
    return _present(c, F.format_string(f"%.{digits}f%%", round_half_up(_col(c) * 100, digits)))
