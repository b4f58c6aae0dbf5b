"""Text expressions: key padding, cleaning, keyword predicates, splitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwise.schemas import KEY_WIDTH

# ---------------------------------------------------------------------------
# Name keywords of the prospecting filters, as published.
# ---------------------------------------------------------------------------
SECURITY_KEYWORDS = ["SEGURANCA", "VIGILANCIA", "MONITORAMENTO"]
PROVIDER_KEYWORDS = [
    "TELECOM", "TELECOMUNICACOES", "LINK", "SERVICOS DE COMUNICACAO", "MULTIMIDIA",
    "INTERNET", "TECNOLOGIA", "INFORMACAO", "DIGITAL", "DIGITAIS",
]
PROVIDER_KEYWORDS_EXTENDED = PROVIDER_KEYWORDS + [
    "INSTALACAO", "MANUTENCAO", "ELETRICA", "SUPORTE TECNICO", "TECNICA", "SCM",
]
# Characters the sheet cleaner turns into spaces (stated intent), and the
# subset the published helper actually replaced.
CLEAN_CHARS = "\n;"
CLEAN_CHARS_OBSERVED = ";"
# ---------------------------------------------------------------------------

_REGEX_META = set(".^$*+?{}[]\\|()")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _regex_quote(text: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def pad_key(c, width: int = KEY_WIDTH) -> Column:
    """Left-pad a key with zeros to ``width``; longer keys are kept whole.

    ``lpad`` alone would truncate keys longer than ``width``; null stays null. A
    key that landed as a number with a fraction type is written as a whole number.
    """
    text = _col(c).cast("string")
    fractional = F.typeof(_col(c)).rlike("^(double|float|decimal)")
    s = F.when(fractional, text.cast("decimal(38,0)").cast("string")).otherwise(text)
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def clean_text(c, chars: str = CLEAN_CHARS) -> Column:
    """Replace every character of ``chars`` (newline and ``;``) with a space."""
    return F.translate(_col(c), chars, " " * len(chars))


def clean_text_observed(c) -> Column:
    """The variant that only replaces ``;`` (newlines survive)."""
    return clean_text(c, CLEAN_CHARS_OBSERVED)


def like_ci(c, pattern: str) -> Column:
    """Case-blind LIKE: ``upper(c) LIKE upper(pattern)``."""
    return F.upper(_col(c)).like(pattern.upper())


def ends_with_ci(c, suffix: str) -> Column:
    """Case-blind ends-with (Catalyst turns ``LIKE '%X'`` into EndsWith)."""
    return F.upper(_col(c)).like("%" + _escape_like(suffix.upper()))


def like_any(c, patterns: list[str], case_insensitive: bool = True) -> Column:
    """OR of LIKE patterns; the patterns are taken as written (``%`` and ``_``)."""
    if not patterns:
        raise ValueError("like_any needs at least one pattern")
    target = F.upper(_col(c)) if case_insensitive else _col(c)
    preds = [target.like(p.upper() if case_insensitive else p) for p in patterns]
    return reduce(lambda a, b: a | b, preds)


def contains_any(c, keywords: list[str], case_insensitive: bool = True) -> Column:
    """Row matches if the text holds any keyword (``LIKE '%KW%'`` per keyword)."""
    return like_any(c, ["%" + _escape_like(k) + "%" for k in keywords], case_insensitive)


def rlike_ci(c, regex: str) -> Column:
    """Case-blind regex search anywhere in the text."""
    return _col(c).rlike("(?i)" + regex)


def code_equals(c, code: str) -> Column:
    """Compare a code column with a code given as text, whatever the column type."""
    return _col(c).cast("string") == F.lit(str(code))


def split_nth(c, sep: str, n: int) -> Column:
    """n-th piece (0-based) of ``c`` split on the literal ``sep``; null if absent."""
    return F.get(F.split(_col(c), _regex_quote(sep), -1), n)


def split_last(c, sep: str) -> Column:
    """Last piece of ``c`` split on the literal ``sep``."""
    return F.try_element_at(F.split(_col(c), _regex_quote(sep), -1), F.lit(-1))


def concat_key(*cols) -> Column:
    """Concatenate key parts as text; null if any part is null."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def _escape_like(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def code_in(c, codes: list[str], multi_valued: bool = False, sep: str = ",") -> Column:
    """Code membership in a code set.

    Exact whole-value match by default; with ``multi_valued`` the cell holds a
    ``sep``-separated list and matches if any listed code is in the set.
    """
    codes = [str(x) for x in codes]
    if not multi_valued:
        return _col(c).cast("string").isin(codes)
    parts = F.split(_col(c).cast("string"), _regex_quote(sep), -1)
    return F.arrays_overlap(F.transform(parts, lambda x: F.trim(x)),
                            F.array(*[F.lit(x) for x in codes]))
