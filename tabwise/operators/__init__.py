"""DataFrame -> DataFrame operators."""

from tabwise.operators import (  # noqa: F401
    clean, enrich, filters, ordinal, prepare, profile, summarize,
)
