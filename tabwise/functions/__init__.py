"""Column-level expressions. Each returns a ``Column`` built from Spark built-ins."""

from tabwise.functions.text import (
    clean_text, clean_text_observed, code_equals, code_in, concat_key, contains_any,
    ends_with_ci, like_any, like_ci, pad_key, rlike_ci, split_last, split_nth,
)
from tabwise.functions.convert import (
    cast_reject, map_values, set_cell, strip_chars, to_number, truncate_int,
    try_number,
)
from tabwise.functions.formats import fmt_decimals, fmt_int, fmt_percent, round_half_up
from tabwise.functions.arrays import one_hot, rescale
from tabwise.functions.json import json_field, pretty_json

__all__ = [
    "clean_text", "clean_text_observed", "code_equals", "code_in", "concat_key", "contains_any",
    "ends_with_ci", "like_any", "like_ci", "pad_key", "rlike_ci", "split_last",
    "split_nth", "cast_reject", "map_values", "set_cell", "strip_chars", "to_number",
    "truncate_int", "try_number", "fmt_decimals", "fmt_int", "fmt_percent",
    "round_half_up", "one_hot", "rescale", "json_field", "pretty_json",
]
