"""Column functions: every one returns a built-in Catalyst expression."""

from .numeric import (FLOAT_TEST, INT_TEST, cap, parse_float, parse_float_or_zero,
                      parse_int_or_zero, ratio_pct, round_half_up, rounded_pct, row_mean_abs)
from .recode import (full_match, impute_sentinel, indicators, label_threshold, recode_contains,
                     recode_full_match, recode_map)
from .text import explode_tokens, field, join_fields, replace_all, split_literal, tokens, upper

__all__ = [
    "FLOAT_TEST", "INT_TEST", "cap", "parse_float", "parse_float_or_zero", "parse_int_or_zero",
    "ratio_pct", "round_half_up", "rounded_pct", "row_mean_abs", "full_match", "impute_sentinel",
    "indicators", "label_threshold", "recode_contains", "recode_full_match", "recode_map",
    "explode_tokens", "field", "join_fields", "replace_all", "split_literal", "tokens", "upper",
]
