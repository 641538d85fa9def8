"""Column-level helpers (tokenizers, numeric conversions). All are JVM-side expressions."""

from kiln.functions.numeric import (cosine, decimal_parts, exact_square_sum, round_half_up,
                                    tenths_celsius_to_fahrenheit)
from kiln.functions.text import (TOKENIZERS, ascii_only, collapse_whitespace, contains, field_at,
                                 has_ascii, split_tokens, strip_ends)

__all__ = [
    "TOKENIZERS", "ascii_only", "collapse_whitespace", "contains", "cosine", "exact_square_sum",
    "decimal_parts", "field_at", "has_ascii", "round_half_up", "split_tokens", "strip_ends",
    "tenths_celsius_to_fahrenheit",
]
