"""Tokenizers and string helpers, all built from Spark's JVM-side string functions.

Three tokenizers give three different answers on the same text; they are kept
apart under their own names rather than merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Split patterns that must reproduce the reference's tokenisation.
#   ascii_words   - split on \W+ with ASCII word characters (Java's default \W)
#   unicode_words - split on \W+ in the Unicode sense (letters, digits, underscore)
#   whitespace    - Python's str.split(): any Unicode white space, including the
#                   information separators \x1c-\x1f and NEL \x85
#   space         - a single blank; runs and trailing blanks give empty tokens
ASCII_WORD_SPLIT = r"\W+"
UNICODE_WORD_SPLIT = r"[^\p{L}\p{N}_]+"
WHITESPACE_SPLIT = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
SPACE_SPLIT = " "
NON_ASCII = r"[^\x00-\x7F]"
ASCII = r"[\x00-\x7F]"
LINE_BREAK = r"\r?\n"

TOKENIZERS = {
    "ascii_words": ASCII_WORD_SPLIT,
    "unicode_words": UNICODE_WORD_SPLIT,
    "whitespace": WHITESPACE_SPLIT,
    "space": SPACE_SPLIT,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(text, tokenizer: str = "whitespace") -> Column:
    """Array of tokens of ``text`` by one of the named tokenizers.

    ``whitespace`` behaves like Python's ``str.split()``: no empty tokens. The
    other three keep the empty strings a regex split produces at the edges or
    between separators (``space`` counts them, the word splitters filter them later).
    """
    if tokenizer not in TOKENIZERS:
        raise ValueError(f"unknown tokenizer {tokenizer!r}; choose one of {sorted(TOKENIZERS)}")
    parts = F.split(_col(text), TOKENIZERS[tokenizer])
    if tokenizer == "whitespace":
        parts = F.filter(parts, lambda t: t != F.lit(""))
    return parts


def ascii_only(token) -> Column:
    """The token with every non-ASCII character removed (may become empty)."""
    return F.regexp_replace(_col(token), NON_ASCII, "")


def has_ascii(token) -> Column:
    """True when at least one ASCII character is left after ``ascii_only``."""
    return _col(token).rlike(ASCII)


def collapse_whitespace(text) -> Column:
    """Split on white space and join the pieces with one blank, as split/join does."""
    return F.array_join(split_tokens(text, "whitespace"), " ")


def strip_ends(text) -> Column:
    """Drop the first and the last character (the quotes around a quoted name)."""
    c = _col(text)
    return c.substr(F.lit(2), F.greatest(F.length(c) - F.lit(2), F.lit(0)))


def field_at(text, index: int, tokenizer: str = "whitespace") -> Column:
    """The ``index``-th token of a line (0-based); NULL when the line is shorter."""
    return F.get(split_tokens(text, tokenizer), index)


def contains(col, needle: str) -> Column:
    """Substring containment (``needle in value``); differs from equality on e.g. ``XTMAX``."""
    return _col(col).contains(needle)
