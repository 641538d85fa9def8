"""Word counts over whole texts with named tokenizers.

The text is split by a JVM regex, exploded, and counted with a hash aggregate
whose partial step runs before the shuffle, so frequent words ("the") are
combined map-side. No text is truncated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import ascii_only, has_ascii, split_tokens


def tokens(df: DataFrame, text: str = "value", tokenizer: str = "whitespace",
           lower: str | None = None, word: str = "word") -> DataFrame:
    """One row per non-empty token.

    ``lower="before"`` lower-cases the text before splitting, ``"after"`` lower-cases
    each token, ``None`` keeps the case."""
    t = F.lower(F.col(text)) if lower == "before" else F.col(text)
    w = df.select(F.explode(split_tokens(t, tokenizer)).alias(word)).where(F.col(word) != F.lit(""))
    if lower == "after":
        w = w.select(F.lower(F.col(word)).alias(word))
    return w


def word_count(df: DataFrame, text: str = "value", tokenizer: str = "whitespace",
               lower: str | None = None, ascii_filter: bool = False, word: str = "word",
               count: str = "count") -> DataFrame:
    """Occurrences per token.

    With ``ascii_filter`` only tokens that keep at least one ASCII character are
    returned, together with that ASCII-only form (``ascii_word``), which is made once per
    distinct token; two tokens may share one ASCII form."""
    counted = tokens(df, text, tokenizer, lower, word).groupBy(word).agg(F.count(F.lit(1)).alias(count))
    if ascii_filter:
        counted = counted.where(has_ascii(word)).select(word, ascii_only(word).alias("ascii_word"), count)
    return counted


def token_total(df: DataFrame, text: str = "value", tokenizer: str = "whitespace",
                lower: str | None = None, alias: str = "n_words") -> DataFrame:
    """Total number of non-empty tokens (one row)."""
    return tokens(df, text, tokenizer, lower).agg(F.count(F.lit(1)).alias(alias))
