"""Line-oriented sources: text lines, adjacency lines, per-line token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.text import LINE_BREAK, split_tokens


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``. ``\\n`` and ``\\r\\n`` both end a line.
    Content is read as UTF-8; use ``read_latin1_lines`` for ISO-8859-1 files."""
    return spark.read.text(path)


def read_latin1_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """One row per line decoded with ``encoding``: the bytes of every line, whatever they are,
    pass through the text source unchanged and are decoded afterwards."""
    return spark.read.text(path).select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def text_lines(df: DataFrame, text: str = "text", keep=("doc_id",), value: str = "value",
               line_no: str = "line_no") -> DataFrame:
    """Split a whole-text column into its lines (every line, in order)."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), LINE_BREAK)).alias(line_no, value))


def parse_adjacency(lines: DataFrame, value: str = "value", node: str = "node",
                    neighbours: str = "neighbours", id_type: str = "bigint",
                    tokenizer: str = "whitespace") -> DataFrame:
    """Adjacency lines ``node n1 n2 ...`` to ``(node, neighbours ARRAY)``.

    The first token is the node, the rest its neighbours. Ids that do not parse
    become NULL (``try_cast``) instead of failing the job. Lines without a token are no nodes."""
    toks = split_tokens(F.col(value), tokenizer)
    return lines.where(F.col(value).rlike(r"\S")).select(
        F.get(toks, 0).try_cast(id_type).alias(node),
        F.transform(F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))),
                    lambda t: t.try_cast(id_type)).alias(neighbours),
    )


def adjacency_edges(adjacency: DataFrame, node: str = "node", neighbours: str = "neighbours",
                    src: str = "src", dst: str = "dst") -> DataFrame:
    """Explode adjacency rows into one ``(src, dst)`` row per listed neighbour (repeats kept)."""
    return adjacency.select(F.col(node).alias(src), F.explode(neighbours).alias(dst))


def line_degree(lines: DataFrame, value: str = "value", tokenizer: str = "whitespace",
                node: str = "node", degree: str = "degree") -> DataFrame:
    """Per line: the first token and the number of tokens after it.

    ``tokenizer="space"`` splits on single blanks, so a trailing or doubled blank
    counts as a token; ``"whitespace"`` does not (and a line of one token has 0)."""
    toks = split_tokens(F.col(value), tokenizer)
    return lines.select(F.get(toks, 0).alias(node),
                        F.greatest(F.size(toks) - F.lit(1), F.lit(0)).alias(degree))
