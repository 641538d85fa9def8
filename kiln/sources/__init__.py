"""Sources: text lines, delimited files with schemas/encodings, and the test tables."""

from kiln.sources.delimited import (limit_rows, quoted_csv_names, read_delimited, read_dimension,
                                    read_quoted_names)
from kiln.sources.numbered import first_lines, read_numbered, read_numbered_lines
from kiln.sources.tables import document_lines, order_graph, order_lines, ratings, table
from kiln.sources.text import (adjacency_edges, line_degree, parse_adjacency, read_latin1_lines,
                               read_lines, text_lines)

__all__ = [
    "adjacency_edges", "document_lines", "first_lines", "limit_rows", "line_degree", "order_graph", "order_lines",
    "parse_adjacency", "quoted_csv_names", "ratings", "read_delimited", "read_dimension",
    "read_latin1_lines", "read_lines", "read_numbered", "read_numbered_lines", "read_quoted_names", "table", "text_lines",
]
