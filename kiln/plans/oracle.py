"""Independent SQL for every registered query (DuckDB dialect, test tables as views).

Written from the query definitions, not from the Spark plans. Double results
come from exact sums (DECIMAL / integer) followed by the same IEEE operations in
the same order, so values match bit for bit.
"""

from __future__ import annotations

from kiln.plans import params as P

# The tokenizer patterns (same strings as kiln.functions.text).
_ASCII_WORDS = r"\W+"
_UNICODE_WORDS = r"[^\p{L}\p{N}_]+"
_WHITESPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
_NON_ASCII = r"[^\x00-\x7F]"

_RATINGS = """r AS (
  SELECT o_custkey AS user_id, l_suppkey AS item_id,
         max((CAST(l_quantity AS INTEGER) % 5) + 1) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2)"""

_DEGREES = """per_order AS (
  SELECT l_orderkey, min(l_partkey) AS hub, count(*) AS n_items FROM lineitem GROUP BY 1),
deg AS (
  SELECT hub AS node, CAST(sum(n_items - 1) AS BIGINT) AS connections FROM per_order GROUP BY 1)"""

_DOC_LINES = r"""lines AS (
  SELECT unnest(regexp_split_to_array(text, '\r?\n')) AS value FROM documents)"""

_BFS = f"""WITH RECURSIVE per_order AS (
  SELECT l_orderkey, min(l_partkey) AS hub FROM lineitem GROUP BY 1),
e AS (
  SELECT h.hub AS src, l.l_partkey AS dst
  FROM lineitem l JOIN per_order h ON l.l_orderkey = h.l_orderkey
  WHERE l.l_partkey <> h.hub),
walk(node, d) AS (
  SELECT CAST({P.BFS_START} AS BIGINT), 0
  UNION
  SELECT e.dst, walk.d + 1 FROM walk JOIN e ON e.src = walk.node WHERE walk.d < {P.BFS_LEVELS}),
reach AS (SELECT node, min(d) AS d FROM walk GROUP BY node)"""


def _word_counts(pattern: str, lower_before: bool) -> str:
    text = "lower(text)" if lower_before else "text"
    return f"""WITH t AS (
  SELECT unnest(regexp_split_to_array({text}, '{pattern}')) AS word FROM documents)
SELECT word, regexp_replace(word, '{_NON_ASCII}', '', 'g') AS ascii_word, count(*) AS count
FROM t WHERE word <> ''
GROUP BY word
HAVING regexp_replace(word, '{_NON_ASCII}', '', 'g') <> ''"""


ORACLE: dict[str, str] = {
    "rating_histogram": f"WITH {_RATINGS} SELECT rating, count(*) AS count FROM r GROUP BY rating ORDER BY rating",
    "rating_total": f"WITH {_RATINGS} SELECT count(*) AS total FROM r",
    "popular_items": f"""SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey
ORDER BY count DESC, l_partkey LIMIT {P.TOP_ITEMS}""",
    "popular_items_named": f"""WITH t AS (
  SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey
  ORDER BY count DESC, l_partkey LIMIT {P.TOP_ITEMS})
SELECT t.l_partkey, t.count, p.p_name FROM t LEFT JOIN part p ON p.p_partkey = t.l_partkey""",
    "avg_by_group": """SELECT c_nationkey,
  CAST(sum(CAST(c_acctbal AS DECIMAL(38,10))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal
FROM customer GROUP BY c_nationkey""",
    "avg_by_group_rounded": """SELECT c_nationkey, round(fsum(c_acctbal) / count(c_acctbal), 2) AS avg_acctbal
FROM customer GROUP BY c_nationkey ORDER BY c_nationkey""",
    "item_counts_strict": """SELECT l_partkey, count(*) AS count, any_value(p_name) AS p_name
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey""",
    "line_fields": f"""WITH s AS (SELECT doc_id, regexp_split_to_array(text, '\\r?\\n') AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS value, unnest(range(len(ls))) AS line_no FROM s),
t AS (SELECT doc_id, line_no,
  list_filter(regexp_split_to_array(value, '{_WHITESPACE}'), lambda x: x <> '') AS toks FROM l)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, toks[3] AS third_field,
  coalesce(array_to_string(toks, ' '), '') AS collapsed FROM t""",
    "avg_by_group_pairs": """SELECT c_nationkey,
  CAST(sum(CAST(c_acctbal AS DECIMAL(38,10))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal
FROM customer GROUP BY c_nationkey""",
    "range_filter_sql": f"SELECT * FROM customer WHERE c_nationkey < {P.RANGE_HIGH} AND c_nationkey > {P.RANGE_LOW}",
    "group_size": "SELECT c_nationkey, count(*) AS count FROM customer GROUP BY c_nationkey ORDER BY c_nationkey",
    "select_columns": "SELECT c_name FROM customer",
    "filter_less_than": f"SELECT * FROM customer WHERE c_nationkey < {P.LESS_THAN}",
    "shifted_column": f"SELECT c_name, c_nationkey + {P.SHIFT} AS nationkey_shifted FROM customer",
    "spend_by_customer": """SELECT o_custkey,
  round(fsum(o_totalprice), 2) AS total_purchases
FROM orders GROUP BY o_custkey ORDER BY total_purchases DESC, o_custkey""",
    "spend_top5": f"""SELECT o_custkey,
  round(fsum(o_totalprice), 2) AS total_purchases
FROM orders GROUP BY o_custkey ORDER BY total_purchases DESC, o_custkey LIMIT {P.TOP_SPENDERS}""",
    "extreme_by_station_max": f"""SELECT user_id,
  max(value * CAST(0.1 AS DOUBLE) * CAST(9.0 AS DOUBLE) / 5 + 32) AS temp_f
FROM events WHERE contains(event_type, '{P.MEASURE}') GROUP BY user_id""",
    "extreme_by_station_min": f"""SELECT user_id, min(value) AS min_value,
  min(value) * CAST(0.1 AS DOUBLE) * CAST(9.0 AS DOUBLE) / 5 + 32 AS temp_f
FROM events WHERE event_type = '{P.MEASURE}' GROUP BY user_id""",
    "distinct_stations": f"SELECT DISTINCT user_id FROM events WHERE contains(event_type, '{P.MEASURE}')",
    "station_counts": f"""SELECT user_id, count(*) AS count FROM events
WHERE contains(event_type, '{P.MEASURE}') GROUP BY user_id""",
    "word_count_ascii": f"""WITH t AS (
  SELECT unnest(regexp_split_to_array(text, '{_ASCII_WORDS}')) AS w FROM documents)
SELECT lower(w) AS word, count(*) AS count FROM t WHERE w <> '' GROUP BY lower(w)""",
    "word_count_unicode": _word_counts(_UNICODE_WORDS, lower_before=True),
    "word_count_raw": _word_counts(_WHITESPACE, lower_before=False),
    "word_total": f"""WITH t AS (
  SELECT unnest(regexp_split_to_array(text, '{_ASCII_WORDS}')) AS w FROM documents)
SELECT count(*) AS n_words FROM t WHERE w <> ''""",
    "degree_ranking": f"""WITH {_DEGREES}
SELECT d.node, d.connections, p1.p_name, p2.p_name AS p_name_check
FROM deg d LEFT JOIN part p1 ON p1.p_partkey = d.node LEFT JOIN part p2 ON p2.p_partkey = d.node""",
    "most_connected": f"""WITH {_DEGREES},
top AS (SELECT node, connections FROM deg ORDER BY connections DESC, node LIMIT 1)
SELECT top.node, top.connections, p.p_name FROM top LEFT JOIN part p ON p.p_partkey = top.node""",
    "least_connected": f"""WITH {_DEGREES}
SELECT d.node, d.connections, p.p_name FROM deg d LEFT JOIN part p ON p.p_partkey = d.node
WHERE d.connections < {P.FEW_CONNECTIONS}""",
    "global_min_degree": f"WITH {_DEGREES} SELECT min(connections) AS min_connections FROM deg",
    "min_degree_nodes": f"""WITH {_DEGREES}
SELECT node, connections FROM deg WHERE connections = (SELECT min(connections) FROM deg)""",
    "line_degree_space": f"""WITH {_DOC_LINES},
t AS (SELECT string_split(value, ' ') AS toks FROM lines)
SELECT toks[1] AS node, CAST(sum(greatest(len(toks) - 1, 0)) AS BIGINT) AS connections
FROM t GROUP BY toks[1]""",
    "line_degree_ws": f"""WITH {_DOC_LINES},
t AS (SELECT list_filter(regexp_split_to_array(value, '{_WHITESPACE}'), lambda x: x <> '') AS toks FROM lines)
SELECT toks[1] AS node, CAST(sum(greatest(len(toks) - 1, 0)) AS BIGINT) AS connections
FROM t GROUP BY toks[1]""",
    "bfs_distances": f"""{_BFS},
everyone AS (SELECT hub AS node FROM per_order UNION SELECT node FROM reach)
SELECT a.node, CAST(coalesce(r.d, 9999) AS INTEGER) AS distance,
  CASE WHEN r.d IS NULL THEN 'WHITE' WHEN r.d < {P.BFS_LEVELS} THEN 'BLACK' ELSE 'GRAY' END AS color
FROM everyone a LEFT JOIN reach r ON a.node = r.node""",
    "bfs_target": f"""{_BFS},
hit AS (SELECT d FROM reach WHERE node = {P.BFS_TARGET})
SELECT CAST({P.BFS_START} AS BIGINT) AS start, CAST({P.BFS_TARGET} AS BIGINT) AS target,
  CAST((SELECT d FROM hit) AS INTEGER) AS degrees,
  (SELECT count(*) FROM e JOIN reach p ON e.src = p.node
   WHERE e.dst = {P.BFS_TARGET} AND p.d = (SELECT d FROM hit) - 1) AS hits""",
    "similar_items": f"""WITH {_RATINGS},
a AS (SELECT user_id, rating AS rr FROM r WHERE item_id = {P.REF_ITEM}),
s AS (
  SELECT o.item_id AS other_item, sum(o.rating * a.rr) AS numerator,
         sum(a.rr * a.rr) AS sum_ref, sum(o.rating * o.rating) AS sum_other,
         count(o.rating * a.rr) AS num_pairs
  FROM r o JOIN a ON o.user_id = a.user_id
  WHERE o.item_id <> {P.REF_ITEM} GROUP BY o.item_id),
sc AS (
  SELECT CASE WHEN {P.REF_ITEM} > other_item THEN {P.REF_ITEM} ELSE other_item END AS item_1,
         CASE WHEN {P.REF_ITEM} > other_item THEN other_item ELSE {P.REF_ITEM} END AS item_2,
         other_item, numerator / (sqrt(sum_ref) * sqrt(sum_other)) AS score, num_pairs
  FROM s),
top AS (
  SELECT * FROM sc WHERE score > CAST({P.MIN_SCORE} AS DOUBLE) AND num_pairs > {P.MIN_SUPPORT}
  ORDER BY score DESC, other_item LIMIT {P.TOP_SIMILAR})
SELECT top.*, su.s_name FROM top LEFT JOIN supplier su ON su.s_suppkey = top.other_item""",
    "similar_pairs": f"""WITH {_RATINGS},
g AS (
  SELECT a.item_id AS item_1, b.item_id AS item_2, sum(a.rating * b.rating) AS numerator,
         sum(a.rating * a.rating) AS xx, sum(b.rating * b.rating) AS yy,
         count(a.rating * b.rating) AS num_pairs
  FROM r a JOIN r b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY 1, 2)
SELECT item_1, item_2,
  CASE WHEN sqrt(xx) * sqrt(yy) = 0 THEN CAST(0 AS DOUBLE)
       ELSE numerator / (sqrt(xx) * sqrt(yy)) END AS score,
  num_pairs
FROM g
WHERE num_pairs > {P.MIN_SUPPORT} AND numerator / (sqrt(xx) * sqrt(yy)) > {P.MIN_SCORE}""",
    "mean_by_group_int": """SELECT l_suppkey, avg(l_linenumber) AS avg_linenumber FROM lineitem GROUP BY l_suppkey ORDER BY l_suppkey""",
    "line_degree_each": """SELECT split_part(line, ' ', 1) AS node, CAST(len(string_split(line, ' ')) - 1 AS INTEGER) AS degree
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
    "all_pairs_similarity": f"""WITH {_RATINGS},
g AS (
  SELECT a.item_id AS item_1, b.item_id AS item_2, sum(a.rating * b.rating) AS numerator,
         sum(a.rating * a.rating) AS xx, sum(b.rating * b.rating) AS yy,
         count(a.rating * b.rating) AS num_pairs
  FROM r a JOIN r b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY 1, 2)
SELECT item_1, item_2,
  CASE WHEN sqrt(xx) * sqrt(yy) = 0 THEN CAST(0 AS DOUBLE)
       ELSE numerator / (sqrt(xx) * sqrt(yy)) END AS score,
  num_pairs
FROM g""",
    "sum_of_squares": """WITH s AS (SELECT sum(CAST(l_orderkey AS HUGEINT) * l_orderkey) AS total, count(*) AS n FROM lineitem)
SELECT CAST(total AS DOUBLE) AS sum_of_squares, CAST(total AS VARCHAR) AS sum_of_squares_exact, n FROM s""",
    "holdout_per_user": f"""WITH {_RATINGS},
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rk FROM r)
SELECT user_id, item_id, rating,
  CASE WHEN rk BETWEEN {P.HOLDOUT_START} AND {P.HOLDOUT_STOP} THEN 'test' ELSE 'base' END AS part
FROM k""",
    "holdout_capped": f"""WITH {_RATINGS},
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rk FROM r),
q AS (
  SELECT user_id, item_id, row_number() OVER (ORDER BY user_id, item_id) AS qn
  FROM k WHERE rk BETWEEN {P.HOLDOUT_START} AND {P.HOLDOUT_STOP})
SELECT k.user_id, k.item_id, k.rating,
  CASE WHEN q.qn <= {P.HOLDOUT_MAX_TEST} THEN 'test' ELSE 'base' END AS part
FROM k LEFT JOIN q ON k.user_id = q.user_id AND k.item_id = q.item_id""",
    "contiguous_folds": f"""WITH {_RATINGS},
n AS (SELECT *, row_number() OVER (ORDER BY user_id, item_id) AS g, count(*) OVER () AS total FROM r)
SELECT user_id, item_id, rating,
  CAST((g - 1) * {P.FOLDS} // total + 1 AS INTEGER) AS fold
FROM n""",
}

ORACLE["fold_base"] = f"""WITH {_RATINGS},
n AS (SELECT *, row_number() OVER (ORDER BY user_id, item_id) AS g, count(*) OVER () AS total FROM r),
f AS (SELECT user_id, item_id, rating,
  CAST((g - 1) * {P.FOLDS} // total + 1 AS INTEGER) AS fold FROM n)
SELECT * FROM f WHERE fold <> {P.BASE_OF_FOLD} ORDER BY user_id, item_id"""

ORACLE["top_support_pairs"] = ORACLE["all_pairs_similarity"] + \
    f"\nORDER BY num_pairs DESC, item_1, item_2 LIMIT {P.TOP_PAIRS}"
ORACLE["sampled_ratings"] = f"""WITH {_RATINGS}
SELECT * FROM r ORDER BY md5(concat_ws('|', '{P.SAMPLE_SEED}', user_id, item_id)) LIMIT {P.SAMPLE_ROWS}"""
