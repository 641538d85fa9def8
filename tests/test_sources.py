from pyspark.sql import functions as F

from kiln.sources import (adjacency_edges, line_degree, parse_adjacency, quoted_csv_names,
                          read_delimited, read_dimension, read_lines, read_quoted_names)
from tests.conftest import rows


def _write(tmp_path, name, data: bytes):
    p = tmp_path / name
    p.write_bytes(data)
    return str(p)


def test_read_lines_crlf_and_lf(spark, tmp_path):
    path = _write(tmp_path, "book.txt", b"first line\r\nsecond line\nthird")
    assert [r.value for r in read_lines(spark, path).collect()] == ["first line", "second line", "third"]


def test_header_infer_and_explicit_schema(spark, tmp_path):
    path = _write(tmp_path, "people.csv", b"userID,name,age,friends\r\n0,Will,33,385\r\n1,Jean-Luc,26,2\r\n")
    inferred = read_delimited(spark, path, header=True, infer_schema=True)
    assert dict(inferred.dtypes) == {"userID": "int", "name": "string", "age": "int", "friends": "int"}
    plain = _write(tmp_path, "orders.csv", b"44,8602,37.19\n35,5368,65.89\n44,3555,10.00\n")
    df = read_delimited(spark, plain, schema="customer_id STRING, purchase_id STRING, amount DOUBLE")
    assert rows(df, "customer_id", "amount") == [("35", 65.89), ("44", 10.0), ("44", 37.19)]


def test_failfast_raises_and_permissive_nulls(spark, tmp_path):
    import pytest
    path = _write(tmp_path, "bad.csv", b"1,x,33\n2,y,notanint\n")
    schema = "id INT, name STRING, age INT"
    assert rows(read_delimited(spark, path, schema=schema), "id", "age") == [(1, 33), (2, None)]
    with pytest.raises(Exception):
        read_delimited(spark, path, schema=schema, mode="FAILFAST").collect()


def test_tab_and_double_colon_separators(spark, tmp_path):
    tab = _write(tmp_path, "u.data", b"196\t242\t3\t881250949\n186\t302\t3\t891717742\n")
    df = read_delimited(spark, tab, schema="userID INT, movieID INT, rating INT, ts BIGINT", sep="\t")
    assert rows(df, "userID", "movieID") == [(186, 302), (196, 242)]
    dc = _write(tmp_path, "ratings.dat", b"1::1193::5::978300760\n1::661::3::978302109\n")
    df = read_delimited(spark, dc, schema="u INT, m INT, r DOUBLE, ts BIGINT", sep="::")
    assert rows(df, "m", "r") == [(661, 3.0), (1193, 5.0)]


def test_dimension_latin1_pipe_quotes_off(spark, tmp_path):
    data = "1|Toy Story (1995)|01-Jan-1995\n2|Café \"Noir\"|x\n".encode("latin-1")
    path = _write(tmp_path, "u.item", data)
    df = read_dimension(spark, path, sep="|", key="movieID", name="title")
    assert rows(df) == [(1, "Toy Story (1995)"), (2, 'Café "Noir"')]
    assert read_dimension(spark, path, sep="|").orderBy("id").limit(1).count() == 1


def test_quoted_names_latin1_collapse(spark, tmp_path):
    data = '1 "24-HOUR MAN/EMMANUEL"\n2 "3-D  MAN/CHARLES CHAN"\n3 "FRÉDÉRIC"\n'.encode("latin-1")
    path = _write(tmp_path, "names.txt", data)
    got = rows(read_quoted_names(spark, path, key="heroID", name="heroName"))
    assert got == [(1, "24-HOUR MAN/EMMANUEL"), (2, "3-D MAN/CHARLES CHAN"), (3, "FRÉDÉRIC")]
    assert rows(quoted_csv_names(spark, path, key="heroID", name="heroName")) == got


def test_adjacency_parse_and_degrees(spark, tmp_path):
    path = _write(tmp_path, "graph.txt", b"5988 748 1722 \n5989 4080 4264\n5988 17\n42\n")
    lines = read_lines(spark, path)
    adj = parse_adjacency(lines)
    assert rows(adj) == [(42, []), (5988, [17]), (5988, [748, 1722]), (5989, [4080, 4264])]
    assert rows(adjacency_edges(adj)) == [(5988, 17), (5988, 748), (5988, 1722), (5989, 4080), (5989, 4264)]
    ws = rows(line_degree(lines, tokenizer="whitespace"))
    sp = rows(line_degree(lines, tokenizer="space"))
    assert ws == [("42", 0), ("5988", 1), ("5988", 2), ("5989", 2)]
    assert sp == [("42", 0), ("5988", 1), ("5988", 3), ("5989", 2)]


def test_bad_id_becomes_null(spark, tmp_path):
    path = _write(tmp_path, "g.txt", b"x 1 2\n3 4\n")
    adj = parse_adjacency(read_lines(spark, path))
    assert rows(adj.where(F.col("node").isNull()), "neighbours") == [([1, 2],)]


def test_double_colon_dimension_latin1_bounded(spark, tmp_path):
    data = "".join(f"{i}::Film {i} (19{i:02d})::Comedy|Drama\n" for i in range(1, 13)) + "13::Amélie (2001)::Romance\n"
    path = _write(tmp_path, "movies.dat", data.encode("latin-1"))
    names = read_dimension(spark, path, sep="::", key="movieID", name="title")
    assert names.count() == 13 and rows(names.where("movieID = 13"), "title") == [("Amélie (2001)",)]
    first = read_dimension(spark, path, sep="::", key="movieID", name="title").orderBy("movieID").limit(10)
    assert rows(first, "movieID") == [(i,) for i in range(1, 11)]


def test_latin1_lines_keep_nul_bytes_and_blank_lines(spark, tmp_path):
    path = tmp_path / "names.txt"
    path.write_bytes(b'1 "caf\xe9"\n\n2 "x\x00y"\n')
    from kiln.sources.text import parse_adjacency, read_latin1_lines
    lines = read_latin1_lines(spark, str(path))
    assert [r.value for r in lines.collect()] == ['1 "caf\u00e9"', "", '2 "x\x00y"']
    assert parse_adjacency(lines).count() == 2
