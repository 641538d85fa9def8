"""Chunked byte-level BPE against the tiktoken library, splits against the regular expression."""

import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from kiln.llm import chunk_bpe, word_ids

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(spark, texts, ids=None, **sizes):
    ids = ids if ids is not None else list(range(len(texts)))
    docs = spark.createDataFrame(list(zip(ids, texts, ["x"] * len(texts))), "doc_id long, text string, decoded string")
    return chunk_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, **sizes).collect()


ALPHABET = "  \n\ta'''sstmdrevlé1²½!,.　\xa0漢字😀́\x1c\x85  "


def test_splits_equal_the_regular_expression():
    white = word_ids.WHITE_SPACE
    split = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", f"[^{white}").replace(r"\s+", f"[{white}]+")
                          .replace(r"\S", f"[^{white}]"))
    rng = random.Random(1)
    for _ in range(1500):
        texts = [rng.choice([None, ""]) if rng.random() < 0.1 else
                 "".join(rng.choices(ALPHABET, k=rng.randint(0, 25))) for _ in range(rng.randint(0, 6))]
        data, bounds = word_ids.text_bytes(pa.array(texts, pa.string()))
        begins = word_ids.pretoken_bounds(data, bounds)
        words, at = word_ids.slices(data, begins).to_pylist(), np.searchsorted(begins, bounds)
        got = [[w.decode() for w in words[a:b]] for a, b in zip(at[:-1], at[1:])]
        assert got == [split.findall(t or "") for t in texts], texts


def test_chunks_cover_the_text_and_overlap():
    data = ("word " * 50 + "x" * 300 + " é漢" * 40 + "end of it").encode()
    parts = chunk_bpe.chunks(data, 40, 8)
    assert parts[0][0] == 0 and parts[-1][1] == len(data)
    assert all(b[0] < a[1] <= len(data) for a, b in zip(parts[:-1], parts[1:]))
    assert all(data[a:b].decode() is not None for a, b in parts)  # no character is cut


@pytest.mark.parametrize("chunk", [16, 64, chunk_bpe.CHUNK])
def test_ids_equal_the_library(spark, library, chunk):
    rng = random.Random(chunk)
    texts = [None, "", " ", "it's 'll we'd\n\n  x", "a" * 3000, " " * 500 + "x", "'" * 200 + "re", "漢字" * 300, "\n" * 700,
             "x" * 400 + " y" * 400, "1" * 90 + "a'll" * 90]
    texts += ["".join(rng.choices(ALPHABET + "aaaabbb   ", k=rng.randint(1, 700))) for _ in range(60)]
    texts += ["the same text again " * 20] * 3
    got = {}
    for r in rows_of(spark, texts, chunk=chunk, overlap=4 if chunk < 100 else chunk_bpe.OVERLAP):
        got[r.doc_id] = (np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode())
    assert got == {i: (library.encode_ordinary(t or ""), t or "") for i, t in enumerate(texts)}


def test_repeated_and_null_ids_and_no_rows(spark, library):
    long = "some words and more " * 30
    got = rows_of(spark, [long, long, None, "short"], [7, 7, None, None], chunk=100, overlap=8)
    assert sorted((r.doc_id or -1, len(r.ids) // 4) for r in got) == sorted(
        [(7, n := len(library.encode_ordinary(long))), (7, n), (-1, 0), (-1, len(library.encode_ordinary("short")))])
    assert rows_of(spark, []) == []


def test_a_very_long_text_passes(spark, library):
    text = ("a long text, it goes on and on. " * 12_000) + "z" * 200_000 + " end"
    (row,) = rows_of(spark, [text])
    expected = library.encode_ordinary(text)
    assert np.frombuffer(row.ids, "<u4").tolist() == expected and bytes(row.decoded).decode() == text


def test_another_pattern_is_refused(spark):
    with pytest.raises(ValueError):
        chunk_bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string"), RANKS, r"\w+")
