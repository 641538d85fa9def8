"""Helpers of the tokenizing operators, on whole Arrow batches: words cut out of the texts' bytes
by numpy, ids of distinct words remembered in flat arrays, ids laid out and decoded by gathering."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space of the splitting pattern (the Unicode property White_Space), fixed values.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

LETTER, NUMBER, SPACE, OTHER = range(4)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty), one after another, and the len + 1 places where they meet."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def words_between(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray):
    """Maximal runs of the bytes that ``is_word`` (256 booleans) marks, within each text: (words as
    a binary array, place of each in ``data``, index of its text)."""
    inside = is_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    ends = np.zeros(len(start) + 1, np.int32)
    np.cumsum(np.flatnonzero(last) + 1 - start, out=ends[1:])
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return words, start, np.searchsorted(bounds, start, "right") - 1


@lru_cache(maxsize=1)
def char_class() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, f"[{WHITE_SPACE}]+")):
        for m in regex.finditer(pattern, chars):
            out[[ord(c) for c in m.group()]] = kind
    return out


def pretoken_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places in ``data`` (UTF-8 texts that meet at ``bounds``) where a match of the published byte-level
    splitting pattern begins, in ascending order, and the end. The matches of a text cover it.

    The pattern takes runs of letters, of numbers and of other characters, each with one blank
    before it; a white-space run leaves its last character to what follows; an apostrophe
    at which a match begins takes the letters s, t, re, ve, m, ll or d after it."""
    at = np.flatnonzero((data & 0xC0) != 0x80)  # code point -> its first byte
    n = len(at)
    if not n:
        return np.zeros(1, np.int64)
    point = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = char_class()[point]
    edge = np.zeros(n + 1, bool)  # a text begins or ends
    edge[np.searchsorted(at, bounds)] = True
    edge[0] = edge[n] = True
    begins = edge.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    before = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])  # last of a run, and more text follows
    begins[before] = True
    begins[before[point[before] == 32] + 1] = False
    # An apostrophe by itself where a match begins, with letters of the same text after it.
    quote = np.flatnonzero((point == 39) & begins[:n] & begins[1:] & ~edge[1:])
    if len(quote):
        after = np.append(point, [0, 0]).astype(np.uint32)
        one, two = after[quote + 1], after[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        long &= ~edge[np.minimum(quote + 2, n)]
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long] + 3] = True
    return np.append(at, len(data))[begins]


def slices(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The pieces of ``data`` that begin at ``begins`` (the last of them is the end), as a binary array."""
    offsets = np.ascontiguousarray(begins - begins[0], np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[begins[0]:begins[-1]]))])


def gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges flat[first : first + size] one after another, and the len + 1 places where they meet."""
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    return flat[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])], ends


class IdPool:
    """Ids of the words seen so far, in one flat array. ``encode`` gives the ids of each of a list of
    words. Emptied when it holds more than ``limit`` words: a bound on memory, never on results."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.place: dict = {}
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _places(self, words: list) -> np.ndarray:
        if len(self.place) > self.limit:
            self.forget()
        place = self.place
        known = [place.get(w, -1) for w in words]
        missing = [w for w, p in zip(words, known) if p < 0]
        if missing:
            ids = self.encode(missing)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            new = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, new])
            place.update(zip(missing, range(len(place), len(place) + len(missing))))
            known = [place[w] if p < 0 else p for w, p in zip(words, known)]
        return np.array(known, np.int64)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the len + 1 places where the words meet. Distinct
        words are numbered in Arrow and looked up once."""
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        return gather(self.flat, self.first[place], self.size[place])


class Labels:
    """The bytes of every id: decoding gathers them."""

    def __init__(self, label: list[bytes]):
        self.size = np.fromiter(map(len, label), np.int64, len(label))
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(label), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after another, and the len + 1 places where they meet."""
        return gather(self.flat, self.first[ids], self.size[ids])


def binary_rows(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``data`` cut at ``bounds`` (in elements) as a binary array."""
    raw = np.ascontiguousarray(data).view(np.uint8)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
