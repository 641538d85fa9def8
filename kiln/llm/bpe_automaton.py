"""BPE encoding and decoding by a deterministic tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that BPE gives. It
starts as one state with a loop for every byte and grows by one *merge gadget* for each
merge (u, v), in order of rank: the state that u leads to is split, its copy loses the arc
v (a v after a u would have been merged), every u arc is led to the copy, and every state
that has a u arc gets an arc uv to where v led. All arcs with one label lead to one state,
so a state is stored as its parent, the arc it lost and the step it was made at, and
whether it has an arc follows from these tables (``has_arc``), memorised per (state, token).

A word is encoded left to right: from every reached position the arcs of its state that
match the bytes ahead are followed. A prefix of a BPE sequence is the BPE sequence of that
prefix, so each position is reached by one arc only, and the path to the end is the
encoding. Decoding emits the labels of the arcs.

Texts are split into words by numpy, a batch of rows at a time; each distinct word of a batch
passes the automaton once, and ids and labels are laid out by gathering.

Null text is read as empty text: no ids, decoded text "". A row is encoded by itself, so
repeated rows, ties and the order of rows do not matter; other columns are not read. A very long
text is a batch by itself, held by one task. An empty table gives no rows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from kiln.llm.common import pick, ranges, ship
from kiln.llm.word_ids import IdPool, Labels, binary_rows, pretoken_bounds, slices, text_bytes

#: Entries a task keeps of words already encoded, and of arcs already looked up. Memory
#: bounds only: on reaching one the table is emptied and filled anew.
WORD_CACHE = 400_000
ARC_CACHE = 2_000_000
#: Bytes of text encoded at once.
SLICE = 4 << 20


def byte_symbols() -> dict[str, int]:
    """Symbol of the vocabulary file -> byte: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BpeAutomaton:
    """The compiled automaton of one byte-level vocabulary file."""

    def __init__(self, vocab: dict[str, int], merges: list, added: list[dict] = ()):
        symbols = byte_symbols()
        size = max([*vocab.values(), *(a["id"] for a in added)]) + 1
        self.label: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if all(c in symbols for c in token):
                self.label[i] = bytes(symbols[c] for c in token)
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens that strip, normalise or match whole words are not supported")
        self.added = {a["content"]: a["id"] for a in added}
        for content, i in self.added.items():
            self.label[i] = content.encode()
        self._added_split = (regex.compile(b"|".join(
            regex.escape(t.encode()) for t in sorted(self.added, key=len, reverse=True))) if self.added else None)

        self.made_at = [-1]   # state -> step of the split that made it; state 0 is the start
        self.parent = [-1]    # state -> state it is a copy of
        self.lost = [-1]      # state -> token whose arc the copy lost
        self.target = [0] * size   # token -> state its arcs lead to
        self.born = [-1] * size    # token -> step of its merge
        self.left = [-1] * size    # token -> left part
        live = {vocab[s] for s in symbols if s in vocab}
        for step, merge in enumerate(merges):
            u, v = merge.split(" ") if isinstance(merge, str) else merge
            a, b, ab = vocab[u], vocab[v], vocab[u + v]
            if ab in live:
                raise ValueError(f"two merges make the token {u + v!r}")
            if a not in live or b not in live or not self.has_arc(self.target[a], b):
                continue  # u is never followed by v: the gadget adds no arc
            self.born[ab], self.left[ab], self.target[ab] = step, a, self.target[b]
            live.add(ab)
            self.made_at.append(step)
            self.parent.append(self.target[a])
            self.lost.append(b)
            self.target[a] = len(self.parent) - 1
        #: Prefix of a live token's label -> the token, or -1: the table the bytes ahead are read with.
        self._ahead: dict[bytes, int] = {}
        for t in live:
            text = self.label[t]
            for n in range(1, len(text)):
                self._ahead.setdefault(text[:n], -1)
            self._ahead[text] = t
        self._arcs: dict[int, bool] = {}
        self.words = IdPool(lambda words: [self.encode_bytes(w) for w in words], WORD_CACHE)
        self.labels = Labels(self.label)

    @classmethod
    def from_text(cls, text: str) -> "BpeAutomaton":
        spec = json.loads(text)
        return cls(spec["model"]["vocab"], spec["model"]["merges"], spec["added_tokens"])

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has an arc for ``token``. A token merged after the state was made
        is there if its left part is; an older one is there if the copied state had it,
        but for the arc that was lost."""
        made_at, born = self.made_at, self.born
        while state:
            step = made_at[state]
            while born[token] >= step:
                token = self.left[token]
            if token == self.lost[state]:
                return False
            state = self.parent[state]
        return True

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one pre-split word."""
        n, ahead, arcs, target = len(data), self._ahead, self._arcs, self.target
        arrived = [-1] * (n + 1)  # position -> token whose arc ends there
        for i in range(n):
            state = target[arrived[i]] if i else 0
            for j in range(i + 1, n + 1):
                token = ahead.get(data[i:j])
                if token is None:
                    break
                if token >= 0:
                    key = state << 20 | token
                    ok = arcs.get(key)
                    if ok is None:
                        if len(arcs) >= ARC_CACHE:
                            arcs.clear()
                        ok = arcs[key] = self.has_arc(state, token)
                    if ok:
                        arrived[j] = token
        out, i = [], n
        while i:
            out.append(arrived[i])
            i -= len(self.label[arrived[i]])
        return out[::-1]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the len + 1 places where the texts meet. The
        words of all texts are cut out by numpy; distinct ones pass the automaton once."""
        data, bounds = text_bytes(texts)
        raw = data.tobytes() if self.added else b""
        marks = sorted((m.start(), m.end()) for m in self._added_split.finditer(raw)) if self.added else []
        # Added tokens are texts of their own, whose word has one id.
        marks = [(a, b) for a, b in marks if np.searchsorted(bounds, a, "right") == np.searchsorted(bounds, b, "left")]
        cuts = np.unique(np.concatenate([bounds, np.array(marks, np.int64).ravel()]))
        begins = pretoken_bounds(data, cuts)
        if marks:
            keep = np.ones(len(begins), bool)
            for a, b in marks:
                keep[np.searchsorted(begins, a) + 1:np.searchsorted(begins, b)] = False
            begins = begins[keep]
        ids, ends = self.words.ids(slices(data, begins))
        if marks:
            at = np.searchsorted(begins, [a for a, _ in marks])
            size = np.diff(ends)
            new = size.copy()
            new[at] = 1
            out = np.zeros(int(new.sum()), np.uint32)
            ends = np.concatenate([[0], np.cumsum(new)])
            plain = np.ones(len(new), bool)
            plain[at] = False
            out[np.repeat(plain, new)] = ids[np.repeat(plain, size)]
            out[ends[at]] = [self.added[raw[a:b].decode()] for a, b in marks]
            ids = out
        return ids, ends[np.searchsorted(begins, bounds)]

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        return self.encode_batch(pa.array([text], pa.string()))[0].astype("<u4").tobytes()

    def forget(self) -> None:
        """Empty the tables of words and arcs seen, so that an idle worker holds little memory."""
        self.words.forget()
        self._arcs.clear()

    def decode(self, ids) -> str:
        """Text of the ids (any iterable of integers): the labels of their arcs."""
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


_COMPILED: dict[str, BpeAutomaton] = {}


def automaton(spec: str) -> BpeAutomaton:
    """The automaton of a vocabulary file's content, compiled once for each worker process."""
    if spec not in _COMPILED:
        _COMPILED[spec] = BpeAutomaton.from_text(spec)
    return _COMPILED[spec]


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers, and their text.

    ``vocabulary``: path of a byte-level vocabulary file. The driver reads it; its content
    (a fixed size, about 1.5 MB) goes to the executors with the task."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        auto = automaton(spec.value)
        for batch in batches:
            for lo, hi in ranges(np.diff(text_bytes(batch.column(1))[1]), SLICE):
                part = batch.slice(lo, hi - lo)
                ids, ends = auto.encode_batch(part.column(1))
                decoded, meet = auto.labels.decode(ids)
                text = [d.decode("utf-8", "replace") for d in binary_rows(decoded, meet[ends]).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), binary_rows(ids, ends), pa.array(text, pa.string())],
                                                 names=["doc_id", "ids", "decoded"])

    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def with_ids(docs: DataFrame, vocabulary: str, text_col: str = "text", word_cache: int = 100_000) -> DataFrame:
    """``docs`` with n_tokens and ids after its own columns (which give way if named alike). The
    ids are decoded again in the task, and a row whose text does not come back fails the job.
    As one stage among others it remembers fewer words, and none after a task."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    ship(docs.sparkSession)
    docs = docs.drop("n_tokens", "ids")
    position = docs.columns.index(text_col)

    def run(batches):
        auto = automaton(spec.value)
        auto.words.limit = word_cache
        for batch in batches:
            for lo, hi in ranges(np.diff(text_bytes(batch.column(position))[1]), SLICE):
                part = batch.slice(lo, hi - lo)
                ids, ends = auto.encode_batch(part.column(position))
                decoded, meet = auto.labels.decode(ids)
                data, bounds = text_bytes(part.column(position))
                if not (np.array_equal(decoded, data) and np.array_equal(meet[ends], bounds)):
                    raise ValueError("ids that do not decode to their text")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(ends), pa.int64()), binary_rows(ids, ends)],
                                                 names=[*part.schema.names, "n_tokens", "ids"])
        auto.forget()
        auto.words.limit = WORD_CACHE

    schema = StructType([*docs.schema.fields, StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    return docs.mapInArrow(run, schema)
