"""Secret scan: key formats by pattern, and random-looking strings by windowed entropy.

Base kinds, leftmost non-overlapping matches over the whole text, each kind by itself:
``assign`` (a named credential with a value of 6 characters or more), ``access`` (an access
key id of 20 or more) and ``hex`` (24 or more lower-case hex digits).

The entropy kinds look at candidate strings, the maximal runs of URL-safe and standard
base64 characters, 20 or longer. A window's character class (all hex digits, or mixed)
sets the entropy a window of 20 characters must reach, so that a hex key is found after a
name, a path or "0x" as it is alone. The counts of a window are kept up
as it slides: one character enters, one leaves, and only their two terms of the sum
c*log2(c) change. Windows that reach the limit are merged into spans (``hex_entropy``,
``base64_entropy``), and these reach to both ends of the run of hex digits, or of letters and digits,
that they lie in, so that a masked key leaves no ends. The allow-list suppresses what is random-looking but known to be
harmless, by the part that holds the window: for hex windows the stretch between separators
and the run of hex digits in it, for others the whole candidate and, within it, the side of
an equals sign. Of a placeholder (``example``, ``xxxx``) only itself is left out: a key beside it is
judged as if it stood alone. Entropy spans are added; base spans always stay.

Null text is read as empty: no spans (``redact`` leaves null text null). Every row is
scanned by itself, so ties and repeated rows each get their spans; other columns are not read. A very
long text is scanned whole, in one task. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import pick, ship

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "hex_entropy", "base64_entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_RUN = re.compile(r"[0-9a-fA-F]{20,}")
#: A part of a candidate between separators, and a side of an equals sign with its padding.
PART = re.compile(r"[^/_=+-]{20,}")
SIDE = re.compile(r"[^=]{20,}=*")
#: Bits per character a window must reach, by its character class.
MIN_ENTROPY = {"hex_entropy": 3.0, "base64_entropy": 3.9}

#: Allow-list: candidates and parts of them that match one of these as a whole are not secrets.
ALLOW = (
    r"[A-Za-z/_=+-]+",                                        # no digit: words, paths, rulers
    r"[0-9/_=+-]+",                                           # no letter: numbers, dates
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",    # UUID
    r"(?:[A-Za-z]*[/_-])*[A-Za-z]*\d{1,4}",                   # a path or name with a number at its end
    r"(?:[A-Za-z]*\d{0,4}[a-z]?[/_-])+[A-Za-z]*\d{0,4}[a-z]?",  # the same with numbers in its parts
)
#: Placeholders: only they are left out, what stands beside them is judged by itself.
PLACEHOLDER = re.compile(r"EXAMPLE|example|x{4,}|X{4,}")

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def entropy_windows(s: str, least: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Merged (start, end) of the ``width``-character windows of ``s`` whose Shannon entropy,
    in bits per character, is ``least`` or more."""
    term = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []  # total: sum of c*log2(c) over the window's characters
    most = (math.log2(width) - least) * width + 1e-9
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= width:
            old = s[i - width]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        if i >= width - 1 and total <= most:
            start = i - width + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def _whole(s: str, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The windows with the rest of the letters, digits and plus signs that they are in the middle of; merged."""
    out: list[tuple[int, int]] = []
    for a, b in windows:
        while a and (s[a - 1].isalnum() or s[a - 1] == "+"):
            a -= 1
        while b < len(s) and (s[b].isalnum() or s[b] == "+"):
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _mixed(s: str, allow: re.Pattern) -> list[tuple[int, str]]:
    """(place, part) of a candidate to be judged by mixed windows: all of it, or the sides of its equals signs
    if it is allowed as a whole or holds a placeholder, which itself is left out."""
    if PLACEHOLDER.search(s):
        at, parts = 0, []
        for m in [*PLACEHOLDER.finditer(s), None]:
            end = m.start() if m else len(s)
            parts += [(at + x.start(), x[0]) for x in SIDE.finditer(s[at:end])]
            at = m.end() if m else at
        return [x for x in parts if not allow.fullmatch(x[1])]
    if not allow.fullmatch(s):
        return [(0, s)]
    # An allowed candidate can still hold a value that is not.
    return [(x.start(), x[0]) for x in SIDE.finditer(s) if not allow.fullmatch(x[0])]


def find_spans(text: str, allow: re.Pattern) -> list[tuple[str, int, int]]:
    """All spans of one text, by start and then kind; offsets in code points, end exclusive."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        s, at = m[0], m.start()
        for part in PART.finditer(s):
            if allow.fullmatch(part[0]):
                continue
            for run in HEX_RUN.finditer(s, part.start(), part.end()):
                # A run with one window that reaches the limit is a key from end to end.
                if not allow.fullmatch(run[0]) and entropy_windows(run[0], MIN_ENTROPY["hex_entropy"]):
                    found.append(("hex_entropy", at + run.start(), at + run.end()))
        if not s.strip("0123456789abcdefABCDEF"):
            continue
        found += [("base64_entropy", at + start + a, at + start + b) for start, x in _mixed(s, allow)
                  for a, b in _whole(x, entropy_windows(x, MIN_ENTROPY["base64_entropy"]))]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """(doc_id, spans): the spans of every row's text. No shuffle."""
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    pattern = "|".join(f"(?:{p})" for p in allow) or r"(?!)"
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        compiled = re.compile(pattern, re.DOTALL)
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t or "", compiled)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], names=["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPAN_TYPE}")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mask`` (overlapping spans by one);
    all columns and rows stay. No shuffle."""
    ship(docs.sparkSession)
    position = docs.columns.index(text_col)
    pattern = "|".join(f"(?:{p})" for p in allow) or r"(?!)"

    def run(batches):
        compiled = re.compile(pattern, re.DOTALL)
        for batch in batches:
            texts = []
            for text in batch.column(position).to_pylist():
                spans = find_spans(text, compiled) if text else []
                parts, at = [], 0
                for _, a, b in spans:
                    if a >= at:
                        parts += [text[at:a], mask]
                    at = max(at, b)
                texts.append("".join(parts) + text[at:] if parts else text)
            columns = list(batch.columns)
            columns[position] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
