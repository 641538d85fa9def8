"""Quality scores by Bradley-Terry pairwise ranking.

Every text becomes a short vector of figures. Each labelled good and each labelled bad document
form a preference pair, and the weights minimise the mean logistic loss on the differences of
the two vectors over all of these pairs: P(good beats bad) = 1 / (1 + exp(-w.(x_good - x_bad))). The
score of a document is w.x; the threshold is the quantile of the training documents' scores at the
share of bad ones among them. The returned score is the logistic of the distance from that
threshold, shifted so that the threshold itself scores THRESHOLD.

The figures are computed over whole texts of all documents, once. All labelled rows are learnt from, none is
drawn: a Newton step needs the sums over all good x bad pairs, and the loss of a pair depends on its two scores
only, so the tasks add up number, vectors and their products of the rows in bins of the score, BIN wide, and the
driver combines the bins of both classes at the mean scores of their rows. The bins of good and bad rows, 2 * BINS at most,
are all that reaches the driver. The threshold lies between two ranks of the scores of all training rows, which
are found exactly by counting rows between bounds that close in.

Null and empty texts have a vector of zeros and are scored like others. Labels other than 0
and 1 and labels without a document are ignored; a document labelled twice counts twice in
training. Repeated rows are scored each. Without a label of both classes every score is 0.5.
Other columns are not read.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import pick, ship, written

THRESHOLD = 0.3
L2 = 1e-3
#: Newton steps at most, and the change of a weight that makes a step the last one.
STEPS = 30
SMALL = 1e-3
#: Width of a bin of scores and bins of a class; the rows beyond are in the first and the last one.
BIN = 0.1
BINS = 160
#: Parts that a pass cuts the range of a rank into.
PARTS = 1024

FEATURES = ("log_words", "word_length", "symbols", "bars", "shouts", "capitals", "digits", "stops", "neighbours",
            "distinct", "repeated_lines", "short")

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&<>@^~=_{}[]\\"


def vector(text: str | None) -> list[float]:
    """FEATURES of a text. Shares are of words, capitals and digits of bytes."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))

    def share(characters: bytes) -> float:
        return (len(data) - len(data.translate(None, characters))) / n

    lines = [x for x in data.split(b"\n") if x.strip()]
    return [math.log1p(n), min(size / n, 20.0), min(share(_SYMBOLS), 3.0), min(share(b"|"), 1.0), min(share(b"!"), 2.0),
            (size - len(data.translate(None, _UPPER + b" \t\n\x0b\x0c\r"))) / size,
            (size - len(data.translate(None, _DIGITS + b" \t\n\x0b\x0c\r"))) / size, min(share(b".,;:"), 1.0),
            sum(map(eq, words, words[1:])) / n, len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
            1.0 if n < 20 else 0.0]


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = [vector(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return rows.mapInArrow(run, f"doc_id {kind}, x array<double>")


def _bins(train: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> list:
    """(label, bin, sums) of the training rows: their number, centred vectors and products of these, added up."""
    size = len(w)
    upper = np.triu_indices(size)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            label = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            x = (batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) - mean) / scale
            at = label * BINS + np.clip(np.floor(x @ w / BIN) + BINS // 2, 0, BINS - 1).astype(np.int64)
            rows = np.concatenate([np.ones((len(x), 1)), x, x[:, upper[0]] * x[:, upper[1]]], 1)
            order = np.argsort(at, kind="stable")
            seen, first = np.unique(at[order], return_index=True)
            sums = np.add.reduceat(rows[order], first)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(list(sums), pa.list_(pa.float64()))], names=["at", "s"])

    parts = train.select(F.col("label").cast("long"), "x").mapInArrow(run, "at long, s array<double>")
    summed = (parts.select("at", F.posexplode("s").alias("k", "v")).groupBy("at", "k").agg(F.sum("v").alias("v"))
              .orderBy("at", "k").toArrow())
    at, v = summed["at"].to_numpy(), summed["v"].to_numpy().reshape(-1, 1 + size + len(upper[0]))
    return [(int(a) // BINS, int(a) % BINS, sums) for a, sums in zip(at[::v.shape[1]], v)]


def _newton(bins: list, w: np.ndarray) -> tuple[float, np.ndarray]:
    """(loss, step) of the mean loss over all good x bad pairs at ``w``; a pair counts with the mean scores of its bins."""
    size = len(w)
    upper = np.triu_indices(size)
    n, x, xx, s = {}, {}, {}, {}
    for label in (0, 1):
        sums = np.array([b[2] for b in bins if b[0] == label])
        n[label], x[label] = sums[:, 0], sums[:, 1:1 + size]
        xx[label] = np.zeros((len(sums), size, size))
        xx[label][:, upper[0], upper[1]] = xx[label][:, upper[1], upper[0]] = sums[:, 1 + size:]
        s[label] = x[label] @ w / n[label]
    pairs = n[1].sum() * n[0].sum()
    gap = s[1][:, None] - s[0][None, :]
    wrong = 1 / (1 + np.exp(np.clip(gap, -500, 500)))  # probability of the wrong order
    loss = n[1] @ np.logaddexp(0, -gap) @ n[0] / pairs + L2 / 2 * w @ w
    slope = L2 * w - ((wrong @ n[0]) @ x[1] - (n[1] @ wrong) @ x[0]) / pairs
    v = wrong * (1 - wrong)
    cross = x[1].T @ v @ x[0]
    bend = (np.tensordot(v @ n[0], xx[1], 1) + np.tensordot(n[1] @ v, xx[0], 1) - cross - cross.T) / pairs
    return float(loss), -np.linalg.solve(bend + L2 * np.eye(size), slope)


def fit(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(mean, w): weights of the centred figures, from all rows (label, x) of both classes."""
    size = len(FEATURES)
    at = [F.col("x")[k] for k in range(size)]
    mean = np.array(train.agg(*[F.avg(c) for c in at]).first(), float)
    var = train.agg(*[F.avg((c - F.lit(float(m))) * (c - F.lit(float(m)))) for c, m in zip(at, mean)]).first()
    scale = np.sqrt(np.array(var, float))
    scale[scale < 1e-9] = 1.0
    w, step, best, part = np.zeros(size), np.zeros(size), math.inf, 1.0
    for _ in range(STEPS):
        loss, following = _newton(_bins(train, mean, scale, w + part * step), w + part * step)
        if loss > best + 1e-9 and part > 1e-3:  # too far: half the way
            part /= 2
            continue
        w, step, best, part = w + part * step, following, loss, 1.0
        if np.abs(step).max() < SMALL:
            w = w + step
            break
    # Sums of doubles depend on the order of tasks in their last digits.
    return mean, np.array([float(f"{v:.9g}") for v in w / scale])


def rank_value(values: DataFrame, rank: int) -> float:
    """The value at ``rank`` (from 0) of the sorted column ``v`` of doubles: exact, by passes that count the rows below,
    between and above bounds that close in on it; PARTS counts reach the driver in a pass."""
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        width = (hi - lo) / PARTS
        part = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(PARTS - 1)) if width > 0 else F.lit(0)
        counted = (values.where(F.col("v").between(lo, hi)).groupBy(part.alias("part"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("part").collect())
        below = values.where(F.col("v") < F.lit(lo)).count()
        for row in counted:
            if below + row.n > rank:
                break
            below += row.n
        if (row.lo, row.hi) == (lo, hi):  # two neighbouring doubles
            return lo if below + values.where(F.col("v") == F.lit(lo)).count() > rank else hi
        lo, hi = row.lo, row.hi
    return lo


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score) of every row; labels of held-out rows are not learnt from."""
    x = written(vectors(docs, id_col, text_col))
    known = pick(labels, doc_id=label_id_col, label=label_col).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    train = written(known.join(x, "doc_id"))
    counts = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    score = F.lit(0.5)
    if counts.get(0) and counts.get(1):
        mean, w = fit(train)
        s = F.aggregate(F.zip_with("x", F.array(*[F.struct(F.lit(float(a)).alias("m"), F.lit(float(b)).alias("w"))
                                                  for a, b in zip(mean, w)]),
                                   lambda v, p: (v - p["m"]) * p["w"]), F.lit(0.0), lambda a, v: a + v)
        raw = written(train.select(s.alias("v")))
        cut = (rank_value(raw, counts[0] - 1) + rank_value(raw, counts[0])) / 2
        score = 1 / (1 + F.exp(-(s - F.lit(cut) + F.lit(math.log(THRESHOLD / (1 - THRESHOLD))))))
    return x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
