"""Document quality from a linear-chain conditional random field over lines.

Each non-blank line is good or bad.  Its features describe its own text and that of the lines before and
after it; the chain adds weights for pairs of neighbouring labels.  Forward-backward gives the marginal of
every line, and a document's score is the mean of these, weighted by line length.

Labels are known per document.  A first fit without the chain takes over the document's label for all of
its lines; lines of bad documents that it finds good are then relabelled, and the chain is fitted on that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import words as W
from .bpe import forget, slices

FIT_LINES, RUN = 120, 40  # lines of a document that the fit reads, and of one run of them
THRESHOLD = 0.7
PART_BYTES = 1 << 20
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC3:0xF5] = True  # lead bytes: one per character
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_SIGN[[ord(c) for c in ".,;:'()-\"?"]] = False  # ordinary punctuation
OWN_FEATURES = 12


def line_features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every non-blank line (itself, before, after), its bytes, and each row's offsets of lines."""
    data, off = W.text_bytes(texts)
    starts, ends, row_off = W.word_spans(data, off)
    n = len(starts)
    if not n:
        return np.zeros((0, 3 * OWN_FEATURES)), np.zeros(0), np.zeros(len(off), np.int64)
    names = W.word_names(data, starts, ends)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask, dtype=np.int64))
        return (total[ends] - total[starts]).astype(float)

    # Capitals of Latin-1 letters are 0xC3 and 0x80-0x9E.
    upper = _UPPER[data].copy()
    upper[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    per_word = {
        "bytes": (ends - starts).astype(float), "letters": count(_LETTER[data]), "upper": count(upper), "digits": count(_DIGIT[data]), "signs": count(_SIGN[data]),
        "bare": (count(_LETTER[data]) + count(_DIGIT[data]) == 0).astype(float),
    }
    last = ends - 1
    before = np.maximum(last - 1, 0)
    per_word["tail"] = ((ends - starts > 2) & _SIGN[data[last]] & _SIGN[data[before]]).astype(float)
    # Lines: words between line ends; a row's first word begins one.
    breaks = np.append(0, np.cumsum(data == 10, dtype=np.int64))
    head = np.append(True, breaks[starts[1:]] > breaks[starts[:-1]])
    head[row_off[:-1][row_off[:-1] < n]] = True
    first = np.flatnonzero(head)
    same = np.zeros(n)
    same[1:] = (names[1:] == names[:-1]) & ~head[1:]
    two = np.zeros(n)
    two[2:] = (names[2:] == names[:-2]) & ~head[2:] & ~head[1:-1]
    s = {k: np.add.reduceat(v, first) for k, v in {**per_word, "same": same, "two": two}.items()}
    words = np.diff(np.append(first, n)).astype(float)
    line_off = np.searchsorted(first, row_off)
    # A line that occurred before in its document.
    text_name = np.add.reduceat(W.mix(names + (np.arange(n) - np.repeat(first, words.astype(int))).astype(W.U), 3), first)
    row = np.repeat(np.arange(len(off) - 1), np.diff(line_off))
    order = np.lexsort((np.arange(len(first)), text_name, row))
    again = np.zeros(len(first))
    again[order[1:]] = (text_name[order[1:]] == text_name[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    size, letters = s["bytes"], np.maximum(s["letters"], 1)
    own = np.stack(
        [
            np.log1p(words) / 4, np.clip(s["upper"] - words, 0, None) / letters, s["signs"] / size, np.minimum(s["signs"] / size * 5, 1), s["digits"] / size,
            s["bare"] / words, np.minimum(s["bare"] / words * 5, 1), s["tail"] / words, np.minimum(s["tail"] / words * 3, 1), s["same"] / words, np.minimum((s["same"] + s["two"]) / words * 2, 1), again,
        ],
        axis=1,
    )
    prev, nxt = np.zeros_like(own), np.zeros_like(own)
    inner = row[1:] == row[:-1]
    prev[1:][inner], nxt[:-1][inner] = own[:-1][inner], own[1:][inner]
    return np.hstack([own, prev, nxt]), size, line_off


def marginals(emit: np.ndarray, pair: np.ndarray, off: np.ndarray, counts: bool = False):
    """P(good) of every line by forward-backward, and with ``counts`` the expected number of label pairs.
    ``emit`` is the score of good over bad; all rows advance together, longest first."""
    rows = np.argsort(-np.diff(off), kind="stable")
    length, at = np.diff(off)[rows], off[:-1][rows]
    steps = int(length.max(initial=0))
    e = np.stack([np.zeros_like(emit), emit], axis=1)
    e = np.exp(e - e.max(axis=1, keepdims=True))
    t = np.exp(pair - pair.max())
    fwd, back = np.zeros_like(e), np.ones_like(e)
    live = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")  # rows with at least k lines
    for k in range(steps):
        i = at[: live[k]] + k
        a = e[i] if k == 0 else (fwd[i - 1] @ t) * e[i]
        fwd[i] = a / a.sum(axis=1, keepdims=True)
    for k in range(steps - 2, -1, -1):
        i = at[: live[k + 1]] + k
        b = (e[i + 1] * back[i + 1]) @ t.T
        back[i] = b / b.sum(axis=1, keepdims=True)
    p = fwd * back
    p = (p / p.sum(axis=1, keepdims=True))[:, 1]
    if not counts:
        return p, None
    inner = np.ones(len(emit), bool)
    inner[off[1:][np.diff(off) > 0] - 1] = False
    i = np.flatnonzero(inner)
    both = fwd[i][:, :, None] * t[None] * (e[i + 1] * back[i + 1])[:, None, :]
    return p, (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def fit(x: np.ndarray, label: np.ndarray, weight: np.ndarray, off: np.ndarray, chain: bool, rounds: int = 400, decay: float = 1e-6):
    """Weights of the features (last: constant) and of label pairs, by Adam on the penalised likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))])
    theta, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    inner = np.ones(len(x), bool)
    inner[off[1:][np.diff(off) > 0] - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[i].astype(int), label[i + 1].astype(int)), 1)
    for step in range(1, rounds + 1):
        emit, pair = x @ theta[:-4], theta[-4:].reshape(2, 2)
        if chain:
            p, pairs = marginals(emit, pair, off, True)
            g_pair = (pairs - seen).ravel() / len(x)
            g = np.append(x.T @ (p - label) / len(x), g_pair)
        else:
            p = 1 / (1 + np.exp(-emit))
            g = np.append(x.T @ ((p - label) * weight) / weight.sum(), np.zeros(4))
        g += decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> dict:
    """Fit on at most ``per_class`` documents of each label, the first in the order of a hash of the doc_id, with
    crc32(doc_id) mod 4 other than 2.  Repeated labels of a doc_id count as their smallest; null labels do not
    count.  Without labels of both kinds every document gets the share of good labels (1 without any)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # An even sample in both classes, of bounded size; it is broadcast.
    first = [known.where(f"quality = {q}").orderBy(F.xxhash64("doc_id")).limit(per_class) for q in (0, 1)]
    share = known.agg(F.avg("quality")).first()[0]
    prior = 1.0 if share is None else float(share)
    sample = first[0].unionByName(first[1]).withColumnRenamed("doc_id", "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    # One text of each id, however many rows repeat it.
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "quality", "text")).alias("t")).select("doc_id", "t.quality", "t.text")

    def features(batches):
        forget()
        for batch in batches:
            for part in slices(batch, size=PART_BYTES):
                x, size, off = line_features(part.column("text"))
                x, size = x.astype(np.float32), size.astype(np.float32)
                rows = [(i, a + at, a + end) for i, (a, b) in enumerate(zip(off[:-1], off[1:])) for at, end in segments(b - a)]
                which = pa.array([i for i, _, _ in rows], pa.int64())
                cut = [pa.array([v[a:b].tobytes() for _, a, b in rows], pa.binary()) for v in (x, size)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(which), part.column("quality").take(which), *cut], names=["doc_id", "quality", "x", "size"])

    rows = sorted(texts.mapInArrow(features, "doc_id long, quality int, x binary, size binary").collect(), key=lambda r: (r["doc_id"], bytes(r["x"])))
    rows = [r for r in rows if len(r["x"])]
    model = {"prior": prior, "weights": None, "pair": None}
    if len({r["quality"] for r in rows}) < 2:
        return model
    x = np.concatenate([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(-1, 3 * OWN_FEATURES).astype(float)
    size = np.concatenate([np.frombuffer(r["size"], np.float32) for r in rows]).astype(float)
    lines = np.array([len(r["size"]) // 4 for r in rows])
    off = np.append(0, np.cumsum(lines))
    label = np.repeat([float(r["quality"]) for r in rows], lines)
    # Each class weighs the same in the first fit, each line by its length.
    weight = np.sqrt(size)
    for q in (0.0, 1.0):
        weight[label == q] /= weight[label == q].sum()
    w, _ = fit(x, label, weight, off, chain=False)
    good = (np.hstack([x, np.ones((len(x), 1))]) @ w) > 0
    label = np.where((label == 0) & good, 1.0, label)
    model["weights"], model["pair"] = fit(x, label, weight, off, chain=True)
    return model


def segments(lines: int) -> list[tuple[int, int]]:
    """The lines of a document that the fit reads: all, or evenly spaced runs of ``RUN`` lines, ``FIT_LINES`` in all."""
    if lines <= FIT_LINES:
        return [(0, lines)]
    starts = np.linspace(0, lines - RUN, FIT_LINES // RUN).round().astype(int).tolist()
    return [(a, a + RUN) for a in starts]


def held_out(c: str):
    return F.coalesce(F.crc32(F.col(c).cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, model: dict, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, and the columns named in ``carry`` as carried_0,
    carried_1, ... (their names may clash with the result's); see ``quality``."""
    extra = [f"carried_{i}" for i in range(len(carry))]

    # A carried text is sent once, for both uses.
    own = carry.index("text") if "text" in carry and docs.schema["text"].dataType == StringType() else None
    text = "text" if own is None else extra[own]

    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch, text, PART_BYTES):
                x, size, off = line_features(part.column(text))
                out = np.full(len(off) - 1, model["prior"])
                if model["weights"] is not None and len(x):
                    emit = x @ model["weights"][:-1] + model["weights"][-1]
                    p, _ = marginals(emit, model["pair"], off)
                    some = np.diff(off) > 0
                    total = np.append(0, np.cumsum(p * size)), np.append(0, np.cumsum(size))
                    top, low = (t[off[1:]] - t[off[:-1]] for t in total)
                    out[some] = np.clip(top[some] / low[some], 0, 1)
                predicted = (out >= THRESHOLD).astype(np.int32)
                made = [part.column("doc_id"), part.column("held_out"), pa.array(out), pa.array(predicted)]
                yield pa.RecordBatch.from_arrays([*made, *map(part.column, extra)], names=["doc_id", "held_out", "score", "predicted", *extra])

    columns = [F.col(c).alias(e) for c, e in zip(carry, extra)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), *([F.col("text").cast("string").alias("text")] if own is None else []), *columns)
    made = "doc_id long, held_out boolean, score double, predicted int" + "".join(f", {e} {docs.schema[c].dataType.simpleString()}" for c, e in zip(carry, extra))
    return rows.mapInArrow(run, made)


def quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """Score every document's quality.

    Input: ``doc_id``, ``text`` of the documents and ``doc_id``, ``quality`` of the labels (others are ignored,
    whatever their names).  One row per input row: doc_id, held_out (crc32 of the doc_id as text mod 4 is 2; a
    null doc_id is not held out), score, predicted (1 from a score of 0.7).  The fit reads at most ``per_class``
    labelled documents of each class and ``FIT_LINES`` lines of each (runs spread over the whole text); scores read
    every line.  Null, empty and blank texts have no
    lines and get the share of good labels.  Repeated rows are scored each; an empty table gives an empty table.
    """
    return score(docs, train(docs, labels, per_class))
