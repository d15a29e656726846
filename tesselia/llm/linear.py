"""Sparse binary features from token hashes and small logistic models, trained on the driver from bounded samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ascii_lower, map_arrow, pick, slices, span_hashes, utf8_buffers

#: Class of each byte: 0 white space and controls, 1 letters, digits and bytes of other scripts, 2 marks.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 2
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _CLASS[_a:_b] = 1


def token_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one class, white space left out: starts, ends and each run's text."""
    kind = _CLASS[raw]
    cut = np.zeros(len(raw) + 1, np.bool_)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[0] = cut[-1] = True
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def token_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = token_spans(raw, np.array([0, len(raw)]))
    return span_hashes(raw, s, e)


def features(batch: pa.RecordBatch, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct token of each row of a small batch."""
    raw, offsets = utf8_buffers(batch.column("text"))
    raw = ascii_lower(raw) if lower else raw
    s, e, doc = token_spans(raw, offsets)
    return doc, span_hashes(raw, s, e)


def distinct(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.ones(len(doc), np.bool_)
    first[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[first], key[first]


class Vocabulary:
    """Sorted hashes with a bit table in front, so that most tokens cost one lookup."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(np.uint64))
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def index(self, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of the tokens that are features, each once a row."""
        some = self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
        doc, h = doc[some], h[some]
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        some = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), np.bool_)
        return distinct(doc[some], at[some])


def sample_labels(labels: DataFrame, column: str, most: int, where=None) -> DataFrame:
    """At most ``most`` labelled ids in the order of a hash of the id; of several labels for an id the largest."""
    rows = pick(labels, "doc_id", column, doc_id="long", **{column: "int"}).filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    rows = rows.filter(where) if where is not None else rows
    return rows.groupBy("doc_id").agg(F.max(column).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def gather(docs: DataFrame, lower: bool, keep: list[str] = ()) -> list[dict]:
    """Rows of a bounded DataFrame with their distinct token hashes. ``docs`` needs doc_id, text and ``keep``."""

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for part in slices(batch):
                doc, h = distinct(*features(part, lower))
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                found += [h[at[i] : at[i + 1]].tobytes() for i in range(part.num_rows)]
            return pa.RecordBatch.from_arrays([*(batch.column(k) for k in ["doc_id", *keep]), pa.array(found, pa.binary())], ["doc_id", *keep, "hashes"])

        return f

    kinds = dict(docs.dtypes)
    rows = map_arrow(docs, make, ", ".join(f"`{k}` {kinds[k]}" for k in ["doc_id", *keep]) + ", hashes binary")
    return sorted((r.asDict() for r in rows.collect()), key=lambda r: (r["doc_id"], r["hashes"]))


def choose(rows: list[np.ndarray], y: np.ndarray, most: int, least: int = 3, always: np.ndarray | None = None) -> Vocabulary:
    """The hashes that tell the labels apart best: by the chi-square of presence, at least ``least`` rows each."""
    if not rows or not sum(map(len, rows)):
        return Vocabulary(np.zeros(0, np.uint64))
    h = np.concatenate(rows)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    u, inv, n = np.unique(h, return_inverse=True, return_counts=True)
    pos = np.bincount(inv, weights=y[doc], minlength=len(u))
    rate = y.mean()
    chi = (pos - n * rate) ** 2 / (n * rate * (1 - rate) + 1e-9)
    chi[n < least] = -1
    best = np.argsort(-chi, kind="stable")[:most]
    best = u[best[chi[best] > 0]]
    return Vocabulary(np.concatenate([best, always]) if always is not None else best)


def matrix(rows: list[np.ndarray], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, int]:
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return *vocab.index(doc, np.concatenate(rows) if rows else np.zeros(0, np.uint64)), len(rows)


def fit(x: tuple[np.ndarray, np.ndarray, int], y: np.ndarray, width: int, l2: float = 1e-3, steps: int = 300, penalty=None) -> np.ndarray:
    """Logistic regression by Adam over the whole batch; the last weight is the bias. ``penalty(w)`` adds a gradient."""
    doc, col, n = x
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    rate = min(max(y.mean() if n else 0.5, 1e-3), 1 - 1e-3)
    w[-1] = np.log(rate / (1 - rate))
    for t in range(1, steps + 1 if n else 1):
        g = sigmoid(logits(x, w)) - y
        grad = np.empty(width + 1)
        grad[:-1] = np.bincount(col, weights=g[doc], minlength=width)[:width] / n + l2 * w[:-1]
        grad[-1] = g.mean()
        if penalty is not None:
            grad[:-1] += penalty(w[:-1])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def logits(x: tuple[np.ndarray, np.ndarray, int], w: np.ndarray) -> np.ndarray:
    return np.bincount(x[0], weights=w[x[1]], minlength=x[2])[: x[2]] + w[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
