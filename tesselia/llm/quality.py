"""Document quality by co-training two views.

The content view sees a text's words and marks, and measures of it in buckets (size, lines, shares of character classes). The metadata view sees
only what the page states about itself: language, source and length. Each view's classifier is trained on the
labelled rows; over ``rounds`` each hands its confident labels for unlabelled rows to the other. Both are then calibrated
on labelled rows kept aside, and a stacked logistic model of the two calibrated views scores all documents.

Training uses at most ``max_rows`` labelled rows and a pool of ``max_pool`` documents without a label, each in the order of a hash of the id; scoring
reads whole texts of all rows, however long, without a shuffle. Null text is empty, null metadata a bucket of its own. With fewer than 10
labelled rows, or labels all alike, there is no model: every document scores 1 and is kept. Repeated rows each get
their score; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import DOC_COLUMNS, filter_by, map_arrow, mix64, pick, slices, utf8_buffers
from .linear import Vocabulary, choose, features, fit, gather, logits, matrix, sample_labels, sigmoid

#: Buckets a measure of the text; measures: size, lines, mean line, mean word, shares of capitals, marks, digits, repeated marks.
_BUCKETS, _MEASURES = 12, 8
#: Buckets of the page's length (one for null) and of each of its two names.
_LENGTHS, _NAMES = 40, 256
META_WIDTH, META_FIELDS = _LENGTHS + 2 * _NAMES, 3


def text_measures(batch: pa.RecordBatch) -> np.ndarray:
    """Content view beside the tokens: one feature number a measure of each row."""
    raw, offsets = utf8_buffers(batch.column("text"))
    size = np.diff(offsets).astype(float)

    def total(mask: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (s[offsets[1:]] - s[offsets[:-1]]).astype(float)

    lines = total(raw == 10) + 1
    gaps = total((raw == 32) | (raw == 10)) + 1
    upper, digit = total((raw >= 65) & (raw <= 90)), total((raw >= 48) & (raw <= 57))
    mark = (raw > 32) & (raw < 127) & ~((raw >= 48) & (raw <= 57)) & ~(((raw | 32) >= 97) & ((raw | 32) <= 122))
    twice = np.zeros(len(raw), np.bool_)
    twice[1:] = mark[1:] & (raw[1:] == raw[:-1])
    share = lambda x: np.floor(np.log2(1 + 1000 * x / np.maximum(size, 1)))
    measures = [np.log2(1 + size) / 1.5, np.log2(lines), np.log2(1 + size / lines), 2 * np.log2(1 + size / gaps), share(upper), share(total(mark)), share(digit), share(total(twice))]
    return np.stack([np.clip(m, 0, _BUCKETS - 1).astype(np.int64) + i * _BUCKETS for i, m in enumerate(measures)], 1)


def page_view(batch: pa.RecordBatch) -> np.ndarray:
    """Metadata view: feature numbers of a row's length, language and source, as the page states them. Nothing of the text."""
    chars = batch.column("n_chars").to_pylist()
    cols = [np.array([0 if c is None else 1 + min(_LENGTHS - 2, int(2 * np.log2(1 + max(0, c)))) for c in chars], np.int64)]
    for k, name in enumerate(("lang", "source")):
        values = batch.column(name).to_pylist()
        known = {v: 0 if v is None else int.from_bytes(hashlib.blake2b(("=" + str(v)).encode(), digest_size=8).digest(), "little") for v in set(values)}
        h = np.array([known[v] for v in values], np.uint64)
        cols.append((mix64(h) & np.uint64(_NAMES - 1)).astype(np.int64) + _LENGTHS + _NAMES * k)
    return np.stack(cols, 1)


def content(rows: tuple[np.ndarray, np.ndarray], measures: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and features of the content view: ``words`` tokens, then the measures."""
    n, k = measures.shape
    return np.concatenate([rows[0], np.repeat(np.arange(n), k)]), np.concatenate([rows[1], words + measures.ravel()]), n


class QualityModel:
    """Weights of both views and of the stacked model: a, b (calibration of each view) and c (stack)."""

    def __init__(self, vocab: Vocabulary, text: np.ndarray, meta: np.ndarray, scales: np.ndarray):
        self.vocab, self.text, self.meta, self.scales = vocab, text, meta, scales

    def combine(self, zt: np.ndarray, zm: np.ndarray) -> np.ndarray:
        s = self.scales
        return sigmoid(s[4] * (s[0] * zt + s[1]) + s[5] * (s[2] * zm + s[3]) + s[6])

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        out = []
        for part in slices(batch):
            zt = logits(content(self.vocab.index(*features(part, False)), text_measures(part), len(self.vocab.hashes)), self.text)
            out.append(self.combine(zt, self.meta[page_view(part)].sum(1) + self.meta[-1]))
        return np.concatenate(out) if out else np.zeros(0)


def _docs(docs: DataFrame) -> DataFrame:
    d = pick(docs, *DOC_COLUMNS, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    return d.withColumn("text", F.coalesce("text", F.lit("")))


def _with_view(docs: DataFrame) -> DataFrame:
    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            view = np.concatenate([np.concatenate([text_measures(p), page_view(p)], 1) for p in slices(batch)])
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("label"), pa.array(list(view.astype(np.int32)), pa.list_(pa.int32()))], ["doc_id", "text", "label", "view"])

        return f

    return map_arrow(docs, make, "doc_id long, text string, label int, view array<int>")


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that calibrate logits, by Newton's method with targets off 0 and 1."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.stack([z, np.ones(len(z))], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, x.T @ (p - t) + 1e-3 * (w - [1, 0])), -2, 2)
    return float(w[0]), float(w[1])


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_pool: int) -> DataFrame:
    """doc_id and label of the labelled rows to train on, and with a null label the pool: documents without any label."""
    known = sample_labels(labels, label, max_rows)
    named = pick(labels, "doc_id", label, doc_id="long", **{label: "int"}).filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    free = filter_by(pick(docs, "doc_id", doc_id="long").filter("doc_id is not null"), named, ["doc_id"], "left_anti")
    pool = free.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_pool)
    return known.withColumn("label", F.col("label").cast("int")).union(pool.withColumn("label", F.lit(None).cast("int")))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 6000, max_pool: int = 3000, rounds: int = 3, sure: float = 0.97, width: int = 4096) -> QualityModel | None:
    chosen = sample_rows(docs, labels, label, max_rows, max_pool)
    rows = gather(_with_view(_docs(docs).join(F.broadcast(chosen), "doc_id")), False, ["label", "view"])
    known = [r for r in rows if r["label"] is not None]
    pool = [r for r in rows if r["label"] is None]
    y = np.array([r["label"] for r in known], float)
    if len(known) < 10 or y.min() == y.max():
        return None
    hashes = lambda rs: [np.frombuffer(r["hashes"], np.uint64) for r in rs]
    views = lambda rs: np.array([r["view"] for r in rs], np.int64).reshape(len(rs), _MEASURES + META_FIELDS)
    aside = np.arange(len(known)) % 5 == 0
    vocab = choose([h for h, a in zip(hashes(known), aside) if not a], y[~aside], width)
    words = len(vocab.hashes)

    def text_x(h: list[np.ndarray], v: np.ndarray):
        return content(matrix(h, vocab)[:2], v[:, :_MEASURES], words)

    def meta_x(v: np.ndarray):
        return np.repeat(np.arange(len(v)), META_FIELDS), v[:, _MEASURES:].ravel(), len(v)

    own = [r for r, a in zip(known, aside) if not a]
    th, tv, ty = hashes(own), views(own), y[~aside]
    ph, pv = hashes(pool), views(pool)
    extra_t, extra_m = np.full(len(pool), np.nan), np.full(len(pool), np.nan)
    for r in range(rounds + 1):
        t_rows, m_rows = ~np.isnan(extra_t), ~np.isnan(extra_m)
        xt = text_x(th + [h for h, k in zip(ph, t_rows) if k], np.concatenate([tv, pv[t_rows]]))
        wt = fit(xt, np.concatenate([ty, extra_t[t_rows]]), words + _MEASURES * _BUCKETS, 1e-3, 150)
        wm = fit(meta_x(np.concatenate([tv, pv[m_rows]])), np.concatenate([ty, extra_m[m_rows]]), META_WIDTH, 1e-3, 150)
        if r == rounds or not pool:
            break
        pt, pm = sigmoid(logits(text_x(ph, pv), wt)), sigmoid(logits(meta_x(pv), wm))
        extra_m = np.where(pt > sure, 1.0, np.where(pt < 1 - sure, 0.0, np.nan))
        extra_t = np.where(pm > sure, 1.0, np.where(pm < 1 - sure, 0.0, np.nan))
    test = [r for r, a in zip(known, aside) if a]
    zt, zm, y_test = logits(text_x(hashes(test), views(test)), wt), logits(meta_x(views(test)), wm), y[aside]
    at, bt = _platt(zt, y_test)
    am, bm = _platt(zm, y_test)
    a, b = _platt((at * zt + bt + am * zm + bm) / 2, y_test)
    return QualityModel(vocab, wt, wm, np.array([at, bt, am, bm, a / 2, a / 2, b]))


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.5, keep_columns: bool = False) -> DataFrame:
    """doc_id, score and kept; with ``keep_columns`` the rows of ``docs`` that stay, as they were."""
    own = pick(docs, *DOC_COLUMNS) if keep_columns else _docs(docs)
    if model is None:
        return own if keep_columns else own.select("doc_id", F.lit(1.0).alias("score"), F.lit(True).alias("kept"))
    sent = docs.sparkSession.sparkContext.broadcast((model.vocab.hashes, model.text, model.meta, model.scales))

    def make():
        m = QualityModel(Vocabulary(sent.value[0]), *sent.value[1:])

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            if not keep_columns:
                s = m.score(batch)
                return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array(s >= threshold)], ["doc_id", "score", "kept"])
            text = batch.column("text").fill_null("")
            s = m.score(pa.RecordBatch.from_arrays([text, *(batch.column(k) for k in ("lang", "source", "n_chars"))], ["text", "lang", "source", "n_chars"]))
            return batch.filter(pa.array(s >= threshold))

        return f

    schema = ", ".join(f"`{k}` {t}" for k, t in own.dtypes) if keep_columns else "doc_id long, score double, kept boolean"
    return map_arrow(own, make, schema)
