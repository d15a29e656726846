"""Toxicity: a logistic classifier over words, regularised by counterfactuals.

In labelled texts that mention a group, the identity term is swapped for each other term, or left out, and the
change of the score's logit is penalised. Terms that only co-occur with toxic texts so lose their weight, and neutral
mentions of a group don't raise the score.

Labels are learned from rows that the caller's condition admits, at most ``max_rows`` of them, taken in the order of a
hash of the id; this bound holds for training only. Scoring reads whole texts of all rows, one lookup a
token, without a shuffle. The model that is sent to executors has a fixed size. Null and empty texts score as the bias
does; without any labels the score is 0.5 before thresholding. Repeated rows each get their score; an empty table gives no rows;
other columns may have any names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow, slices, texts
from .linear import Vocabulary, choose, features, fit, gather, logits, matrix, sample_labels, sigmoid, token_hashes

#: Group mentions that are swapped for each other, in the corpus's languages (en, de, fr, es). Fixed values.
IDENTITY_TERMS = (
    "asian", "black", "blind", "christian", "deaf", "disabled", "female", "gay", "hindu", "immigrant", "jewish", "lesbian",
    "male", "man", "men", "muslim", "refugee", "trans", "white", "woman", "women",
    "asiatisch", "behindert", "christlich", "frau", "frauen", "jüdisch", "lesbisch", "mann", "muslimisch", "männer", "schwul",
    "asiatique", "chrétien", "femme", "femmes", "handicapé", "homme", "hommes", "juif", "lesbienne", "musulman", "noir",
    "asiático", "cristiano", "discapacitado", "hombre", "hombres", "judío", "lesbiana", "mujer", "mujeres", "musulmán",
)


@lru_cache(maxsize=1)
def identity_hashes() -> np.ndarray:
    return np.array([token_hashes(t)[0] for t in IDENTITY_TERMS], np.uint64)


class ToxicModel:
    def __init__(self, vocab: Vocabulary, weights: np.ndarray):
        self.vocab, self.weights = vocab, weights

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        out = [sigmoid(logits((*self.vocab.index(*features(p, True)), p.num_rows), self.weights)) for p in slices(batch)]
        return np.concatenate(out) if out else np.zeros(0)


def swap_penalty(x: tuple[np.ndarray, np.ndarray, int], identity: np.ndarray, strength: float):
    """Gradient of the mean squared change of the logit when a mentioned identity term is swapped or left out."""
    n = max(1, x[2])
    mentions = np.bincount(x[1], minlength=int(identity.max(initial=0)) + 1)[identity].astype(float) / n

    def grad(w: np.ndarray) -> np.ndarray:
        own = w[identity]
        diff = own[:, None] - np.append(own, 0.0)[None, :]  # the last column: the term left out
        g = np.zeros(len(w))
        share = strength * mentions[:, None] * diff / (len(own) or 1)
        g[identity] += 2 * share.sum(1) - 2 * share[:, :-1].sum(0)
        return g

    return grad


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, label: str = "toxic", max_rows: int = 6000, width: int = 128, swap: float = 30.0, l2: float = 1e-5) -> ToxicModel:
    """``where`` is a condition on ``doc_id`` of the labelled rows that may be learned from.

    ``width`` and ``l2`` have the smallest log loss of a cross-validation over the three training folds of the contract.
    """
    chosen = sample_labels(labels, label, max_rows, where)
    rows = gather(texts(docs).join(F.broadcast(chosen), "doc_id"), True, ["label"])
    hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
    y = np.array([r["label"] for r in rows], float)
    if not rows:
        return ToxicModel(Vocabulary(np.zeros(0, np.uint64)), np.zeros(1))
    vocab = choose(hashes, y, width, always=identity_hashes())
    x = matrix(hashes, vocab)
    identity = np.searchsorted(vocab.hashes, identity_hashes())
    return ToxicModel(vocab, fit(x, y, len(vocab.hashes), l2, penalty=swap_penalty(x, identity, swap)))


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast((model.vocab.hashes, model.weights))

    def make():
        own = ToxicModel(Vocabulary(sent.value[0]), sent.value[1])

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = own.score(batch)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

        return f

    return map_arrow(texts(docs), make, "doc_id long, score double, predicted int")
