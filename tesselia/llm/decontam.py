"""Benchmark decontamination by CGK embeddings and bit-sampling LSH, with exact edit verification.

Texts are sequences of words (lower-cased runs of letters and digits). The CGK embedding walks over a window: each step writes
the word at hand and moves on or not, by a random bit of that word and step. Windows at a small edit distance so write
strings at a small Hamming distance, whatever their words. Windows of 8, 16 and 32 words are hashed by ``samples`` random
positions of the walk, in ``repeats`` independent walks, so that some repetition agrees with the wanted recall.

Walks start at anchor words: of each item of ``SHORT`` words or more its ``anchors`` rarest words, by their counts in the benchmark.

What walks do not meet (they are random, and an edited text may hold no anchor) is found exactly: with at most k edits one of k + 1 parts
of an item stands in the text as it is, so the runs of words at every place of every text are looked up among the parts of all
items. So every match counts, whichever words were edited. Letters of scripts without spaces are a word each.

Every candidate (text place, item place) is verified: the edit distance in words between the whole item and the best-matching
stretch of the text around the place must be at most ``max_edit`` of the item's words. That runs on hashes of words; what passes is
confirmed on the words themselves, byte by byte, over the whole text, which gives the smallest number of edits.

The index is as large as the benchmark and sent to executors in blocks of ``block`` items, one pass each; texts are
never shuffled, long ones are searched whole. Null and empty texts and items match nothing; empty tables give no matches; columns
other than the id and the text may have any names. Items with fewer than ``min_words`` words match without edits only. Of
repeated items each is reported.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow, mix64, slices, span_hashes, texts, utf8_buffers
from .linear import _CLASS, token_spans

SIZES = (8, 16, 32)
SHORT = 15
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_PAD = np.uint64(0)


class Words(NamedTuple):
    """The words of a small batch: their hashes, for each row the index of its first (n + 1 entries), and their places in ``raw``."""

    h: np.ndarray
    first: np.ndarray
    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def read_words(batch: pa.RecordBatch) -> Words:
    lower = pc.utf8_lower(batch.column("text"))
    raw, offsets = utf8_buffers(lower)
    if (raw >= 0xE0).any():
        raw, offsets = utf8_buffers(pc.replace_substring_regex(lower, _UNSPACED, r" \1 "))
    s, e, doc = token_spans(raw, offsets)
    some = _CLASS[raw[s]] == 1
    s, e = s[some], e[some]
    return Words(span_hashes(raw, s, e) | np.uint64(1), np.searchsorted(doc[some], np.arange(batch.num_rows + 1)), raw, s, e)


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> int:
    """Smallest edit distance between the item and any stretch of the text."""
    n = len(text)
    row = np.zeros(n + 1, np.int64)
    ramp = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        step = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        new = np.concatenate([[i], step])
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def exact_edits(item: list[bytes], hashes: np.ndarray, words: Words, row: int) -> int:
    """Smallest edit distance between the item and any stretch of the row's text, by the words' bytes."""
    number = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    a, b = words.first[row], words.first[row + 1]
    text = np.zeros(b - a, np.int64)
    for i in np.flatnonzero(np.isin(words.h[a:b], hashes)).tolist():
        text[i] = number.get(words.word(a + i), 0)
    return edit_distance_within(np.array([number[w] for w in item]), text)


class Embedding:
    """``repeats`` random walks and the positions that are sampled of each, per window size."""

    def __init__(self, repeats: int, samples: int, seed: int = 7):
        rnd = np.random.RandomState(seed)
        self.steps = 3 * SIZES[-1] // 2
        self.salt = rnd.randint(1, 1 << 62, (repeats, self.steps), dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.at = {(r, L): np.sort(rnd.choice(3 * L // 2, samples, replace=False)) for r in range(repeats) for L in SIZES}
        self.repeats = repeats

    def keys(self, h: np.ndarray, starts: np.ndarray, ends: np.ndarray, r: int) -> dict[int, np.ndarray]:
        """For each size a key of each window; ``ends``: where its text ends."""
        pos, keys = starts.copy(), {L: np.full(len(starts), np.uint64(L)) for L in SIZES}
        last = len(h) - 1
        for j in range(self.steps):
            word = np.where(pos < ends, h[np.minimum(pos, last)], _PAD)
            for L in SIZES:
                if j in self.at[r, L]:
                    keys[L] = mix64(keys[L] ^ word)
            pos += (word * self.salt[r, j] >> np.uint64(63)).astype(np.int64)
        return keys


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = mix64(out ^ h[j : j + n])
    return out


class Parts:
    """Items by their parts: one more than the edits that an item allows, so that one part is whole in every match."""

    def __init__(self, items: list[tuple[int, np.ndarray]], most: list[int]):
        self.items, self.most = items, most
        parts: dict[int, list[tuple[int, int, int]]] = {}
        for n, (_, words) in enumerate(items):
            cut = np.linspace(0, len(words), most[n] + 2).astype(int).tolist()
            for a, b in zip(cut, cut[1:]):
                parts.setdefault(b - a, []).append((int(run_hashes(words[a:b], b - a)[0]), n, a))
        self.tables = {}
        for size, rows in parts.items():
            key = np.array([r[0] for r in rows], np.uint64)
            order = np.argsort(key, kind="stable")
            self.tables[size] = key[order], np.array([r[1:] for r in rows], np.int64)[order]

    def search(self, h: np.ndarray, first: np.ndarray, found: dict[tuple[int, int], int], block: int = 1 << 20) -> None:
        """Adds {(row, item number): edits} of the rows' matches that are not in ``found``; about ``block`` words are compared at once."""
        hits = []
        for size, (keys, places) in self.tables.items():
            key = run_hashes(h, size)
            lo = np.searchsorted(keys, key)
            some = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == key)
            row = np.searchsorted(first, some, side="right") - 1
            inside = some + size <= first[row + 1]
            some, row, lo = some[inside], row[inside], lo[some[inside]]
            n = np.searchsorted(keys, key[some], side="right") - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hits.append(np.stack([places[at, 0], np.repeat(row, n), np.repeat(some, n) - places[at, 1]], 1))
        hits = np.unique(np.concatenate(hits), axis=0) if hits else np.zeros((0, 3), np.int64)
        edges = np.flatnonzero(np.append(True, hits[1:, 0] != hits[:-1, 0])) if len(hits) else hits[:, 0]
        for own in np.split(hits, edges[1:]):
            if len(own):
                n = int(own[0, 0])
                wide = max(1, block // (len(self.items[n][1]) + 2 * self.most[n]))
                for i in range(0, len(own), wide):
                    self._verify(n, own[i : i + wide, 1:], h, first, found)

    def _verify(self, n: int, own: np.ndarray, h: np.ndarray, first: np.ndarray, found: dict[tuple[int, int], int]) -> None:
        words, most = self.items[n][1], self.most[n]
        # A match holds all but ``most`` of the item's words.
        at = own[:, 1, None] + np.arange(-most, len(words) + most)
        fit = (at >= first[own[:, 0], None]) & (at < first[own[:, 0] + 1, None])
        near = np.isin(h[np.clip(at, 0, len(h) - 1)], words) & fit
        # Places whose surroundings overlap are compared as one stretch, so repeated words cost no more than the text's length.
        stretches: list[list[int]] = []
        for k, at in own[near.sum(1) >= len(words) - most].tolist():
            a, b = max(first[k], at - 2 * most), min(first[k + 1], at + len(words) + 2 * most)
            if stretches and stretches[-1][0] == k and a <= stretches[-1][2]:
                stretches[-1][2] = max(b, stretches[-1][2])
            else:
                stretches.append([k, a, b])
        for k, a, b in stretches:
            if (k, n) not in found:
                edits = edit_distance_within(words, h[a:b])
                if edits <= most:
                    found[k, n] = edits


class BenchmarkIndex:
    def __init__(self, items: list[tuple[int, np.ndarray, list[bytes]]], anchors: int, repeats: int, samples: int, max_edit: float, min_words: int):
        self.words = [w for _, _, w in items]
        items = [(i, h) for i, h, _ in items]
        self.items, self.most = items, [int(max_edit * len(words)) if len(words) >= min_words else 0 for _, words in items]
        self.parts = Parts(items, self.most)
        # The walks below see longer items only; numbers of items stay.
        items = [(i, words if len(words) >= max(SHORT, min_words) else words[:0]) for i, words in items]
        self.embedding = Embedding(repeats, samples)
        count: dict[int, int] = {}
        for _, words in items:
            for w in set(words.tolist()):
                count[w] = count.get(w, 0) + 1
        places = []
        for n, (_, words) in enumerate(items):
            fit = range(len(words) - SIZES[0] + 1)
            rare = sorted(fit, key=lambda i: (count[int(words[i])], i))
            seen: set[int] = set()
            for i in rare:
                if int(words[i]) not in seen and len(seen) < anchors:
                    seen.add(int(words[i]))
                    places.append((n, i))
        self.anchor_words = np.unique(np.array([items[n][1][i] for n, i in places], np.uint64))
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[(self.anchor_words >> np.uint64(44)).astype(np.int64)] = True
        # Every place of an anchor word in an item is indexed, wherever it was chosen.
        first = np.cumsum([0] + [len(w) for _, w in items])
        h = np.concatenate([w for _, w in items]) if items else np.zeros(0, np.uint64)
        self.item_of = np.searchsorted(first, np.arange(len(h)), side="right") - 1
        self.offset = np.arange(len(h)) - first[self.item_of]
        starts = np.flatnonzero(np.isin(h, self.anchor_words))
        ends = first[self.item_of[starts] + 1]
        self.table = {}
        for r in range(repeats):
            for L, key in self.embedding.keys(h, starts, ends, r).items():
                some = (ends - starts >= L) | ((L == SIZES[0]) & (ends - starts > 0))
                order = np.argsort(key[some], kind="stable")
                self.table[r, L] = key[some][order], starts[some][order]

    def search(self, words: Words) -> dict[tuple[int, int], int]:
        """{(row, item number): edits} of the rows' matches."""
        found = {}
        for k, n in self.near(words.h, words.first):
            edits = exact_edits(self.words[n], self.items[n][1], words, k)
            if edits <= self.most[n]:
                found[k, n] = edits
        return found

    def near(self, h: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], int]:
        """{(row, item number): edits} of one match of each row and item that match as hashes tell: by walks, then by parts at every place."""
        found = self.walked(h, first)
        self.parts.search(h, first, found)
        return found

    def walked(self, h: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], int]:
        """What walks from anchor words meet."""
        found: dict[tuple[int, int], int] = {}
        hot = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        hot = hot[np.isin(h[hot], self.anchor_words)]
        if not len(hot):
            return found
        row = np.searchsorted(first, hot, side="right") - 1
        ends = first[row + 1]
        pairs = []
        for r in range(self.embedding.repeats):
            for L, key in self.embedding.keys(h, hot, ends, r).items():
                keys, places = self.table[r, L]
                lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                some = np.flatnonzero(hi > lo)
                n = hi[some] - lo[some]
                at = np.repeat(lo[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                pairs.append(np.stack([np.repeat(some, n), places[at]], 1))
        pairs = np.concatenate(pairs)
        # Places that put an item at about the same stretch of the text are verified once.
        item = self.item_of[pairs[:, 1]]
        where = hot[pairs[:, 0]] - self.offset[pairs[:, 1]]
        for k, n, at in np.unique(np.stack([row[pairs[:, 0]], item, where], 1), axis=0).tolist():
            words, most = self.items[n][1], self.most[n]
            if found.get((k, n), most + 1) == 0:
                continue
            a, b = max(first[k], at - 2 * most), min(first[k + 1], at + len(words) + 2 * most)
            edits = edit_distance_within(words, h[a:b])
            if edits <= most and edits < found.get((k, n), most + 1):
                found[k, n] = edits
        return found


def item_words(benchmark: DataFrame) -> list[tuple[int, np.ndarray, list[bytes]]]:
    """The benchmark, which is small and fixed, as (item_id, word hashes, words) on the driver, in the order of ids."""
    rows = texts(benchmark, "item_id").orderBy("doc_id", "text").collect()
    if not rows:
        return []
    words = read_words(pa.RecordBatch.from_pydict({"text": pa.array([r["text"] for r in rows], pa.string())}))
    ranges = [range(words.first[i], words.first[i + 1]) for i in range(len(rows))]
    return [(r["doc_id"], words.h[at.start : at.stop], [words.word(i) for i in at]) for r, at in zip(rows, ranges) if len(at)]


def _indexes(spark, benchmark: DataFrame, anchors, repeats, samples, max_edit, min_words, block):
    items = item_words(benchmark)
    for i in range(0, len(items), block):
        yield spark.sparkContext.broadcast(items[i : i + block]), (anchors, repeats, samples, max_edit, min_words)


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = 0.2, anchors: int = 6, repeats: int = 6, samples: int = 5, min_words: int = 6, block: int = 20_000) -> DataFrame:
    """doc_id, item_id, n_edits, n_words of every document and item that it holds."""
    schema = "doc_id long, item_id long, n_edits long, n_words long"
    out = None
    for sent, how in _indexes(docs.sparkSession, benchmark, anchors, repeats, samples, max_edit, min_words, block):

        def make(sent=sent, how=how):
            index = BenchmarkIndex(sent.value, *how)

            def f(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = []
                for part in slices(batch):
                    ids = part.column("doc_id")
                    for (k, n), edits in index.search(read_words(part)).items():
                        rows.append((ids[k].as_py(), index.items[n][0], edits, len(index.items[n][1])))
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["doc_id", "item_id", "n_edits", "n_words"])

            return f

        got = map_arrow(texts(docs), make, schema)
        out = got if out is None else out.union(got)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = 0.2, anchors: int = 6, repeats: int = 6, samples: int = 5, min_words: int = 6, block: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns as they were. One pass, no shuffle."""
    names = docs.columns
    at_text = names.index("text")
    out = docs.toDF(*[f"_{i}" for i in range(len(names))])
    schema = ", ".join(f"`{k}` {t}" for k, t in out.dtypes)
    for sent, how in _indexes(docs.sparkSession, benchmark, anchors, repeats, samples, max_edit, min_words, block):

        def make(sent=sent, how=how):
            index = BenchmarkIndex(sent.value, *how)

            def f(batch: pa.RecordBatch) -> pa.RecordBatch:
                clean = np.ones(batch.num_rows, np.bool_)
                at = 0
                only = pa.RecordBatch.from_arrays([batch.column(at_text).cast(pa.string()).fill_null("")], ["text"])
                for part in slices(only):
                    for k, _ in index.search(read_words(part)):
                        clean[at + k] = False
                    at += part.num_rows
                return batch.filter(pa.array(clean))

            return f

        out = map_arrow(out, make, schema)
    return out.toDF(*names)
