"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Each document's set of word shingles gives a signature of ``trees * DEPTH`` minima. A tree of the forest is one sorted order of
part of the signature. Rows are range-partitioned and sorted by tree and signature; neighbours in that order with
a long common prefix are candidates. The depth adapts to the region: where few rows share the first ``least`` minima, all
of them are candidates of each other; where more than ``leaf`` do, the region is cut deeper, down to all eight, and what is
still too large there is chained in blocks of ``leaf`` through their first rows. That finds groups of copies cheaply, but not all
pairs, so every row of a region that was cut is also marked as dense.

Dense rows are joined exactly, by prefix filter: in one order of all shingles, common ones last, two sets of the wanted similarity
share one among the first ``n - ceil(percent * n / 100) + 1`` of either. Those few are shuffled by shingle; under each, rows of
different components whose sizes and places allow the similarity are candidates. The order decides the cost only, so a bounded
sample of the dense rows tells which shingles are common.

Documents with equal sets are one class before the forest, so copies cost one row. A short sketch beside each row
drops candidates that are far from similar. Candidates are confirmed on full sets: first one for each document, to its
smallest candidate; then every candidate whose ends aren't connected yet. So no candidate between different components is
left untested, and a group of near copies costs about one test a document.

Null and empty texts have no shingles and stand alone, as do rows whose ``doc_id`` is null: they stay, with a null component.
Texts with fewer words than a shingle are one shingle. Rows that share a ``doc_id`` are one node (``drop_near_copies`` has a node a row).
An empty table gives no rows; columns other than ``doc_id`` and ``text`` may have any names; long texts count whole. A tree brings a pair of similarity s to one region with probability s**3; with 16 trees a pair at 0.8
is in none with probability 1e-5. A pair in one region is compared in it, or both rows are dense. The sketch drops a pair at 0.8 of a
small region with probability 1e-5, and none of the exact join. Regions at a partition's border count as dense.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship, through_table
from .common import ascii_lower, filter_by, map_arrow, mix64, narrow_table, release_memory, slices, span_hashes, texts, utf8_buffers, word_spans
from .graph import components

DEPTH = 8
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(batch: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct shingle, sorted by row and hash."""
    raw, offsets = utf8_buffers(batch.column("text"))
    raw = ascii_lower(raw)
    s, e, first = word_spans(raw, offsets)
    h = span_hashes(raw, s, e)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    n = max(0, len(h) - words + 1)
    g = np.zeros(n, np.uint64)
    for k in range(words):
        g += h[k : k + n] * _MIX[k % 8] ^ np.uint64(k // 8)
    full = doc[:n] == doc[words - 1 : words - 1 + n]
    doc_g, g = doc[:n][full], mix64(g[full])
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        one = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            have = count[short] > k
            one[have] += h[first[short[have]] + k] * _MIX[k % 8]
        doc_g, g = np.concatenate([doc_g, short]), np.concatenate([g, mix64(one ^ count[short].astype(np.uint64))])
    order = np.lexsort((g, doc_g))
    doc_g, g = doc_g[order], g[order]
    new = np.ones(len(g), np.bool_)
    new[1:] = (g[1:] != g[:-1]) | (doc_g[1:] != doc_g[:-1])
    return doc_g[new], g[new]


def signatures(doc: np.ndarray, g: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: set size, 128-bit hash of the set and ``size`` minima (uint32)."""
    n = np.bincount(doc, minlength=rows)
    some = np.flatnonzero(n)
    sig, ident = np.zeros((rows, size), np.uint32), np.zeros((rows, 2), np.uint64)
    if len(some):
        at = (np.cumsum(n) - n)[some]
        ident[some, 0] = np.add.reduceat(mix64(g), at)
        ident[some, 1] = np.add.reduceat(mix64(g ^ _MIX[2]), at)
        x = (g >> np.uint64(32)).astype(np.uint32) ^ g.astype(np.uint32)
        rnd = np.random.RandomState(20_011)
        for k, (a, b) in enumerate(rnd.randint(0, 1 << 32, (size, 2), dtype=np.uint64)):
            y = x * np.uint32(a | 1) + np.uint32(b)
            y ^= y >> np.uint32(15)
            sig[some, k] = np.minimum.reduceat(y, at)
    return n, ident, sig


def signature_table(docs: DataFrame, words: int, trees: int) -> DataFrame:
    """doc_id, n_shingles, ident (16 bytes) and sig of each document; one pass over the texts."""

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ident, sig = [], [], []
            for part in slices(batch):
                a, b, c = signatures(*shingle_sets(part, words), part.num_rows, trees * DEPTH)
                n.append(a)
                ident += [r.tobytes() for r in b]
                sig += [r.tobytes() for r in c.astype(">u4")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(n), pa.int64()), pa.array(ident, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "ident", "sig"])

        return f

    return map_arrow(texts(docs), make, "doc_id long, n_shingles long, ident binary, sig binary")


def sketch(sig: np.ndarray) -> np.ndarray:
    """64 minima's four low bits, in 32 bytes a row."""
    low = (sig[:, : 128 : max(1, min(sig.shape[1], 128) // 64)][:, :64] & 15).astype(np.uint8)
    return low[:, 0::2] << 4 | low[:, 1::2]


def neighbours(tree: np.ndarray, key: np.ndarray, least: int, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs of positions in rows sorted by tree and key, by common prefixes of adaptive depth.

    The third array is the number of each row's region, negative where the region has more than ``leaf`` rows.
    """
    n = len(tree)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.ones(n, np.int64)
    lcp = np.concatenate([[0], np.where(tree[1:] == tree[:-1], np.cumprod(key[1:] == key[:-1], 1).sum(1), 0)])
    group = np.full(n, -1)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    taken = 0
    for depth in range(least, DEPTH + 1):
        run = np.cumsum(lcp < depth) - 1
        size = np.bincount(run)
        if depth == least:
            region = np.where(size[run] > leaf, -1 - run, 1 + run)
        fit = (size[run] <= leaf) & (group < 0)
        group[fit] = run[fit] + taken
        taken += len(size)
    rest = np.flatnonzero(group < 0)
    if len(rest):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        block = (np.arange(n) - start[run]) // leaf
        ids = np.cumsum((run[1:] != run[:-1]) | (block[1:] != block[:-1]))
        ids = np.concatenate([[0], ids])
        group[rest] = ids[rest] + taken
        heads = rest[(np.arange(n) - start[run])[rest] % leaf == 0]
        pairs.append((start[run[heads]], heads))
    for o in range(1, leaf):
        i = np.flatnonzero(group[:-o] == group[o:]) if o < n else []
        if not len(i):
            break
        pairs.append((i, i + o))
    i = np.flatnonzero(lcp[1:] >= least)
    pairs.append((i, i + 1))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), region


def candidates(sigs: DataFrame, trees: int, least: int, leaf: int, close: float) -> DataFrame:
    """Distinct pairs a < b of similar signatures, and a row with a = b for each dense row.

    ``close``: the least share of sketch codes in common.
    """
    ship(sigs.sparkSession)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.frombuffer(x, ">u4") for x in batch.column("sig").to_pylist()]
            if not raw:
                continue
            sig = np.stack(raw)
            codes = [r.tobytes() for r in sketch(sig.astype(np.uint32))]
            for t in range(trees):
                keys = [r.tobytes() for r in sig[:, DEPTH * t : DEPTH * (t + 1)]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t), pa.int32()), pa.array(keys, pa.binary()), batch.column("doc_id"), pa.array(codes, pa.binary())], ["tree", "key", "doc_id", "sketch"])
        release_memory()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column("tree").to_numpy()
            key = np.stack([np.frombuffer(x, ">u4") for x in batch.column("key").to_pylist()]).astype(np.uint32)
            doc = batch.column("doc_id").to_numpy()
            code = np.stack([np.frombuffer(x, np.uint8) for x in batch.column("sketch").to_pylist()])
            if held:
                tree, key, doc, code = (np.concatenate([h, x]) for h, x in zip(held, (tree, key, doc, code)))
            i, j, region = neighbours(tree, key, least, leaf)
            dense = (region < 0) | (region == region[0]) if not held else region < 0
            held = tuple(x[-leaf:].copy() for x in (tree, key, doc, code))
            last = doc[region == region[-1]][-leaf:].copy()
            if dense.any():
                one = pa.array(np.unique(doc[dense]))
                yield pa.RecordBatch.from_arrays([one, one], ["a", "b"])
            for at in range(0, len(i), 200_000):
                a, b = i[at : at + 200_000], j[at : at + 200_000]
                diff = code[a] ^ code[b]
                same = ((diff & 15) == 0).sum(1) + ((diff >> 4) == 0).sum(1)
                some = (same >= close * 64) & (doc[a] != doc[b])
                x, y = doc[a[some]], doc[b[some]]
                p = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
                if len(p):
                    yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["a", "b"])
        if last is not None:
            one = pa.array(np.unique(last))
            yield pa.RecordBatch.from_arrays([one, one], ["a", "b"])
        held = None
        release_memory()

    rows = sigs.select("doc_id", "sig").mapInArrow(grow, "tree int, key binary, doc_id long, sketch binary")
    return rows.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id").mapInArrow(walk, "a long, b long").distinct()


def set_table(docs: DataFrame, words: int) -> DataFrame:
    """node and its shingle set as sorted 64-bit hashes."""

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for part in slices(batch):
                doc, g = shingle_sets(part, words)
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                found += [g[at[i] : at[i + 1]].tobytes() for i in range(part.num_rows)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["node", "grams"])

        return f

    return map_arrow(docs, make, "node long, grams binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                both = np.sort(np.concatenate([p, q]), kind="stable")
                n = int((both[1:] == both[:-1]).sum())
                keep.append(100 * n >= percent * (len(p) + len(q) - n))
            return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

        return f

    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
    return map_arrow(with_a.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b").select("a", "b", "x", "y"), make, "a long, b long")


def common_shingles(docs: DataFrame, words: int, rows: int, sample: int = 20_000, most: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that several of about ``sample`` of the ``rows`` documents hold, sorted, and how many do."""

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            g = np.concatenate([shingle_sets(part, words)[1] for part in slices(batch)])
            return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64))], ["gram"])

        return f

    some = docs.filter(F.abs(F.xxhash64("doc_id") % 1_000_000) < int(min(1.0, sample / max(1, rows)) * 1_000_000))
    top = map_arrow(some, make, "gram long").groupBy("gram").count().filter("count > 2").orderBy(F.desc("count"), "gram").limit(most).toPandas()
    g = top["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(g)
    return g[order], top["count"].to_numpy(np.int64)[order]


def prefixes(docs: DataFrame, words: int, percent: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """gram, node, label, n (the set's size) and r (shingles from this one on) of each set's first shingles, rare ones first."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def make():
        known, counts = sent.value

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, labels = batch.column("doc_id").to_numpy(), batch.column("label").to_numpy()
            out, row0 = [], 0
            for part in slices(batch):
                doc, g = shingle_sets(part, words)
                rank = np.zeros(len(g), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    rank = np.where(known[at] == g, counts[at], 0)
                order = np.lexsort((g, rank, doc))
                doc, g = doc[order], g[order]
                n = np.bincount(doc, minlength=part.num_rows)
                pos = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
                n = n[doc]
                first = pos <= n - (percent * n + 99) // 100
                doc, n, pos = doc[first], n[first], pos[first]
                out.append((g[first].view(np.int64), ids[row0 + doc], labels[row0 + doc], n, n - pos))
                row0 += part.num_rows
            cols = [np.concatenate(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.int32()) for k, c in enumerate(cols)], ["gram", "node", "label", "n", "r"])

        return f

    return map_arrow(docs, make, "gram long, node long, label long, n int, r int")


def fitting(n: np.ndarray, r: np.ndarray, label: np.ndarray, percent: int, large: int = 64, most: int = 500_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of pairs of rows under one shingle that differ in label and whose overlap, at most the smaller r, can suffice."""
    # The largest partner of a row: (100 + percent) * r >= percent * (n + partner).
    top = (100 + percent) * r.astype(np.int64) // percent - n

    def ranges(a: np.ndarray, b: np.ndarray, from_: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        to = np.maximum(np.searchsorted(n[b], top[a], side="right"), from_)
        total = np.cumsum(to - from_)
        at = 0
        while at < len(a):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
            k = (to - from_)[at:end]
            if k.sum():
                x = np.repeat(np.arange(at, end), k)
                y = b[np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + from_[x]]
                x = a[x]
                ok = (n[x] <= top[y]) & (label[x] != label[y])
                yield x[ok], y[ok]
            at = end

    rest = np.argsort(n, kind="stable")
    for one in (u for u, c in zip(*np.unique(label, return_counts=True)) if c >= large):
        # Rows of a large component meet the others only, never each other.
        own, rest = rest[label[rest] == one], rest[label[rest] != one]
        yield from ranges(own, rest, np.searchsorted(n[rest], n[own], side="left"))
        yield from ranges(rest, own, np.searchsorted(n[own], n[rest], side="right"))
    yield from ranges(rest, rest, np.arange(1, len(rest) + 1))


def exact_candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b, out of ``prefixes``, of different labels that can have the similarity; no such pair is left out."""

    def pairs(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        gram, node, label, n, r = cols
        cut = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1], [True]]))
        mixed = np.minimum.reduceat(label, cut[:-1]) < np.maximum.reduceat(label, cut[:-1])
        for k in np.flatnonzero(mixed).tolist():
            s = slice(cut[k], cut[k + 1])
            for i, j in fitting(n[s], r[s], label[s], percent):
                x, y = node[s][i], node[s][j]
                p = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
                if len(p):
                    yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy() for c in batch.columns]
            # Rows of the batch's last shingle wait for the next batch.
            at = int(np.searchsorted(cols[0], cols[0][-1]))
            if at or (held and held[0][0][0] != cols[0][-1]):
                yield from pairs([np.concatenate(c) for c in zip(*held, [c[:at] for c in cols])])
                held = []
            held.append([c[at:].copy() for c in cols])
        if held:
            yield from pairs([np.concatenate(c) for c in zip(*held)])
        held = []
        release_memory()

    ship(rows.sparkSession)
    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(walk, "a long, b long").distinct()


def linked(found: DataFrame, docs: DataFrame, words: int, percent: int, labels: DataFrame | None = None) -> DataFrame:
    """node and component after the candidates ``found`` are confirmed, on top of the components so far."""
    nodes = narrow_table(found.select(F.col("a").alias("doc_id")).union(found.select(F.col("b").alias("doc_id"))).distinct(), "near-nodes")
    sets = through_table(set_table(filter_by(texts(docs), nodes, ["doc_id"], "left_semi"), words), "near-sets")
    hooks = found.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = through_table(confirm(hooks, sets, percent), "near-links")
    edges = lambda known, new: new if known is None else known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new)
    labels = narrow_table(components(edges(labels, links)), "near-labels")
    rest = found.join(hooks, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"l{side}")), side, "left")
    rest = rest.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")
    more = through_table(confirm(rest, sets, percent), "near-links")
    if more.take(1):
        labels = narrow_table(components(edges(labels, more)), "near-labels")
    return labels


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, trees: int = 16, least: int = 3, leaf: int = 24, close: float = 0.6) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept."""
    sigs = through_table(signature_table(docs, words, trees), "near-sigs")
    every = sigs.select("doc_id", "n_shingles", "ident")
    rows, docs = every.filter("doc_id is not null"), texts(docs).filter("doc_id is not null")
    classes = narrow_table(rows.filter("n_shingles > 0").groupBy("ident").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("size")), "near-classes")
    others = narrow_table(rows.filter("n_shingles > 0").join(classes.filter("size > 1").select("ident", "node"), "ident").filter("doc_id <> node").select("doc_id", "ident").distinct(), "near-copies")
    own = filter_by(sigs.filter("n_shingles > 0 and doc_id is not null"), others, ["doc_id", "ident"], "left_anti")
    met = through_table(candidates(own, trees, least, leaf, close), "near-candidates")
    labels = linked(met.filter("a < b"), docs, words, percent)
    # An id with several texts is one node: it joins the classes of all of them.
    several = rows.filter("n_shingles > 0").groupBy("doc_id").agg(F.min("ident").alias("lo"), F.max("ident").alias("hi")).filter("lo <> hi").select("doc_id")
    same = rows.filter("n_shingles > 0").join(several, "doc_id").join(classes.select("ident", "node"), "ident").filter("doc_id <> node")
    same = narrow_table(same.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct(), "near-same-id")
    if same.take(1):
        labels = narrow_table(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(same)), "near-labels")
    dense = met.filter("a = b").select(F.col("a").alias("doc_id")).join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    dense = narrow_table(dense.select("doc_id", F.coalesce("component", "doc_id").alias("label")), "near-dense")
    n_dense = dense.count()
    if n_dense > 1:
        crowd = texts(docs).join(F.broadcast(dense) if n_dense <= 2_000_000 else dense, "doc_id")
        common = common_shingles(crowd.select("doc_id", "text"), words, n_dense)
        exact = through_table(exact_candidates(prefixes(crowd, words, percent, common), percent), "near-exact")
        if exact.take(1):
            labels = linked(exact, docs, words, percent, labels)
    named = rows.join(classes.select("ident", "node"), "ident", "left").join(labels, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    named = named.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    return named.union(every.filter("doc_id is null").select("doc_id", "n_shingles", "doc_id", F.lit(True)))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id, null being the largest.

    Where an id is null or stands on several rows, rows get numbers of their own first, so that each is judged by its own text.
    """
    ids = texts(docs).select("doc_id")
    if ids.groupBy("doc_id").count().filter("count > 1 or doc_id is null").take(1):
        names = [f"_{i}" for i in range(len(docs.columns))]
        own = through_table(docs.toDF(*names).select("*", F.monotonically_increasing_id().alias("row")), "near-rows")
        at_id, at_text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
        groups = near_groups(own.select(F.col("row").alias("doc_id"), at_text.alias("text")), words, percent)
        label = through_table(groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("label")), "near-rows-labels")
        order = F.struct(at_id.isNull(), at_id.cast("long"), F.col("row"))
        stay = own.select("row", order.alias("order")).join(label, "row").groupBy("label").agg(F.min("order")["row"].alias("row"))
        return own.join(stay.select("row"), "row", "left_semi").select(*names).toDF(*docs.columns)
    gone = narrow_table(near_groups(docs, words, percent).filter("not kept").select("doc_id").distinct(), "near-gone")
    return filter_by(docs, gone, ["doc_id"], "left_anti")
