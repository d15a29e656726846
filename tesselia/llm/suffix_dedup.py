"""Removal of repeated byte strings, by a column-wise Burrows-Wheeler build over a collection's strings.

A byte goes if it is covered by a string of ``size`` bytes that also starts in a document with a smaller id. All
strings of that size are windows of their texts. A window's smallest 20-byte hash (its minimiser) is the same wherever
the window occurs, so windows meet by it:

1. Minimisers that occur in two documents are marked in a bit filter, which grows with their number up to 128 MB.
2. Stretches of windows whose minimiser is marked (*pieces*, at most ``RUN`` windows each) go to the bucket of their minimiser.
3. There the pieces are the collection: one symbol of every piece is inserted a round, which updates the Burrows-Wheeler
   transform and the common prefixes of neighbouring suffixes (``column_order``). After as many rounds as the longest piece has
   bytes, equal windows are neighbours with a common prefix of ``size``; the smallest id of each such class decides.
4. Covered spans meet their texts again; what is left is returned. Texts without spans don't move.

The filter only saves work: a window that it lets through wrongly is told apart in step 3. Equal pieces are ordered once, in a batch and
again in a bucket, so a passage that many documents hold costs one piece a batch. A bucket is ordered in groups of minimisers of
bounded size; one minimiser with more pieces than that is dealt out once more by the hash of each window.

Null and empty texts have no bytes; texts shorter than ``size`` lose none; very long ones are many pieces. Rows that share an id don't
remove from each other; of rows with one id and different texts each has its own spans, by id and a 64-bit hash of the text. Rows
without an id neither lose nor remove anything. Repeated rows are each returned. An empty table gives no rows. Other columns
may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship, through_table
from .common import filter_by, map_arrow, mix64, release_memory, slices, span_hashes, texts, utf8_buffers

GRAM, RUN, BUCKETS = 20, 64, 1024
#: Bits for each marked minimiser, so that about one in twenty others is let through, and the most bits in all.
KEY_BITS, MOST_BITS = 8, 1 << 30


class Marks(NamedTuple):
    """A bit filter for each bucket of minimisers, end to end; ``first``: where each begins, in bytes (BUCKETS + 1 entries)."""

    data: np.ndarray
    first: np.ndarray


def minimisers(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, text and minimiser of each window of the texts. Minima are small numbers, so they are mixed again to spread evenly."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(raw) - GRAM + 1)
    low = span_hashes(raw, at, at + GRAM)
    width, have = size - GRAM + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    count = np.maximum(np.diff(offsets) - size + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[doc]
    return start, doc, mix64(low[start] + np.uint64(0x9E3779B97F4A7C15))


def shared_filter(docs: DataFrame, size: int, filter_bits: int) -> Marks:
    """Minimisers that more than one document holds. ``filter_bits`` are the least, for all buckets together; more where many are marked."""
    ship(docs.sparkSession)
    least, most = filter_bits // BUCKETS, max(filter_bits, MOST_BITS) // BUCKETS

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                _, doc, low = minimisers(*utf8_buffers(part.column("text")), size)
                if not len(low):
                    continue
                new = np.ones(len(low), np.bool_)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                low, doc = low[new], doc[new]
                order = np.lexsort((doc, low))
                low, doc = low[order], doc[order]
                same = np.zeros(len(low), np.bool_)
                same[1:] = low[1:] == low[:-1]
                twice = np.zeros(len(low), np.bool_)
                twice[1:] = same[1:] & (doc[1:] != doc[:-1])
                low = np.sort(np.concatenate([low[~same], np.unique(low[twice])]))
                cut = np.searchsorted(low >> np.uint64(54), np.arange(BUCKETS + 1, dtype=np.uint64))
                data = (low >> np.uint64(14)).view(np.uint8).reshape(-1, 8)[:, :5]
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([data[cut[b] : cut[b + 1]].tobytes() for b in some], pa.binary())], ["bucket", "data"])

    def bits(values: list[bytes]) -> bytes:
        raw = np.frombuffer(b"".join(values), np.uint8).reshape(-1, 5)
        full = np.zeros((len(raw), 8), np.uint8)
        full[:, :5] = raw
        h = np.sort(full.view(np.uint64).ravel())
        h = h[1:][h[1:] == h[:-1]]
        each = max(least, min(most, 1 << (KEY_BITS * len(h)).bit_length()))
        out = np.zeros(each, np.bool_)
        for p in filter_places(h, each):
            out[p] = True
        return np.packbits(out).tobytes()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for b, d in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                if b != now and held:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits(held)], pa.binary())], ["bucket", "bits"])
                    held = []
                now = b
                held.append(d)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits(held)], pa.binary())], ["bucket", "bits"])

    rows = docs.mapInArrow(prints, "bucket int, data binary").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "bucket int, bits binary")
    out = [np.zeros(1, np.uint8)] * BUCKETS
    for r in rows.toLocalIterator():
        out[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return Marks(np.concatenate(out), np.cumsum([0] + [len(x) for x in out]))


def filter_places(h: np.ndarray, each: int | np.ndarray) -> list[np.ndarray]:
    mixed, each = mix64(h), np.asarray(each).astype(np.uint64)
    return [(mixed % each).astype(np.int64), ((mixed >> np.uint64(32)) % each).astype(np.int64)]


def marked(low: np.ndarray, bits: Marks) -> np.ndarray:
    bucket = (low >> np.uint64(54)).astype(np.int64)
    h = (low >> np.uint64(14)) & np.uint64((1 << 40) - 1)
    ok = np.ones(len(low), np.bool_)
    for p in filter_places(h, np.diff(bits.first)[bucket] * 8):
        ok &= (bits.data[bits.first[bucket] + (p >> 3)] >> (7 - (p & 7)).astype(np.uint8) & 1).astype(np.bool_)
    return ok


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] of them, for each i."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def column_order(raw: np.ndarray, first: np.ndarray, length: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the strings in order: string, length, and common prefix with the one before (at most ``cap``).

    One symbol of every string is inserted a round, from the last to the first. ``before`` is the collection's Burrows-Wheeler
    transform so far: the symbol in front of each suffix, 0 where there is none. A new suffix goes where its symbol's rank
    there puts it; common prefixes of it and of its successor are one more than the least between the places they come from.
    Bytes are UTF-8, so none is 255.
    """
    d = len(length)
    last = first + length
    before = raw[last - 1] + np.uint8(1)
    common = np.zeros(d, np.uint8)
    bits = max(1, int(length.max(initial=1)).bit_length())
    who = np.arange(d, dtype=np.int32 if d << bits < 1 << 31 else np.int64) << bits
    place = live = np.arange(d)
    for n in range(1, int(length.max(initial=0)) + 1):
        some = length[live] >= n
        live, at = live[some], place[some]
        by_symbol = np.argsort(before, kind="stable")
        rank = np.empty(len(before), np.int32)
        rank[by_symbol] = np.arange(len(before), dtype=np.int32)
        # Minima of common prefixes over all ranges of 2**k places.
        least = [common]
        while 2 << (len(least) - 1) <= len(common):
            half = 1 << (len(least) - 1)
            least.append(np.minimum(least[-1][:-half], least[-1][half:]))

        def between(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            """One more than the least common prefix in places lo + 1 to hi."""
            k = np.frexp((hi - lo).astype(np.float64))[1] - 1
            out = np.empty(len(lo), np.uint8)
            for level in np.unique(k).tolist():
                at = np.flatnonzero(k == level)
                out[at] = np.minimum(least[level][lo[at] + 1], least[level][hi[at] + 1 - (1 << level)])
            return np.minimum(out, cap - 1) + 1

        r = rank[at]
        up = np.flatnonzero((r > 0) & (before[by_symbol[np.maximum(r - 1, 0)]] == before[at]))
        down = np.flatnonzero((r + 1 < len(before)) & (before[by_symbol[np.minimum(r + 1, len(before) - 1)]] == before[at]))
        with_up, with_down = np.zeros(len(live), np.uint8), np.zeros(len(live), np.uint8)
        with_up[up] = between(by_symbol[r[up] - 1], at[up])
        with_down[down] = between(at[down], by_symbol[r[down] + 1])
        new = d + r - int((before == 0).sum())
        old = np.ones(len(before) + len(live), np.bool_)
        old[new] = False
        grown = [np.empty(len(old), x.dtype) for x in (before, common, who)]
        for x, y in zip(grown, (before, common, who)):
            x[old] = y
        before, common, who = grown
        before[new] = np.where(length[live] > n, raw[np.maximum(last[live] - n - 1, 0)] + np.uint8(1), 0)
        common[new] = with_up
        common[new[down] + 1] = with_down[down]
        who[new] = live << bits | n
        place = new
    return who >> bits, who & ((1 << bits) - 1), common


def least_owners(raw: np.ndarray, first: np.ndarray, length: np.ndarray, least: np.ndarray, size: int) -> np.ndarray:
    """For each window of each string, in turn, the smallest of the strings' ids ``least`` that hold the same window."""
    count = length - size + 1
    at = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    string, n, common = column_order(raw, first, length, size)
    kind = np.cumsum(common < size) - 1
    low = np.full(int(kind[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, kind, least[string])
    some = n >= size
    string, n, kind = string[some], n[some], kind[some]
    out[at[string] + length[string] - n] = low[kind]
    return out


def owners(raw: np.ndarray, first: np.ndarray, length: np.ndarray, least: np.ndarray, size: int, most: int) -> np.ndarray:
    """As least_owners, in groups of at most about ``most`` bytes: by minimiser, and one minimiser's windows by hash."""
    if int(length.sum()) <= most:
        return least_owners(raw, first, length, least, size)
    count = length - size + 1
    at = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    grams = size - GRAM + 1
    near = spread(first, np.full(len(first), grams))
    gram = span_hashes(raw, near, near + GRAM).reshape(-1, grams).min(1)
    order = np.argsort(gram, kind="stable")
    cut = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1]))
    bytes_, ends = np.add.reduceat(length[order], cut), np.append(cut[1:], len(order))
    i = 0
    while i < len(cut):
        j, total = i + 1, int(bytes_[i])
        while j < len(cut) and total + bytes_[j] <= most:
            total += int(bytes_[j])
            j += 1
        own = order[cut[i] : ends[j - 1]]
        if total <= most:
            out[spread(at[own], count[own])] = least_owners(raw, first[own], length[own], least[own], size)
        else:
            start, who, to = spread(first[own], count[own]), np.repeat(least[own], count[own]), spread(at[own], count[own])
            parts = np.uint64(-(-len(start) * size // most))
            part = span_hashes(raw, start, start + size) % parts
            for k in range(int(parts)):
                w = np.flatnonzero(part == k)
                if len(w):
                    out[to[w]] = least_owners(raw, start[w], np.full(len(w), size), who[w], size)
        i = j
    return out


def met_stretches(raw: np.ndarray, first: np.ndarray, length: np.ndarray, least: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Stretches of windows whose 64-bit hash pieces of different ids hold: piece, first window and windows of each.

    Other windows are nobody else's, as equal windows have equal hashes. So what a piece's surroundings add is not ordered.
    """
    count = length - size + 1
    piece = np.repeat(np.arange(len(length)), count)
    start = spread(first, count)
    h = span_hashes(raw, start, start + size)
    order = np.argsort(h, kind="stable")
    new = np.append(True, h[order][1:] != h[order][:-1])
    cut, who = np.flatnonzero(new), least[piece[order]]
    met = np.empty(len(h), np.bool_)
    met[order] = (np.minimum.reduceat(who, cut) < np.maximum.reduceat(who, cut))[np.cumsum(new) - 1]
    edge = np.ones(len(met) + 1, np.bool_)
    edge[1:-1] = (met[1:] != met[:-1]) | (piece[1:] != piece[:-1])
    runs = np.flatnonzero(edge)
    b, e = runs[:-1], runs[1:]
    b, e = b[met[b]], e[met[b]]
    return piece[b], b - (np.cumsum(count) - count)[piece[b]], e - b


def alike(raw: np.ndarray, length: np.ndarray, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal pieces by all their bytes: one piece of each class, and each piece's class."""
    first = np.cumsum(length) - length
    wide = np.zeros((len(length), widest + 1), np.uint8)
    rows = np.repeat(np.arange(len(length)), length)
    wide[rows, np.arange(len(raw)) - first[rows]] = raw
    wide[:, -1] = length  # a piece's length is part of its identity; the padding after it could be real zero bytes
    _, one, same = np.unique(np.ascontiguousarray(wide).view([("", np.void, widest + 1)]).ravel(), return_index=True, return_inverse=True)
    return one, same.ravel()


class Pieces:
    """Pieces of one bucket as they come. Copies of a piece leave early, so what is held is distinct pieces of the smallest ids."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.held, self.fresh = size, most, [], 0

    def add(self, *columns: np.ndarray):
        """ids, keys, begins, lengths and bytes end to end; returns spans (ids, keys, starts, ends) that are settled."""
        self.held.append(columns)
        self.fresh += len(columns[4])
        return self._thin() if self.fresh >= self.most else None

    def _thin(self):
        ids, keys, begins, length, data = (np.concatenate(x) for x in zip(*self.held))
        one, same = alike(data, length, self.size + RUN - 1)
        least = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(least, same, ids)
        gone = ids > least[same]
        stay = ~gone
        # Repeated rows bring the same piece of the same text again.
        order = np.lexsort((begins, keys, same))
        order = order[stay[order]]
        again = np.zeros(len(order), np.bool_)
        again[1:] = (same[order][1:] == same[order][:-1]) & (keys[order][1:] == keys[order][:-1]) & (begins[order][1:] == begins[order][:-1])
        keep = np.sort(order[~again])
        at = np.cumsum(length) - length
        self.held = [(ids[keep], keys[keep], begins[keep], length[keep], data[spread(at[keep], length[keep])])]
        self.fresh = 0
        return ids[gone], keys[gone], begins[gone], begins[gone] + length[gone]

    def finish(self):
        """Spans of all that is held, by their windows."""
        if not self.held:
            return []
        out = [self._thin()]
        ids, keys, begins, length, data = self.held[0]
        one, same = alike(data, length, self.size + RUN - 1)
        # Of distinct pieces: the stretches that meet others, then the distinct ones among those.
        first = (np.cumsum(length) - length)[one]
        p, skip, n = met_stretches(data, first, length[one], ids[one], self.size)
        if len(p):
            begin, bytes_ = first[p] + skip, n + self.size - 1
            text = data[spread(begin, bytes_)]
            some, kind = alike(text, bytes_, self.size + RUN - 1)
            least = np.full(len(some), np.iinfo(np.int64).max)
            np.minimum.at(least, kind, ids[one][p])
            low = owners(text, (np.cumsum(bytes_) - bytes_)[some], bytes_[some], least, self.size, self.most)
            at = np.cumsum(n[some]) - n[some]
            hit = low[spread(at[kind], n)] < np.repeat(ids[one][p], n)
            run = np.repeat(np.arange(len(p)), n)
            edge = np.ones(len(hit) + 1, np.bool_)
            edge[1:-1] = (hit[1:] != hit[:-1]) | (run[1:] != run[:-1])
            edges = np.flatnonzero(edge)
            b, e = edges[:-1], edges[1:]
            b, e = b[hit[b]], e[hit[b]]
            base = (np.cumsum(n) - n)[run[b]]
            q, b, e = p[run[b]], skip[run[b]] + b - base, skip[run[b]] + e - base + self.size - 1
            # Every piece of a class has its spans.
            members = np.argsort(same, kind="stable")
            total = np.bincount(same, minlength=len(one))
            own = members[spread((np.cumsum(total) - total)[q], total[q])]
            b, e = np.repeat(b, total[q]), np.repeat(e, total[q])
            out.append((ids[own], keys[own], begins[own] + b, begins[own] + e))
        self.held = []
        return out


def candidate_pieces(batch: pa.RecordBatch, size: int, bits: Marks, shift: int) -> list[np.ndarray]:
    """Pieces of a batch: bucket, id, hash of the text, start, length and 64-bit hash of each, and all bytes end to end."""
    found: list[list[np.ndarray]] = []
    for part in slices(batch, most=1 << 20):
        raw, offsets = utf8_buffers(part.column("text"))
        start, doc, low = minimisers(raw, offsets, size)
        runs = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)  # neighbours mostly share theirs
        ok = np.repeat(marked(low[runs], bits), np.diff(np.append(runs, len(low))))
        start, doc, low = start[ok], doc[ok], low[ok]
        if not len(low):
            continue
        new = np.ones(len(low), np.bool_)
        new[1:] = (low[1:] != low[:-1]) | (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        since = np.arange(len(low)) - head[np.cumsum(new) - 1]
        head = np.flatnonzero(since % RUN == 0)
        length = np.diff(np.append(head, len(low))) + size - 1
        at, row = start[head], doc[head]
        columns = [(low[head] >> np.uint64(shift)).astype(np.int64), part.column("doc_id").to_numpy()[row], part.column("hash").to_numpy()[row]]
        found.append([*columns, (at - offsets[row]).astype(np.int32), length, span_hashes(raw, at, at + length), raw[spread(at, length)]])
    return [np.concatenate(c) for c in zip(*found)]


def settled_here(ids: np.ndarray, length: np.ndarray, same: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Pieces with the bytes of one of a smaller id in the same batch: covered as a whole, whatever others hold."""
    order = np.lexsort((ids, same))
    first = np.ones(len(order), np.bool_)
    first[1:] = same[order][1:] != same[order][:-1]
    leader = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
    maybe = (ids[order] > ids[leader]) & (length[order] == length[leader])
    order, leader = order[maybe], leader[maybe]
    out = np.zeros(len(ids), np.bool_)
    if len(order):
        at = np.cumsum(length) - length
        equal = data[spread(at[order], length[order])] == data[spread(at[leader], length[order])]
        out[order] = np.logical_and.reduceat(equal, np.cumsum(length[order]) - length[order])
    return out


def _pack(x: np.ndarray) -> bytes:
    return len(raw := np.ascontiguousarray(x).tobytes()).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[4:], int.from_bytes(x[:4], "little"), codec="zstd", asbytes=True), kind)


def pieces(docs: DataFrame, size: int, bits, shift: int) -> DataFrame:
    """bucket, and packed columns of a batch's pieces there: ids, hashes of texts, starts, lengths and bytes.

    Of equal pieces in a batch only those of the smallest id are sent; the others are settled already and leave as spans,
    in rows with a negative bucket and no bytes. So a passage that many documents hold costs one piece a batch.
    """
    ship(docs.sparkSession)
    names = ["bucket", "ids", "keys", "begins", "lengths", "data"]

    def rows(bucket, ids, keys, begin, length, data) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        at = np.cumsum(length) - length
        bucket, ids, keys, begin, first, length = (x[order] for x in (bucket, ids, keys, begin, at, length))
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        packed = [[_pack(x[a:b]) for a, b in zip(cut[:-1], cut[1:])] for x in (ids, keys, begin, length.astype(np.int32))]
        text = [_pack(data[spread(first[a:b], length[a:b])]) if data is not None else b"" for a, b in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int64()), *(pa.array(c, pa.binary()) for c in [*packed, text])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in (candidate_pieces(part, size, bits.value, shift) for batch in batches if batch.num_rows for part in slices(batch, most=1 << 21)):
            if not got:
                continue
            bucket, ids, keys, begin, length, same, data = got
            done = settled_here(ids, length, same, data)
            if done.any():
                order = np.lexsort((begin[done], keys[done], ids[done]))
                i, k, s = ids[done][order], keys[done][order], begin[done][order]
                e = s + length[done][order].astype(np.int32)
                new = np.ones(len(i), np.bool_)
                new[1:] = (i[1:] != i[:-1]) | (k[1:] != k[:-1]) | (s[1:] > e[:-1])  # pieces of a text start and end in order
                head = np.flatnonzero(new)
                last = np.append(head[1:], len(i)) - 1
                yield rows(-1 - (np.arange(len(head)) >> 12) - (hash(int(i[0])) & 0xFFF) * 64, i[head], k[head], s[head], (e[last] - s[head]).astype(np.int64), None)
            if not done.all():
                keep = ~done
                yield rows(bucket[keep], ids[keep], keys[keep], begin[keep], length[keep], data[np.repeat(keep, length)])
            del bucket, ids, keys, begin, length, same, data, got
        release_memory()

    return docs.mapInArrow(run, "bucket long, ids binary, keys binary, begins binary, lengths binary, data binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("hash", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, size: int, filter_bits: int, most: int = 1 << 19) -> DataFrame:
    """doc_id, hash, start and end of covered spans; spans of a document may touch, overlap and repeat.

    Pieces are dealt to at least 1,024 buckets, and to 16 for each shuffle partition, so buckets shrink as partitions grow. A task
    holds the distinct pieces of one bucket, or of several small ones, and orders about ``most`` bytes at a time.
    """
    if not GRAM <= size <= 255 - RUN:
        raise ValueError(f"size must lie between {GRAM} and {255 - RUN}")
    spark = docs.sparkSession
    keyed = _keyed(docs).filter("doc_id is not null")
    sent = spark.sparkContext.broadcast(shared_filter(keyed, size, filter_bits))
    buckets = max(1024, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shift = 64 - (buckets - 1).bit_length()

    def spans(ids, keys, starts, ends) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys), pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], ["doc_id", "hash", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, total = None, Pieces(size, most), 0
        for batch in batches:
            for i in range(batch.num_rows):
                b, *row = (c[i].as_py() for c in batch.columns)
                ids, keys, begins, lengths = (_unpack(x, k) for x, k in zip(row, (np.int64, np.int64, np.int32, np.int32)))
                if b < 0:
                    yield spans(ids, keys, begins, begins + lengths)
                    continue
                if b != now and total >= most:
                    for out in group.finish():
                        yield spans(*out)
                    total = 0
                now = b
                data = _unpack(row[4], np.uint8)
                total += len(data)
                out = group.add(ids, keys, begins, lengths.astype(np.int64), data)
                if out is not None:
                    yield spans(*out)
        for out in group.finish():
            yield spans(*out)
        release_memory()

    return pieces(keyed, size, sent, shift).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc_id long, hash long, start int, end int")


def _spans_of(docs: DataFrame, size: int, filter_bits: int) -> DataFrame:
    """doc_id, text and its spans. Texts without spans do not move."""
    found = through_table(repeated_spans(docs, size, filter_bits), "repeat-spans")
    keys = ["doc_id", "hash"]
    # Dealt first: gathering spans before the shuffle would only hold them, as hardly any of a document meet in a task.
    spans = found.repartition(*keys).groupBy(*keys).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    some = through_table(found.select(*keys).distinct(), "repeat-docs")
    moved = filter_by(_keyed(docs), some, keys, "left_semi").join(spans, keys).select("doc_id", "text", "spans.start", "spans.end")
    none = F.lit(None).cast("array<int>")
    return moved.union(filter_by(_keyed(docs), some, keys, "left_anti").select("doc_id", "text", none, none))


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal spans of the union; spans that touch are one."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _rest(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(at[::2], at[1::2]))


def _finish(docs: DataFrame, size: int, filter_bits: int, schema: str, kind: pa.DataType, shape) -> DataFrame:
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def make():
        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for t, s, e in zip(batch.column("text"), batch.column("start").to_pylist(), batch.column("end").to_pylist()):
                raw = t.as_buffer().to_pybytes()
                spans = merged(s, e) if s else []
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), shape(_rest(raw, spans) if spans else raw)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.int64()] * 3 + [kind]))], names)

        return f

    return map_arrow(_spans_of(docs, size, filter_bits), make, schema)


def remove_repeats(docs: DataFrame, size: int = 50, filter_bits: int = 1 << 27) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, the bytes that are left (they may not be whole UTF-8)."""
    return _finish(docs, size, filter_bits, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", pa.binary(), lambda x: x)


def repeat_digests(docs: DataFrame, size: int = 50, filter_bits: int = 1 << 27) -> DataFrame:
    """As remove_repeats, with SHA-256 of the bytes that are left."""
    return _finish(docs, size, filter_bits, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", pa.string(), lambda x: hashlib.sha256(x).hexdigest())
