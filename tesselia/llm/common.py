"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship, through_table

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def pick(df: DataFrame, *names: str, **types: str) -> DataFrame:
    """The named columns, found by exact name and position.

    Other columns may have any names, equal in lower case or duplicated ones too: they are renamed by position
    first, so they never make a name ambiguous. ``types`` casts. Of columns with the very same name the first counts.
    """
    have = df.columns
    at = [have.index(n) for n in names]
    flat = df.toDF(*[f"_{i}" for i in range(len(have))])
    return flat.select(*[(F.col(f"_{i}").cast(types[n]) if n in types else F.col(f"_{i}")).alias(n) for i, n in zip(at, names)])


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` as long and ``text`` with null as the empty string."""
    return pick(df, id_col, text_col, **{id_col: "long", text_col: "string"}).select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """mapInArrow with a function that is made once per task, from ``make``, and applied to each batch."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            if batch.num_rows:
                f = f or make()
                out = f(batch)
                if out is not None and out.num_rows:
                    yield out
                del out, batch
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give freed memory back at a task's end: Python workers live on, beside other tasks and the executor's heap."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets, without a copy where the column starts at zero."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_LONG = 256


def _powers(kind: str, n: int) -> np.ndarray:
    """base**i or base**-i modulo 2**64 for i below n; grown by doubling and kept per process."""
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        step, filled = _BASE if kind == "up" else _INVERSE, 1
        while filled < size:
            out[filled : 2 * filled] = out[:filled] * np.uint64(pow(step, filled, 1 << 64))
            filled *= 2
        _POWERS[kind] = have = out
    return have


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end] for each span: polynomial prefix sums modulo 2**64, with length mixed in.

    Such sums have collisions of long strings whatever the base is, so spans over ``_LONG`` bytes are hashed by BLAKE2.
    """
    n = len(raw)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers("up", n)[:n], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers("down", n + 1)[starts]
    h = mix64(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    for i in np.flatnonzero(ends - starts > _LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: maximal runs of bytes other than space and 0x09 to 0x0D.

    Returns starts, ends (in raw) and, for each text, the index of its first word (n + 1 entries).
    """
    n = len(raw)
    inside = np.zeros(n + 2, np.bool_)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = inside[1:] != inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    both = cut[inside[cut] & inside[cut + 1]]  # a word runs on into the next text
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(both):
        both = np.unique(both)
        starts = np.sort(np.concatenate([starts, both]))
        ends = np.sort(np.concatenate([ends, both]))
    return starts, ends, np.searchsorted(starts, offsets)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Consecutive zero-copy slices of a batch of about ``most`` bytes of text; a longer text is a slice of its own."""
    sizes = np.diff(np.frombuffer(batch.column(column).cast(pa.large_string()).buffers()[1], np.int64)[: batch.num_rows + 1])
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def narrow_table(df: DataFrame, name: str) -> DataFrame:
    """through_table for rows of a few numbers: at most four files a core, however many shuffle partitions there are."""
    return through_table(df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism), name)


def filter_by(big: DataFrame, keys: DataFrame, on: list[str], how: str, most: int = 1 << 25) -> DataFrame:
    """Semi or anti join of wide rows with a table of keys, which must be cheap to count (a written table).

    Keys of up to ``most`` bytes are broadcast, after counting them; more are joined by a shuffle of both sides.
    """
    keys = keys.select(*on)
    width = sum(64 if t in ("binary", "string") else 16 for _, t in keys.dtypes)
    return big.join(F.broadcast(keys) if keys.count() * width <= most else keys, on, how)
