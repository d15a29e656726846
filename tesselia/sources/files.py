"""Manifests, events, summaries and images on disk."""

from __future__ import annotations

import io
import json
import struct
import zlib
from datetime import UTC, datetime
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def write_json(data: dict, path: str | Path) -> None:
    Path(path).write_text(json.dumps(data, indent=2, default=str), encoding="utf-8")


class EventLog:
    """One JSON object a line: ts (UTC, microseconds), event and further fields."""

    def __init__(self, folder: str | Path):
        self.path = Path(folder) / "events.jsonl"

    def event(self, name: str, **fields) -> None:
        with self.path.open("a", encoding="utf-8") as f:
            f.write(json.dumps({"ts": datetime.now(UTC).isoformat(), "event": name, **fields}, default=str) + "\n")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "run.json").json(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ts string, event string").option("recursiveFileLookup", True).option("pathGlobFilter", "events.jsonl").json(path)


def write_summary(rows: DataFrame, folder: str) -> None:
    """summary.csv and summary.json folders; summaries have a row a run, so one file each."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/summary.csv")
    rows.coalesce(1).write.mode("overwrite").json(f"{folder}/summary.json")


def png_bytes(image: np.ndarray) -> bytes:
    """8-bit gray (rows, columns) or RGB (rows, columns, 3)."""
    h, w = image.shape[:2]
    rows = np.zeros((h, 1 + image[0].size), np.uint8)
    rows[:, 1:] = image.reshape(h, -1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def _page(image: np.ndarray, at: int, mpp: tuple[float, float], tile: int | None, description: str, subs: list[int], reduced: bool, big: bool, packing: str | None) -> tuple[bytes, int]:
    """Image data and directory of one page (gray or RGB), to stand at file offset ``at``; and the directory's offset."""
    h, w = image.shape[:2]
    channels = 1 if image.ndim == 2 else image.shape[2]
    if tile and w >= tile and h >= tile:
        edges = lambda b: [(0, tile - b.shape[0]), (0, tile - b.shape[1]), (0, 0)][: image.ndim]
        blocks = (np.pad(b, edges(b)) for y in range(0, h, tile) for x in range(0, w, tile) for b in [image[y : y + tile, x : x + tile]])
    else:
        tile, blocks = None, iter([image])
    data, offsets, sizes = bytearray(), [], []
    for b in blocks:
        p = zlib.compress(np.ascontiguousarray(b)) if packing else np.ascontiguousarray(b).tobytes()
        offsets.append(at + len(data))
        sizes.append(len(p))
        data += p + b"\0" * (-len(p) % 8)
    text = description.encode() + b"\0"
    ratio = lambda v: struct.pack("<II", round(v * 1000), 1000)
    places = lambda xs: (16, struct.pack(f"<{len(xs)}Q", *xs)) if big else (4, struct.pack(f"<{len(xs)}I", *xs))
    tags = {
        254: (4, struct.pack("<I", int(reduced))), 256: (4, struct.pack("<I", w)), 257: (4, struct.pack("<I", h)), 258: (3, struct.pack("<H", 8) * channels),
        259: (3, struct.pack("<H", 8 if packing else 1)), 262: (3, struct.pack("<H", 1 if channels == 1 else 2)), 270: (2, text), 277: (3, struct.pack("<H", channels)),
        282: (5, ratio(10000.0 / mpp[0])), 283: (5, ratio(10000.0 / mpp[1])), 296: (3, struct.pack("<H", 3)),
    }
    if tile:
        tags |= {322: (4, struct.pack("<I", tile)), 323: (4, struct.pack("<I", tile)), 324: places(offsets), 325: places(sizes)}
    else:
        tags |= {273: places(offsets), 278: (4, struct.pack("<I", h)), 279: places(sizes)}
    if subs:
        tags[330] = places(subs)
    size = {2: 1, 3: 2, 4: 4, 5: 8, 16: 8}
    inline, word, counts = (8, "<Q", "<HHQ") if big else (4, "<I", "<HHI")
    extra_at = at + len(data)
    entries, extra = b"", b""
    for tag, (kind, value) in sorted(tags.items()):
        if len(value) <= inline:
            place = value.ljust(inline, b"\0")
        else:
            place = struct.pack(word, extra_at + len(extra))
            extra += value + b"\0" * (-len(value) % 8)
        entries += struct.pack(counts, tag, kind, len(value) // size[kind]) + place
    directory = extra_at + len(extra)
    return bytes(data) + extra + struct.pack("<Q" if big else "<H", len(tags)) + entries + struct.pack(word, 0), directory


def _packing(compression: str | None) -> str | None:
    if (compression or "none").lower() not in ("none", "zlib", "deflate", "adobe_deflate"):
        raise ValueError(f"compression {compression} is not written; use zlib or none")
    return None if (compression or "none").lower() == "none" else "zlib"


def _whole(body: bytes, directory: int, big: bool) -> bytes:
    """Body that starts at offset 16, under its header."""
    if not big and 16 + len(body) > 0xFFFFFFFF:
        raise ValueError("over 4 GB only a BigTIFF can hold the file")
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, directory) if big else struct.pack("<2sHI8x", b"II", 42, directory)
    return head + body


def tiff_bytes(mask: np.ndarray, mpp: tuple[float, float], tile: int = 512, description: dict | None = None, big: bool = True, compression: str | None = "zlib") -> bytes:
    """A single page with its resolution in pixels per centimetre."""
    return _whole(*_page(mask, 16, mpp, tile, json.dumps(description or {}, sort_keys=True), [], False, big, _packing(compression)), big)


def ome_tiff_bytes(mask: np.ndarray, mpp: tuple[float, float], tile: int = 512, least: int = 512, big: bool = True, compression: str | None = "zlib") -> bytes:
    """A pyramid: the base page with reduced levels as sub-directories; each level's pixel size doubles."""
    levels = [mask]
    while min(levels[-1].shape[:2]) >= max(2, least):
        levels.append(levels[-1][::2, ::2])
    h, w = mask.shape[:2]
    xml = (
        '<?xml version="1.0" encoding="UTF-8"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels ID="Pixels:0" '
        f'DimensionOrder="XYCZT" Type="uint8" SizeX="{w}" SizeY="{h}" SizeC="{mask.size // (w * h)}" SizeZ="1" SizeT="1" PhysicalSizeX="{mpp[0]}" PhysicalSizeXUnit="µm" '
        f'PhysicalSizeY="{mpp[1]}" PhysicalSizeYUnit="µm"><Channel ID="Channel:0:0" SamplesPerPixel="{mask.size // (w * h)}"/><TiffData/></Pixels></Image></OME>'
    )
    how = big, _packing(compression)
    body, subs = b"", []
    for k, level in enumerate(levels[1:], 1):
        page, at = _page(level, 16 + len(body), (mpp[0] * 2**k, mpp[1] * 2**k), tile, "", [], True, *how)
        body += page + b"\0" * (-len(page) % 8)
        subs.append(at)
    page, directory = _page(mask, 16 + len(body), mpp, tile, xml, subs, False, *how)
    return _whole(body + page, directory, big)


def npy_bytes(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, image)
    return out.getvalue()


def assemble(chunks: DataFrame, width: int, height: int, chunk: int) -> np.ndarray:
    """One canvas on the driver, for export of a single mask file; chunks come one partition at a time."""
    out = np.zeros((height, width), np.uint8)
    for r in chunks.toLocalIterator():
        out[r["cy"] * chunk : r["cy"] * chunk + r["h"], r["cx"] * chunk : r["cx"] * chunk + r["w"]] = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"])
    return out
