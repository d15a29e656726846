"""Slide files: PPM, NPY, TIFF and, where OpenSlide is installed, all that it opens.

An open slide has ``backend``, ``detected`` (format), ``props`` (strings), ``sizes`` (width and height of each level, finest first) and
``pixels(level, x, y, w, h)``, which gives RGB or RGBA rows of a rectangle inside the level. Files are memory-mapped and only the strips or tiles
that a rectangle touches are decoded.
"""

from __future__ import annotations

import re
import zlib
from pathlib import Path

import numpy as np

from ..operators.scoring import composite, resize_area

#: Suffixes of plain rasters, beside those of slides.
RASTERS = (".ppm", ".npy")

#: Field types of TIFF: type number to (NumPy type, values a count). Fixed values.
FIELDS = {1: ("u1", 1), 2: ("u1", 1), 3: ("u2", 1), 4: ("u4", 1), 5: ("u4", 2), 6: ("i1", 1), 7: ("u1", 1), 8: ("i2", 1), 9: ("i4", 1), 10: ("i4", 2), 11: ("f4", 1), 12: ("f8", 1), 13: ("u4", 1), 16: ("u8", 1), 17: ("i8", 1), 18: ("u8", 1)}


class RasterSlide:
    """One level without metadata; ``mpp`` is stated by the reader."""

    backend, detected = "raster", "raster"

    def __init__(self, path: str, mpp: float):
        self.props = {"mpp_x": str(mpp), "mpp_y": str(mpp)}
        if Path(path).suffix.lower() == ".npy":
            self.image = np.load(path, mmap_mode="r", allow_pickle=False)
        else:
            with open(path, "rb") as f:
                m = re.match(rb"P6\s+(?:#[^\n]*\s+)*(\d+)\s+(\d+)\s+255\s", f.read(4096))
            if not m:
                raise ValueError(f"{path} is no binary PPM of 8 bits")
            self.image = np.memmap(path, np.uint8, "r", m.end(), (int(m[2]), int(m[1]), 3))
        self.sizes = [(self.image.shape[1], self.image.shape[0])]

    def pixels(self, level: int, x: int, y: int, w: int, h: int) -> np.ndarray:
        return np.asarray(self.image[y : y + h, x : x + w])


class TiffSlide:
    """TIFF and BigTIFF of 8 bits a sample: strips or tiles, stored or deflated, gray, RGB or RGBA, chunky.

    Levels are the first page and those pages, in the chain or under it, that have its shape reduced. JPEG and JPEG 2000 need OpenSlide.
    """

    backend = "tiff"

    def __init__(self, path: str):
        self.path, self.data = path, np.memmap(path, np.uint8, "r")
        head = self.data[:16].tobytes()
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        version = int(np.frombuffer(head, order + "u2", 1, 2)[0]) if order else 0
        if version not in (42, 43):
            raise ValueError(f"{path} is no TIFF")
        self.order, self.big = order, version == 43
        pages, at, seen, subs = [], self._number("u8", 8) if self.big else self._number("u4", 4), set(), set()
        while at and at not in seen:
            seen.add(at)
            page, at = self._page(at)
            pages.append(page)
            under = [self._page(int(sub))[0] for sub in page.get(330, ())]
            pages += under
            subs |= {id(p) for p in under}
        base = pages[0]
        w, h = self._size(base)
        # Labels and macro images have another shape than the slide; thumbnails are in strips where the slide is in tiles.
        alike = [p for p in pages[1:] for a, b in [self._size(p)] if a < w and abs(a / b - w / h) <= 0.02 * w / h + w / h / b and (322 in p or 322 not in base or id(p) in subs)]
        self.levels = [base, *sorted(alike, key=lambda p: -self._size(p)[0])]
        self.sizes = [self._size(p) for p in self.levels]
        self.props = self._props(base)
        self.detected = self.props["openslide.vendor"]

    def _number(self, kind: str, at: int) -> int:
        size = int(kind[1])
        return int(np.frombuffer(self.data[at : at + size].tobytes(), self.order + kind)[0])

    def _page(self, at: int) -> tuple[dict[int, np.ndarray], int]:
        """Tags of the directory at an offset, and the offset of the next."""
        n, at, step, inline = (self._number("u8", at), at + 8, 20, 8) if self.big else (self._number("u2", at), at + 2, 12, 4)
        tags = {}
        for at in range(at, at + n * step, step):
            tag, kind, count = self._number("u2", at), self._number("u2", at + 2), self._number("u8" if self.big else "u4", at + 4)
            if kind in FIELDS:
                name, each = FIELDS[kind]
                size, place = count * each * int(name[1]), at + step - inline
                start = place if size <= inline else self._number("u8" if self.big else "u4", place)
                tags[tag] = np.frombuffer(self.data[start : start + size].tobytes(), self.order + name)
        return tags, self._number("u8" if self.big else "u4", at + step)

    @staticmethod
    def _size(page: dict) -> tuple[int, int]:
        return int(page[256][0]), int(page[257][0])

    @staticmethod
    def _props(page: dict) -> dict[str, str]:
        """Properties under OpenSlide's names. Aperio writes ``name = value`` pairs between bars."""
        text = page[270].tobytes().rstrip(b"\0").decode("utf-8", "replace") if 270 in page else ""
        props = {"openslide.vendor": "aperio" if text.startswith("Aperio") else "generic-tiff"}
        if text:
            props |= {"tiff.ImageDescription": text, "openslide.comment": text}
        for tag, name in ((282, "tiff.XResolution"), (283, "tiff.YResolution")):
            if tag in page and page[tag][1]:
                props[name] = repr(float(page[tag][0]) / float(page[tag][1]))
        if {282, 283} & set(page):
            props["tiff.ResolutionUnit"] = {1: "none", 3: "centimeter"}.get(int(page[296][0]) if 296 in page else 2, "inch")
        if text.startswith("Aperio"):
            props |= {f"aperio.{k.strip()}": v.strip() for k, eq, v in (part.partition("=") for part in text.split("|")[1:]) if eq}
        return props

    def _block(self, page: dict, n: int, w: int, h: int, channels: int) -> np.ndarray:
        at, size = (int(page[324 if 322 in page else 273][n]), int(page[325 if 322 in page else 279][n]))
        packing = int(page[259][0]) if 259 in page else 1
        if size == 0:
            return np.full((h, w, channels), 255, np.uint8)
        raw = self.data[at : at + size].tobytes()
        if packing in (8, 32946):
            raw = zlib.decompress(raw)
        elif packing != 1:
            raise ValueError(f"{self.path}: compression {packing} needs OpenSlide")
        out = np.frombuffer(raw, np.uint8, w * h * channels).reshape(h, w, channels)
        return np.cumsum(out, 1, dtype=np.uint8) if 317 in page and page[317][0] == 2 else out

    def pixels(self, level: int, x: int, y: int, w: int, h: int) -> np.ndarray:
        page = self.levels[level]
        width, height = self.sizes[level]
        channels = int(page[277][0]) if 277 in page else 1
        bits, kind = set(page[258].tolist()) if 258 in page else {1}, int(page[262][0])
        if bits != {8} or kind not in (0, 1, 2) or channels not in (1, 3, 4) or (channels > 1 and 284 in page and page[284][0] != 1):
            raise ValueError(f"{self.path}: pixels of this layout need OpenSlide")
        tw, th = (int(page[322][0]), int(page[323][0])) if 322 in page else (width, min(height, int(page[278][0])) if 278 in page else height)
        across = -(-width // tw)
        out = np.empty((h, w, channels), np.uint8)
        for row in range(y // th, -(-(y + h) // th)):
            for col in range(x // tw, -(-(x + w) // tw)):
                rows = th if 322 in page else min(th, height - row * th)
                block = self._block(page, row * across + col, tw, rows, channels)
                a, b, c, d = max(x, col * tw), max(y, row * th), min(x + w, (col + 1) * tw), min(y + h, row * th + rows)
                out[b - y : d - y, a - x : c - x] = block[b - row * th : d - row * th, a - col * tw : c - col * tw]
        if kind == 0:
            out = 255 - out
        return np.repeat(out, 3, 2) if channels == 1 else out


class OpenSlideFile:
    """What OpenSlide opens; its package is optional."""

    def __init__(self, path: str):
        import openslide

        self.slide = openslide.open_slide(path)
        self.backend, self.detected = type(self.slide).__name__, openslide.OpenSlide.detect_format(path)
        self.props = {k: str(v) for k, v in dict(getattr(self.slide, "properties", {})).items()}
        self.sizes = [tuple(s) for s in self.slide.level_dimensions]

    def pixels(self, level: int, x: int, y: int, w: int, h: int) -> np.ndarray:
        scale = self.slide.level_downsamples[level]
        return np.asarray(self.slide.read_region((round(x * scale), round(y * scale)), level, (w, h)))


def open_slide(path: str, mpp: float = 0.5):
    """An open slide. Rasters have ``mpp`` microns a pixel. OpenSlide goes first for other suffixes, where it is installed and knows the file."""
    if Path(path).suffix.lower() in RASTERS:
        return RasterSlide(path, mpp)
    try:
        return OpenSlideFile(path)
    except ImportError:
        pass
    except Exception as e:
        if type(e).__name__ not in ("OpenSlideUnsupportedFormatError", "UnidentifiedImageError"):
            raise
    if Path(path).suffix.lower() not in (".tif", ".tiff", ".svs"):
        raise RuntimeError(f"{path} needs OpenSlide")
    return TiffSlide(path)


def downsamples(sizes: list[tuple[int, int]]) -> list[float]:
    """Of each level against the first: the mean of both axes."""
    w, h = sizes[0]
    return [(w / a + h / b) / 2 for a, b in sizes]


def region(slide, level: int, x0: int, y0: int, w: int, h: int, background: tuple[int, int, int] = (255, 255, 255)) -> np.ndarray:
    """RGB rows of w x h pixels of a level, from a place in level-0 pixels. Outside of the slide, and under transparency, is background."""
    scale = downsamples(slide.sizes)[level]
    x, y = int(x0 // scale), int(y0 // scale)
    out = np.empty((h, w, 3), np.uint8)
    out[:] = background
    a, b, c, d = max(0, x), max(0, y), min(x + w, slide.sizes[level][0]), min(y + h, slide.sizes[level][1])
    if c > a and d > b:
        part = slide.pixels(level, a, b, c - a, d - b)
        out[b - y : d - y, a - x : c - x] = composite(part, background) if part.shape[2] == 4 else part
    return out


def thumbnail(slide, most: int, background: tuple[int, int, int] = (255, 255, 255), strip: int = 1024) -> np.ndarray:
    """RGB within most x most pixels, of the coarsest level that is not smaller; read in strips, narrowed one by one."""
    w0, h0 = slide.sizes[0]
    s = min(1.0, most / max(w0, h0))
    w, h = max(1, round(w0 * s)), max(1, round(h0 * s))
    level = max(k for k, (a, b) in enumerate(slide.sizes) if k == 0 or (a >= w and b >= h))
    lw, lh = slide.sizes[level]
    rows = []
    for y in range(0, lh, strip):
        part = slide.pixels(level, 0, y, lw, min(strip, lh - y))
        rows.append(resize_area(composite(part, background) if part.shape[2] == 4 else part, len(part), w))
    return resize_area(np.concatenate(rows), h, w)
