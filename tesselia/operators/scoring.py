"""Scoring of patches by a pluggable model, and the image kernels around it.

A scorer takes a batch of uint8 patches (n, p, p, 3) and returns an output in any of the forms that ``to_probs`` reads.
It is loaded once a Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship

Scorer = Callable[[np.ndarray], object]


def unwrap(output: object) -> np.ndarray:
    """An array; the first of a list or tuple; of a dict the entry named logits, out, pred or prediction, else any array."""
    if isinstance(output, dict):
        named = [output[k] for k in ("logits", "out", "pred", "prediction") if k in output]
        output = (named + [v for v in output.values() if hasattr(v, "shape")] + [None])[0]
    elif isinstance(output, (list, tuple)) and output:
        output = output[0]
    if not hasattr(output, "shape"):
        raise TypeError(f"no array in a model's output of type {type(output).__name__}")
    return np.asarray(output)


def to_probs(output: object, patch: int, apply_sigmoid: bool = True) -> np.ndarray:
    """(n, patch, patch) probabilities: one channel or none by the sigmoid if wanted, two channels always by softmax."""
    a = unwrap(output).astype(np.float32)
    sig = lambda x: np.float32(1) / (np.float32(1) + np.exp(-x)) if apply_sigmoid else x
    if a.ndim == 4 and a.shape[1] == 1:
        p = sig(a[:, 0])
    elif a.ndim == 4 and a.shape[1] == 2:
        p = np.float32(1) / (np.float32(1) + np.exp(a[:, 0] - a[:, 1]))
    elif a.ndim == 3:
        p = sig(a)
    else:
        raise ValueError(f"outputs of shape {a.shape} are not known")
    return p if p.shape[-2:] == (patch, patch) else np.stack([resize_linear(x, patch, patch) for x in p])


def resize_linear(a: np.ndarray, h: int, w: int) -> np.ndarray:
    """Linear interpolation between pixel centres, edges held."""

    def axis(n_in: int, n_out: int):
        at = np.clip((np.arange(n_out) + 0.5) * n_in / n_out - 0.5, 0, n_in - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n_in - 1), (at - low).astype(np.float32)

    y0, y1, fy = axis(a.shape[0], h)
    x0, x1, fx = axis(a.shape[1], w)
    rows = a[y0] * (1 - fy)[:, None] + a[y1] * fy[:, None]
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def resize_area(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Triangle filter, widened when shrinking, on uint8 (rows, columns[, channels]); rounded and clipped after each axis."""

    def along(a: np.ndarray, n_out: int) -> np.ndarray:
        n_in = a.shape[0]
        scale = max(n_in / n_out, 1.0)
        out = np.empty((n_out, *a.shape[1:]), np.float64)
        for i in range(n_out):
            centre = (i + 0.5) * n_in / n_out
            k = np.arange(max(0, int(centre - scale + 0.5)), min(n_in, int(centre + scale + 0.5)))
            weight = np.maximum(0, 1 - np.abs((k + 0.5 - centre) / scale))
            out[i] = np.tensordot(weight / weight.sum(), a[k].astype(np.float64), 1)
        return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)

    wide = image if image.shape[1] == w else np.swapaxes(along(np.swapaxes(image, 0, 1), w), 0, 1)
    return wide if wide.shape[0] == h else along(wide, h)


def composite(rgba: np.ndarray, background: tuple[int, int, int]) -> np.ndarray:
    """RGBA over an opaque background."""
    a = rgba[..., 3:].astype(np.uint32)
    mix = rgba[..., :3].astype(np.uint32) * a + np.array(background, np.uint32) * (255 - a)
    return ((mix + 127) // 255).astype(np.uint8)


def overlay(rgb: np.ndarray, mask: np.ndarray, colour: tuple[int, int, int] = (0, 255, 0), alpha: int = 96) -> np.ndarray:
    layer = np.zeros((*mask.shape, 4), np.uint8)
    layer[mask > 0] = (*colour, alpha)
    a = layer[..., 3:].astype(np.uint32)
    return ((layer[..., :3].astype(np.uint32) * a + rgb.astype(np.uint32) * (255 - a) + 127) // 255).astype(np.uint8)


def resize_nearest(a: np.ndarray, h: int, w: int) -> np.ndarray:
    at = lambda n, k: np.minimum(((np.arange(n) + 0.5) * k / n).astype(int), k - 1)
    return a[at(h, a.shape[0])][:, at(w, a.shape[1])]


def place_mask(mask: np.ndarray, shape: tuple[int, int], full: tuple[int, int], frame: tuple[int, int, int, int]) -> np.ndarray:
    """A frame's mask on a thumbnail (rows, columns) of the whole slide; ``full`` and ``frame`` are in level-0 pixels."""
    (th, tw), (fw, fh), (x, y, w, h) = shape, full, frame
    px, py, pw, ph = round(x * tw / fw), round(y * th / fh), max(1, round(w * tw / fw)), max(1, round(h * th / fh))
    out = np.zeros((th, tw), np.uint8)
    a, b, c, d = max(0, px), max(0, py), min(tw, px + pw), min(th, py + ph)
    if c > a and d > b:
        out[b:d, a:c] = resize_nearest(mask, ph, pw)[b - py : d - py, a - px : c - px]
    return out


def mean_darkness(batch: np.ndarray) -> np.ndarray:
    """The built-in scorer: darker pixels get higher logits."""
    return ((127.5 - batch.astype(np.float32).mean(3)) / 16)[:, None]


def torchscript(path: str) -> Scorer:
    """A TorchScript file; needs torch, which is optional."""
    try:
        import torch
    except ImportError as e:
        raise RuntimeError("TorchScript models need the torch package") from e
    model = torch.jit.load(path, map_location="cpu").eval()

    def score(batch: np.ndarray):
        with torch.inference_mode():
            out = model(torch.from_numpy(batch.astype(np.float32).transpose(0, 3, 1, 2) / 255))
        return {k: v.numpy() for k, v in out.items()} if isinstance(out, dict) else out[0].numpy() if isinstance(out, (list, tuple)) else out.numpy()

    return score


@lru_cache(maxsize=2)
def scorer_for(path: str | None) -> Scorer:
    return torchscript(path) if path else mean_darkness


def score_supertiles(tiles: DataFrame, patch: int, batch: int = 8, apply_sigmoid: bool = True, model_path: str | None = None) -> DataFrame:
    """Probabilities of each patch of each supertile.

    ``tiles``: canvas, tile_x, tile_y, tile_w, tile_h, patches (array of structs out_y, out_x), image (binary, RGB rows) and out_w, out_h. One
    supertile is in memory at a time; batches stay within it, and results leave in frames of bounded size.
    """
    ship(tiles.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer_for(model_path)
        names = ["canvas", "out_x", "out_y", "out_w", "out_h", "probs"]
        rows, held = [], 0
        for pdf in frames:
            for r in pdf.itertuples():
                image = np.frombuffer(r.image, np.uint8).reshape(r.tile_h, r.tile_w, 3)
                places = [(p["out_y"], p["out_x"]) for p in r.patches]
                for i in range(0, len(places), batch):
                    some = places[i : i + batch]
                    crops = np.stack([image[y - r.tile_y : y - r.tile_y + patch, x - r.tile_x : x - r.tile_x + patch] for y, x in some])
                    probs = to_probs(score(crops), patch, apply_sigmoid).astype(np.float32)
                    rows += [(r.canvas, x, y, r.out_w, r.out_h, p.tobytes()) for (y, x), p in zip(some, probs)]
                    held += probs.nbytes
                    if held >= 1 << 25:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    kind = dict(tiles.dtypes)["canvas"]
    return tiles.select("canvas", "tile_x", "tile_y", "tile_w", "tile_h", "patches", "image", "out_w", "out_h").mapInPandas(run, f"canvas {kind}, out_x int, out_y int, out_w int, out_h int, probs binary")


def probe(score: Scorer, patch: int) -> dict:
    """Shapes and kind of a scorer's output for one patch of zeros."""
    shape = unwrap(score(np.zeros((1, patch, patch, 3), np.uint8))).shape
    kind = {(4, 1): "binary_logits_1ch", (4, 2): "binary_logits_2ch"}.get((len(shape), shape[1] if len(shape) > 1 else 0), "hw" if len(shape) == 3 else "unknown")
    return {"input_shape": (1, 3, patch, patch), "output_shape": tuple(shape), "output_kind": kind}
