"""Tissue masks of thumbnails: threshold, morphology, integral image and the patch gate.

A thumbnail is one row with its pixels as bytes. ``tissue_images`` does all of the chain in one Arrow pass over such rows, without a
shuffle; thumbnails of one size are worked on together, about ``most`` pixels at a time. The long forms below, a pixel a row, are for
histograms and thresholds in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import pixels as px
from ..session import ship


def gray_hsv(thumbs: DataFrame) -> DataFrame:
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    return thumbs.withColumns({"gray": px.gray(r, g, b), "sat": px.saturation(r, g, b), "val": F.greatest(r, g, b)})


def otsu(pixels: DataFrame) -> DataFrame:
    """Threshold per slide: the gray value, first of equals, with the largest variance between classes; 0 if all are equal."""
    hist = pixels.groupBy("slide_id", "gray").agg(F.count(F.lit(1)).alias("n"))
    upto, whole = W.partitionBy("slide_id").orderBy("gray").rowsBetween(W.unboundedPreceding, 0), W.partitionBy("slide_id")
    h = hist.select("slide_id", "gray", F.sum("n").over(upto).alias("wb"), F.sum(F.col("gray") * F.col("n")).over(upto).alias("sb"), F.sum("n").over(whole).alias("total"), F.sum(F.col("gray") * F.col("n")).over(whole).alias("all"))
    wf = F.col("total") - F.col("wb")
    diff = F.try_divide(F.col("sb"), F.col("wb")) - F.try_divide(F.col("all") - F.col("sb"), wf)
    between = F.col("wb").cast("double") * wf * diff * diff
    best = F.max_by("gray", F.when(wf > 0, F.struct(between.alias("v"), -F.col("gray"))))
    return h.groupBy("slide_id").agg(F.coalesce(best, F.lit(0)).alias("otsu"))


def thresholds(gray: np.ndarray) -> np.ndarray:
    """As ``otsu``, for each of the images (first axis)."""
    n = len(gray)
    hist = np.bincount((gray.reshape(n, -1) + 256 * np.arange(n)[:, None]).ravel(), minlength=256 * n).reshape(n, 256)
    wb, sb = hist.cumsum(1), (hist * np.arange(256)).cumsum(1)
    wf = wb[:, -1:] - wb
    with np.errstate(divide="ignore", invalid="ignore"):
        diff = sb / wb - (sb[:, -1:] - sb) / wf
        between = np.where((hist > 0) & (wf > 0), wb.astype(float) * wf * diff * diff, -1.0)
    return np.where(between.max(1) >= 0, between.argmax(1), 0)


def spread_lines(mask: np.ndarray, radius: int, pick) -> np.ndarray:
    """Maximum or minimum over truncated squares, as passes along both axes of each image."""
    for axis in (1, 2):
        src, out = np.moveaxis(mask, axis, -1), np.moveaxis(mask, axis, -1).copy()
        for k in range(1, min(radius, src.shape[-1] - 1) + 1):
            out[..., k:] = pick(out[..., k:], src[..., :-k])
            out[..., :-k] = pick(out[..., :-k], src[..., k:])
        mask = np.moveaxis(out, -1, axis)
    return mask


def close_open(mask: np.ndarray) -> np.ndarray:
    """Close with 5, open with 3."""
    for pick, radius in ((np.maximum, 2), (np.minimum, 2), (np.minimum, 1), (np.maximum, 1)):
        mask = spread_lines(mask, radius, pick)
    return mask


def rgb_masks(rgb: np.ndarray, sat_least: int, white: int) -> np.ndarray:
    """Raw masks (0 or 1) of images (n, h, w, 3)."""
    r, g, b = (rgb[..., k].astype(np.int32) for k in range(3))
    gray = (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16
    hi, lo = rgb.max(-1).astype(np.int32), rgb.min(-1).astype(np.int32)
    ratio = ((hi - lo) / np.maximum(hi, 1)).astype(np.float32).astype(np.float64)
    sat = np.where(hi == lo, 0, np.floor(ratio * 255)).astype(np.int32)
    return ((gray < thresholds(gray)[:, None, None]) | ((sat >= sat_least) & (hi < white))).astype(np.int8)


def tissue_images(thumbs: DataFrame, sat: int = 18, white: int = 235, most: int = 1 << 22) -> DataFrame:
    """slide_id, thumb_w, thumb_h, raw and mask (0 or 1, row by row) and sums, the inclusive integral image.

    ``thumbs``: slide_id, thumb_w, thumb_h and rgb (bytes, row by row).
    """
    ship(thumbs.sparkSession)
    names = ["slide_id", "thumb_w", "thumb_h", "raw", "mask", "sums"]

    def lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        ends = np.arange(len(x) + 1, dtype=np.int32) * (x.size // max(1, len(x)))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, h = (batch.column(k).to_numpy() for k in (1, 2))
            size = w.astype(np.int64) << 32 | h
            for one in np.unique(size):
                rows = np.flatnonzero(size == one)
                n = int(max(1, most // max(1, w[rows[0]] * h[rows[0]])))
                for at in range(0, len(rows), n):
                    some = pa.array(rows[at : at + n])
                    own = batch.take(some)
                    rgb = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in own.column(3)]).reshape(len(some), h[rows[0]], w[rows[0]], 3)
                    raw = rgb_masks(rgb, sat, white)
                    mask = close_open(raw)
                    sums = mask.cumsum(2, dtype=np.int32).cumsum(1, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([*own.columns[:3], lists(raw, pa.int8()), lists(mask, pa.int8()), lists(sums, pa.int32())], names)

    kind = dict(thumbs.dtypes)["slide_id"]
    return thumbs.select("slide_id", F.col("thumb_w").cast("int"), F.col("thumb_h").cast("int"), "rgb").mapInArrow(run, f"slide_id {kind}, thumb_w int, thumb_h int, raw array<tinyint>, mask array<tinyint>, sums array<int>")


def cells(images: DataFrame, column: str, name: str) -> DataFrame:
    """slide_id, tx, ty and the value of each cell."""
    e = images.select("slide_id", "thumb_w", F.posexplode(column).alias("at", "v"))
    return e.select("slide_id", (F.col("at") % F.col("thumb_w")).alias("tx"), F.expr("cast(at div thumb_w as int)").alias("ty"), F.col("v").cast("int").alias(name))


def with_sums(slides: DataFrame, images: DataFrame) -> DataFrame:
    """Adds thumb_w, thumb_h and sums to rows of slides, or of their frames before patches are made of them.

    A thumbnail's arrays are far wider than estimates from file sizes tell, so no side is broadcast.
    """
    return slides.join(images.select("slide_id", "thumb_w", "thumb_h", "sums").hint("merge"), "slide_id", "left")


def fraction(j: DataFrame) -> DataFrame:
    """Adds the tissue fraction of the level-0 rectangle of each patch ``with_sums`` by four lookups; 0 for an empty rectangle or no thumbnail."""
    w, h = F.col("thumb_w"), F.col("thumb_h")
    clip = lambda v, top: F.least(F.greatest(v, F.lit(0)), top).cast("int")
    j = j.withColumns({
        "tx1": clip(F.floor(F.col("lx1") * w / F.col("width0")), w), "tx2": clip(F.ceil(F.col("lx2") * w / F.col("width0")), w),
        "ty1": clip(F.floor(F.col("ly1") * h / F.col("height0")), h), "ty2": clip(F.ceil(F.col("ly2") * h / F.col("height0")), h),
    })
    at = lambda x, y: F.when((F.col(x) == 0) | (F.col(y) == 0), 0).otherwise(F.get("sums", (F.col(y) - 1) * w + F.col(x) - 1))
    area = (F.col("tx2") - F.col("tx1")) * (F.col("ty2") - F.col("ty1"))
    inside = at("tx2", "ty2") - at("tx1", "ty2") - at("tx2", "ty1") + at("tx1", "ty1")
    empty = (F.col("tx2") <= F.col("tx1")) | (F.col("ty2") <= F.col("ty1"))
    return j.withColumn("fraction", F.when(empty, 0.0).otherwise(F.coalesce(F.try_divide(inside.cast("double"), area), F.lit(0.0))))


def with_fraction(patches: DataFrame, images: DataFrame) -> DataFrame:
    """``fraction`` of patches that have no sums yet. Joining frames ``with_sums`` first moves a row a slide, not one a patch."""
    return fraction(with_sums(patches, images))


def tissue_gate(patches: DataFrame, images: DataFrame | None = None, least: float = 0.03) -> DataFrame:
    """Adds kept: whether enough of the patch is tissue. Without ``images`` the patches have their sums."""
    return (fraction(patches) if images is None else with_fraction(patches, images)).withColumn("kept", F.col("fraction") >= least).drop("sums")
