"""From patch probabilities to masks, previews and pyramids.

Where valid crops overlap, the patch that comes last in the order of (kx, ky, out_y, out_x) wins. Small canvases are
stitched as pixels, by one aggregation with that order as its key, so the order of arrival does not matter. Large
ones are painted in chunks: a patch goes to the chunks that it touches, and each chunk, of bounded size, is painted in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import geometry as g, pixels as px
from ..session import ship


def patch_pixels(patches: DataFrame, patch: int, halo: int, supertile: int, threshold: float = 0.5) -> DataFrame:
    """Pixels of valid crops: canvas, out_w, out_h, x, y, value and the order of writing. ``patches`` has logits as a flat array."""
    keyed = patches.withColumns({"kx": F.expr(f"out_x div {supertile}").cast("int"), "ky": F.expr(f"out_y div {supertile}").cast("int")})
    p = keyed.withColumns(g.crop_bounds(F.col("out_x"), F.col("out_y"), F.col("out_w"), F.col("out_h"), patch, halo))
    flat = p.select("canvas", "out_w", "out_h", "kx", "ky", "out_x", "out_y", "crop_left", "crop_right", "crop_top", "crop_bottom", F.posexplode("logits").alias("i", "logit"))
    lx, ly = F.col("i") % patch, F.expr(f"i div {patch}")
    inside = (lx >= F.col("crop_left")) & (lx < F.col("crop_right")) & (ly >= F.col("crop_top")) & (ly < F.col("crop_bottom"))
    x, y = (F.col("out_x") + lx).cast("int"), (F.col("out_y") + ly).cast("int")
    value = px.over_threshold(px.sigmoid(F.col("logit").cast("double")), threshold)
    return flat.filter(inside & (x < F.col("out_w")) & (y < F.col("out_h"))).select("canvas", "out_w", "out_h", x.alias("x"), y.alias("y"), value.alias("value"), F.struct("kx", "ky", "out_y", "out_x").alias("order"))


def stitch(pixels: DataFrame) -> DataFrame:
    """The last writer of each pixel."""
    return pixels.groupBy("canvas", "x", "y").agg(F.max_by("value", "order").alias("mask"))


def paint_chunks(patches: DataFrame, patch: int, halo: int, supertile: int, chunk: int = 1024, threshold: float = 0.5, packed: bool = False) -> DataFrame:
    """Chunks of at most chunk x chunk pixels: canvas, cx, cy, w, h and data (``packed``: eight pixels a byte); chunks that no patch touches are absent.

    ``patches`` has probs, a binary of float32. A task paints one chunk from the patches that touch it, whose
    number is bounded by the geometry.
    """
    ship(patches.sparkSession)
    p = patches.withColumns({"kx": F.expr(f"out_x div {supertile}").cast("int"), "ky": F.expr(f"out_y div {supertile}").cast("int")})
    p = p.withColumns(g.crop_bounds(F.col("out_x"), F.col("out_y"), F.col("out_w"), F.col("out_h"), patch, halo))
    x1, y1 = F.col("out_x") + F.col("crop_left"), F.col("out_y") + F.col("crop_top")
    x2, y2 = F.least(F.col("out_x") + F.col("crop_right"), F.col("out_w")), F.least(F.col("out_y") + F.col("crop_bottom"), F.col("out_h"))
    p = p.withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2}).filter("x2 > x1 and y2 > y1")
    p = p.withColumn("cx", F.explode(F.expr(f"sequence(x1 div {chunk}, (x2 - 1) div {chunk})"))).withColumn("cy", F.explode(F.expr(f"sequence(y1 div {chunk}, (y2 - 1) div {chunk})")))

    def paint(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        canvas, cx, cy = key
        w, h = min(chunk, int(pdf.out_w.iloc[0]) - cx * chunk), min(chunk, int(pdf.out_h.iloc[0]) - cy * chunk)
        out = np.zeros((h, w), np.uint8)
        for r in pdf.sort_values(["kx", "ky", "out_y", "out_x"]).itertuples():
            bits = (np.frombuffer(r.probs, np.float32).reshape(patch, patch) >= np.float32(threshold)).astype(np.uint8)
            a, b, c, d = max(r.x1, cx * chunk), max(r.y1, cy * chunk), min(r.x2, cx * chunk + w), min(r.y2, cy * chunk + h)
            out[b - cy * chunk : d - cy * chunk, a - cx * chunk : c - cx * chunk] = bits[b - r.out_y : d - r.out_y, a - r.out_x : c - r.out_x]
        return pd.DataFrame({"canvas": [canvas], "cx": [cx], "cy": [cy], "w": [w], "h": [h], "data": [(np.packbits(out) if packed else out).tobytes()]})

    kind = dict(patches.dtypes)["canvas"]
    columns = ["canvas", "out_w", "out_h", "out_x", "out_y", "kx", "ky", "x1", "y1", "x2", "y2", "cx", "cy", "probs"]
    return p.select(columns).groupBy("canvas", "cx", "cy").applyInPandas(paint, f"canvas {kind}, cx int, cy int, w int, h int, data binary")


def pyramid(mask: DataFrame, least: int = 4) -> DataFrame:
    """Levels of a mask by dropping every other row and column of the level above, while that has ``least`` pixels on both sides."""
    sizes = mask.groupBy("canvas").agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"))
    levels = sizes.select("canvas", F.explode(F.sequence(F.lit(0), g.pyramid_levels(F.col("w"), F.col("h"), least))).alias("level"))
    step = F.expr("shiftleft(1, level)")
    on = mask.join(levels, "canvas").filter((F.col("x") % step == 0) & (F.col("y") % step == 0))
    return on.select("canvas", "level", F.expr("cast(x div shiftleft(1, level) as int)").alias("x"), F.expr("cast(y div shiftleft(1, level) as int)").alias("y"), "mask")


def preview(mask: DataFrame, sizes: DataFrame, width: int, height: int) -> DataFrame:
    """Nearest-neighbour preview of width x height, ×255. ``sizes``: canvas, w, h."""
    grid = sizes.withColumn("py", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("px", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    src = grid.select("canvas", "px", "py", g.nearest_source(F.col("px"), F.col("w"), F.lit(width)).alias("x"), g.nearest_source(F.col("py"), F.col("h"), F.lit(height)).alias("y"))
    return src.join(mask, ["canvas", "x", "y"], "left").select("canvas", "px", "py", (F.coalesce("mask", F.lit(0)) * 255).alias("value"))
