"""Frames, patch grids, supertiles and their counts.

All of it is projections and explodes of one row a slide, so planning needs no shuffle until patches are grouped
into supertiles; that grouping sums up per slide and cell before its one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions import geometry as g


def output_frames(slides: DataFrame, target: float = 0.88, use_bounds: bool = True) -> DataFrame:
    """Adds the frame: the scanned bounds, where used and present, else the whole slide, at the target resolution."""
    pick = lambda b, full: F.coalesce(F.col(b), full) if use_bounds else full
    out = slides.withColumns({"origin_x": pick("bnd_x", F.lit(0)), "origin_y": pick("bnd_y", F.lit(0)), "frame_w": pick("bnd_w", F.col("width0")), "frame_h": pick("bnd_h", F.col("height0"))})
    out = out.withColumns({"out_w": g.scaled_size(F.col("frame_w"), F.col("mpp_x"), target), "out_h": g.scaled_size(F.col("frame_h"), F.col("mpp_y"), target)})
    return out.withColumns({"ampp_x": F.col("frame_w") * F.col("mpp_x") / F.col("out_w"), "ampp_y": F.col("frame_h") * F.col("mpp_y") / F.col("out_h")})


def patch_grid(frames: DataFrame, patch: int = 512, stride: int = 384) -> DataFrame:
    """One row per patch; y outer, x inner."""
    ys = frames.withColumn("out_y", F.explode(g.axis_positions(F.col("out_h"), patch, stride)))
    return ys.withColumn("out_x", F.explode(g.axis_positions(F.col("out_w"), patch, stride)))


def crops(patches: DataFrame, patch: int = 512, halo: int = 64) -> DataFrame:
    """Adds the valid crop, its rectangle in the frame (gx1 ...) and in level-0 pixels (lx1 ...)."""
    x, y, w, h = (F.col(c) for c in ("out_x", "out_y", "out_w", "out_h"))
    out = patches.withColumns(g.crop_bounds(x, y, w, h, patch, halo))
    out = out.withColumns({"gx1": x + F.col("crop_left"), "gy1": y + F.col("crop_top"), "gx2": F.least(x + F.col("crop_right"), w), "gy2": F.least(y + F.col("crop_bottom"), h)})
    scale = lambda f, c, o, a, m: (F.col(o) + f(F.col(c) * F.col(a) / F.col(m))).cast("int")
    return out.withColumns({
        "lx1": scale(F.floor, "gx1", "origin_x", "ampp_x", "mpp_x"), "ly1": scale(F.floor, "gy1", "origin_y", "ampp_y", "mpp_y"),
        "lx2": scale(F.ceil, "gx2", "origin_x", "ampp_x", "mpp_x"), "ly2": scale(F.ceil, "gy2", "origin_y", "ampp_y", "mpp_y"),
    })


def flags(patches: DataFrame, patch: int = 512) -> DataFrame:
    """Adds edge (touches or leaves the frame) and padded (leaves it)."""
    x, y, w, h = (F.col(c) for c in ("out_x", "out_y", "out_w", "out_h"))
    padded = (x + patch > w) | (y + patch > h)
    return patches.withColumns({"edge": (x == 0) | (y == 0) | (x + patch >= w) | (y + patch >= h), "padded": padded})


def in_roi(patches: DataFrame, roi: tuple[Column, Column, Column, Column] | None = None) -> DataFrame:
    """Patches whose crop shares a pixel with the region (x1, y1, x2, y2), by default the whole frame."""
    rx1, ry1, rx2, ry2 = roi or (F.lit(0), F.lit(0), F.col("out_w"), F.col("out_h"))
    return patches.filter((F.col("gx2") > F.col("gx1")) & (F.col("gy2") > F.col("gy1"))).filter(g.intersects(*(F.col(c) for c in ("gx1", "gy1", "gx2", "gy2")), rx1, ry1, rx2, ry2))


def supertiles(patches: DataFrame, supertile: int = 4096, patch: int = 512) -> DataFrame:
    """One row per cell of the supertile grid: its box and its patches in the order of y, x."""
    cells = patches.withColumns({"kx": F.expr(f"out_x div {supertile}").cast("int"), "ky": F.expr(f"out_y div {supertile}").cast("int")})
    return cells.groupBy("slide_id", "kx", "ky").agg(
        F.min("out_x").alias("tile_x"), F.min("out_y").alias("tile_y"),
        (F.max("out_x") + patch - F.min("out_x")).alias("tile_w"), (F.max("out_y") + patch - F.min("out_y")).alias("tile_h"),
        F.count(F.lit(1)).alias("n_patches"), F.array_sort(F.collect_list(F.struct("out_y", "out_x"))).alias("patches"),
    )


def planning_summary(grid: DataFrame, supertile: int = 4096, kept: Column | None = None) -> DataFrame:
    """Counts per slide in one pass over the frames' patches, with flags; ``kept`` tells candidates (all, if not given)."""
    kept = F.lit(True) if kept is None else kept
    cell = F.when(kept, F.struct(F.expr(f"out_x div {supertile}"), F.expr(f"out_y div {supertile}")))
    return grid.groupBy("slide_id").agg(
        F.count(F.lit(1)).alias("total_grid"), F.count_if(kept).alias("candidates"), F.count_if(kept & F.col("edge")).alias("edge_patches"),
        F.count_if(kept & F.col("padded")).alias("padded_patches"), F.countDistinct(cell).alias("supertiles"),
    )


def planning_ratios(summary: DataFrame) -> DataFrame:
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return summary.withColumns({"candidate_over_grid": over("candidates", "total_grid"), "candidates_per_supertile": over("candidates", "supertiles")})


def batch_stats(tiles: DataFrame, batch: int = 8) -> DataFrame:
    """Batches never span supertiles."""
    out = tiles.groupBy("slide_id").agg(F.sum(F.ceil(F.col("n_patches") / batch)).cast("long").alias("num_batches"), F.sum("n_patches").cast("long").alias("total_items"))
    return out.withColumn("mean_fill", F.col("total_items") / F.greatest(F.col("num_batches"), F.lit(1)))


def read_addresses(tiles: DataFrame, frames: DataFrame) -> DataFrame:
    """Level-0 place and level-k size of each supertile's read. ``frames`` has level_mpp_x/y of the chosen level.

    Frames are as many as slides, so they are never broadcast.
    """
    j = tiles.join(frames.hint("merge"), "slide_id")
    place = lambda o, c, a, m: (F.col(o) + F.rint(F.col(c) * F.col(a) / F.col(m))).cast("int")
    size = lambda c, a, m: F.greatest(F.lit(1), F.rint(F.col(c) * F.col(a) / F.col(m)).cast("int"))
    return j.withColumns({
        "read_x": place("origin_x", "tile_x", "ampp_x", "mpp_x"), "read_y": place("origin_y", "tile_y", "ampp_y", "mpp_y"),
        "read_w": size("tile_w", "ampp_x", "level_mpp_x"), "read_h": size("tile_h", "ampp_y", "level_mpp_y"),
    })


def plan(slides: DataFrame, cfg: Config) -> DataFrame:
    """Crops of all patches under a configuration, with flags; before the tissue gate."""
    m = cfg.model
    frames = output_frames(slides, m.target_mpp, cfg.schedule.use_bounds)
    return flags(in_roi(crops(patch_grid(frames, m.patch_px, m.stride_px), m.patch_px, m.halo_px)), m.patch_px)
