"""Frames, patches, crops and pyramids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def scaled_size(size: Column, mpp: Column, target: float) -> Column:
    """Pixels at the target resolution: half to even, at least one."""
    return F.greatest(F.lit(1), F.rint(size * mpp / F.lit(target)).cast("int"))


def axis_positions(length: Column, patch: int, stride: int) -> Column:
    """Patch starts along an axis: each stride, and one that ends with the axis."""
    last = F.greatest(length - patch, F.lit(0))
    steps = F.array_distinct(F.array_append(F.sequence(F.lit(0), last, F.lit(stride)), last))
    return F.when(length <= patch, F.array(F.lit(0))).otherwise(steps)


def crop_bounds(x: Column, y: Column, out_w: Column, out_h: Column, patch: int, halo: int) -> dict[str, Column]:
    """The valid part of a patch: halos are cut off except at the frame's edges."""
    return {
        "crop_left": F.when(x == 0, 0).otherwise(halo), "crop_top": F.when(y == 0, 0).otherwise(halo),
        "crop_right": F.when(x + patch >= out_w, patch).otherwise(patch - halo), "crop_bottom": F.when(y + patch >= out_h, patch).otherwise(patch - halo),
    }


def intersects(x1: Column, y1: Column, x2: Column, y2: Column, rx1, ry1, rx2, ry2) -> Column:
    """Whether two half-open rectangles share a pixel."""
    return ~((x2 <= rx1) | (y2 <= ry1) | (x1 >= rx2) | (y1 >= ry2))


def tile_option(w: Column, h: Column, tile: Column) -> Column:
    return F.when((tile > 0) & (w >= tile) & (h >= tile), tile)


def pixels_per_cm(mpp: Column) -> Column:
    return F.lit(10000.0) / mpp


def pyramid_levels(w: Column, h: Column, least: int) -> Column:
    """How many levels lie below the base: a level is halved (rounded up, as decimation by two gives) while both its sides have ``least`` pixels."""
    bound = max(2, least)
    half = lambda s: F.struct(F.ceil(s["w"] / 2).cast("int").alias("w"), F.ceil(s["h"] / 2).cast("int").alias("h"), s["n"].alias("n"))

    def step(s, _):
        t = half(s)
        return F.when(F.least(s["w"], s["h"]) >= bound, F.struct(t["w"].alias("w"), t["h"].alias("h"), (s["n"] + 1).alias("n"))).otherwise(s)

    start = F.struct(w.cast("int").alias("w"), h.cast("int").alias("h"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), start, step, lambda s: s["n"])


def oversample(mpp_x: Column, mpp_y: Column, target: float) -> Column:
    return F.greatest(F.lit(target) / mpp_x, F.lit(target) / mpp_y)


def nearest_level(levels: Column, target: float) -> Column:
    """The level whose larger error over both axes is smallest; the first of equals."""
    scored = F.transform(levels, lambda v: F.struct(F.greatest(F.abs(v["mpp_x"] - target), F.abs(v["mpp_y"] - target)).alias("score"), v["index"].alias("index"), v.alias("level")))
    return F.array_min(scored)["level"]


def finer_level(levels: Column, target: float, cap: float | None = None) -> Column:
    """Of levels at least as fine as the target on both axes (and oversampled by at most ``cap``) the coarsest; null if none."""
    ok = lambda v: (v["mpp_x"] <= target) & (v["mpp_y"] <= target) & (oversample(v["mpp_x"], v["mpp_y"], target) <= cap if cap else F.lit(True))
    scored = F.transform(F.filter(levels, ok), lambda v: F.struct((-(v["mpp_x"] + v["mpp_y"]) / 2).alias("score"), v["index"].alias("index"), v.alias("level")))
    return F.when(F.size(scored) > 0, F.array_min(scored)["level"])


def choose_level(levels: Column, target: float, policy: str = "nearest", cap: float = 2.0) -> Column:
    near = nearest_level(levels, target)
    if policy == "nearest":
        return near
    return F.coalesce(finer_level(levels, target, cap if policy == "prefer_higher_bounded" else None), near)


def nearest_source(i: Column, src: Column, dst: Column) -> Column:
    """The source pixel of nearest-neighbour resampling: floor((i + 0.5) * src / dst)."""
    return F.floor((i + F.lit(0.5)) * src / dst).cast("int")
