"""Queries by name; each takes a session and a folder of tables."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geometry as g, parsing as ps, pixels as px
from ..operators import planning as pl, runs as rn, scoring as sc, stitching as st, tissue as ts
from ..session import ship
from . import views as v


def frames(s: SparkSession, sf: str) -> DataFrame:
    return pl.output_frames(v.slides(s, sf), v.TARGET)


def planned(s: SparkSession, sf: str, of: DataFrame | None = None) -> DataFrame:
    return pl.flags(pl.in_roi(pl.crops(pl.patch_grid(frames(s, sf) if of is None else of, v.PATCH, v.STRIDE), v.PATCH, v.HALO)), v.PATCH)


def planned_sums(s: SparkSession, sf: str) -> DataFrame:
    """``planned`` with each slide's integral image, which joins the frames before there are patches."""
    return planned(s, sf, ts.with_sums(frames(s, sf), ts.tissue_images(v.thumb_images(s, sf))))


def tiles(s: SparkSession, sf: str) -> DataFrame:
    return pl.supertiles(pl.patch_grid(frames(s, sf), v.PATCH, v.STRIDE), v.TILE, v.PATCH)


def r6(*names: str):
    return {n: F.round(n, 6) for n in names}


def q_output_frame(s, sf):
    return frames(s, sf).select("slide_id", "origin_x", "origin_y", "frame_w", "frame_h", "out_w", "out_h", "ampp_x", "ampp_y")


def q_output_shape(s, sf):
    return v.slides(s, sf).select("slide_id", g.scaled_size(F.col("width0"), F.col("mpp_x"), v.TARGET).alias("out_w"), g.scaled_size(F.col("height0"), F.col("mpp_y"), v.TARGET).alias("out_h"))


def q_plan_grid(s, sf):
    return pl.patch_grid(frames(s, sf), v.PATCH, v.STRIDE).select("slide_id", "out_x", "out_y")


def q_crop_bounds(s, sf):
    return planned(s, sf).select("slide_id", "out_x", "out_y", "crop_left", "crop_top", "crop_right", "crop_bottom", "gx1", "gy1", "gx2", "gy2", "lx1", "ly1", "lx2", "ly2", "edge", "padded")


def q_roi_filter(s, sf):
    """Patches that meet a region: the middle half of each frame."""
    p = pl.crops(pl.patch_grid(frames(s, sf), v.PATCH, v.STRIDE), v.PATCH, v.HALO)
    w, h = F.col("out_w"), F.col("out_h")
    q = lambda c, k: F.floor(c * k / 4).cast("int")
    return pl.in_roi(p, (q(w, 1), q(h, 1), q(w, 3), q(h, 3))).select("slide_id", "out_x", "out_y")


def q_supertiles(s, sf):
    text = F.array_join(F.transform("patches", lambda p: F.concat_ws(":", p["out_y"].cast("string"), p["out_x"].cast("string"))), ",")
    return tiles(s, sf).select("slide_id", "kx", "ky", "tile_x", "tile_y", "tile_w", "tile_h", "n_patches", text.alias("patches"))


def q_planning_summary(s, sf):
    return pl.planning_summary(planned(s, sf), v.TILE)


def q_planning_ratios(s, sf):
    return pl.planning_ratios(q_planning_summary(s, sf)).withColumns(r6("candidate_over_grid", "candidates_per_supertile"))


def q_batch_stats(s, sf):
    return pl.batch_stats(tiles(s, sf), 8).withColumns(r6("mean_fill"))


def q_levels_unnest(s, sf):
    return v.levels(s, sf).select("slide_id", F.inline("levels"))


def _level(policy: str, s, sf):
    lv = v.levels(s, sf).withColumn("l", g.choose_level(F.col("levels"), v.TARGET, policy, 2.0))
    x, y = F.col("l.mpp_x"), F.col("l.mpp_y")
    return lv.select("slide_id", F.col("l.index").alias("level"), x.alias("level_mpp_x"), F.round(F.abs(x - v.TARGET), 6).alias("error_x"), F.round(F.lit(v.TARGET) / x, 6).alias("resize_x"), F.round(F.lit(v.TARGET) / y, 6).alias("resize_y"), F.round(g.oversample(x, y, v.TARGET), 6).alias("oversample"))


def q_read_addresses(s, sf):
    lv = v.levels(s, sf).withColumn("l", g.choose_level(F.col("levels"), v.TARGET, "prefer_higher_bounded", 2.0)).select("slide_id", F.col("l.mpp_x").alias("level_mpp_x"), F.col("l.mpp_y").alias("level_mpp_y"))
    both = frames(s, sf).join(lv.hint("merge"), "slide_id")
    return pl.read_addresses(tiles(s, sf), both).select("slide_id", "kx", "ky", "read_x", "read_y", "read_w", "read_h")


def q_coord_backmap(s, sf):
    back = lambda o, c, a, m: F.round(F.col(o) + F.col(c) * F.col(a) / F.col(m), 6)
    return pl.patch_grid(frames(s, sf), v.PATCH, v.STRIDE).select("slide_id", "out_x", "out_y", back("origin_x", "out_x", "ampp_x", "mpp_x").alias("x_l0"), back("origin_y", "out_y", "ampp_y", "mpp_y").alias("y_l0"))


def q_mpp_chain(s, sf):
    maps = F.create_map()
    for k, m in v.PROPS.items():
        one = F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
        maps = F.when(F.col("slide_id") % 8 == k, one) if k == 0 else maps.when(F.col("slide_id") % 8 == k, one)
    return v.slides(s, sf).select("slide_id", maps.alias("props")).select("slide_id", ps.lower_keys(F.col("props")).alias("props")).select("slide_id", ps.mpp_chain(F.col("props")).alias("m")).select("slide_id", F.round("m.mpp_x", 9).alias("mpp_x"), F.round("m.mpp_y", 9).alias("mpp_y"), "m.mpp_source")


def _nth(values: list[str], key="slide_id"):
    return F.element_at(F.array(*[F.lit(t) for t in values]), (F.col(key) % len(values) + 1).cast("int"))


def q_mpp_text(s, sf):
    return v.slides(s, sf).select("slide_id", ps.mpp_from_text(_nth(v.TEXTS)).alias("mpp"))


def q_lenient_float(s, sf):
    return v.slides(s, sf).select("slide_id", ps.lenient_float(_nth(v.NUMBERS)).alias("number"))


def q_mpp_override(s, sf):
    k = F.col("slide_id") % 4
    ox, oy = F.when(k.isin(1, 3), 0.75), F.when(k.isin(2, 3), 0.7)
    found = F.struct(F.col("mpp_x"), F.col("mpp_y"), F.lit("file").alias("mpp_source"))
    return v.slides(s, sf).select("slide_id", ps.mpp_with_override(found, ox, oy).alias("m")).select("slide_id", "m.*")


def q_vendor(s, sf):
    k = F.col("slide_id") % 4
    return v.slides(s, sf).select("slide_id", ps.vendor(F.when(k == 0, "aperio"), F.when(k <= 1, "mirax"), F.when(k <= 2, "ImageSlide").otherwise("OpenSlide")).alias("vendor"))


def q_bounds(s, sf):
    text = lambda c: F.when(F.col("slide_id") % 5 == 0, F.concat(F.col(c).cast("string"), F.lit(".9"))).otherwise(F.col(c).cast("string"))
    return v.slides(s, sf).select("slide_id", ps.bounds(*[text(c) for c in ("bnd_x", "bnd_y", "bnd_w", "bnd_h")]).alias("b")).select("slide_id", "b.x", "b.y", "b.width", "b.height")


def q_background(s, sf):
    return v.slides(s, sf).select("slide_id", ps.background(_nth(["#ff8000", "00FF7f", "#12345", "zz0000", ""])).alias("c")).select("slide_id", "c.r", "c.g", "c.b", "c.a")


def q_tile_option(s, sf):
    return frames(s, sf).select("slide_id", g.tile_option(F.col("out_w"), F.col("out_h"), F.col("slide_id") % 3 * 512).cast("int").alias("tile"))


def q_resolution_tag(s, sf):
    return frames(s, sf).select("slide_id", F.round(g.pixels_per_cm(F.col("ampp_x")), 6).alias("x_per_cm"), F.round(g.pixels_per_cm(F.col("ampp_y")), 6).alias("y_per_cm"))


def q_pyramid_levels(s, sf):
    return frames(s, sf).select("slide_id", g.pyramid_levels(F.col("out_w"), F.col("out_h"), 512).alias("levels"))


def q_preview_placement(s, sf):
    tw, th = 1536, 1024
    place = lambda c, full, t: F.rint(F.col(c) * t / F.col(full)).cast("int")
    return frames(s, sf).select("slide_id", place("origin_x", "width0", tw).alias("paste_x"), place("origin_y", "height0", th).alias("paste_y"), F.greatest(F.lit(1), place("frame_w", "width0", tw)).alias("paste_w"), F.greatest(F.lit(1), place("frame_h", "height0", th)).alias("paste_h"))


def q_gray_hsv(s, sf):
    return ts.gray_hsv(v.thumbs(s, sf)).select("slide_id", "tx", "ty", "gray", "sat", "val")


def q_gray_histogram(s, sf):
    return ts.gray_hsv(v.thumbs(s, sf)).groupBy("slide_id", "gray").agg(F.count(F.lit(1)).alias("n"))


def q_otsu(s, sf):
    return ts.otsu(ts.gray_hsv(v.thumbs(s, sf)))


def q_tissue_mask(s, sf):
    return ts.cells(ts.tissue_images(v.thumb_images(s, sf)), "raw", "mask")


def q_morphology(s, sf):
    return ts.cells(ts.tissue_images(v.thumb_images(s, sf)), "mask", "mask")


def q_integral(s, sf):
    return ts.cells(ts.tissue_images(v.thumb_images(s, sf)), "sums", "integral")


def q_tissue_fraction(s, sf):
    return ts.fraction(planned_sums(s, sf)).select("slide_id", "out_x", "out_y", F.round("fraction", 6).alias("fraction"))


def q_gated_plan(s, sf):
    return pl.planning_summary(ts.tissue_gate(planned_sums(s, sf), least=0.2), v.TILE, F.col("kept"))


def _pixels(s, sf):
    return st.patch_pixels(v.logit_patches(s, sf), v.SMALL, v.SMALL_HALO, v.SMALL_TILE)


def q_prob_threshold(s, sf):
    e = v.table(s, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x"))
    p = px.sigmoid(F.col("x").cast("double"))
    return e.select("vec_id", "i", F.round(p, 6).alias("prob"), px.over_threshold(p).alias("mask"))


def q_softmax_threshold(s, sf):
    e = v.table(s, sf, "embeddings")
    pair = e.select("vec_id", F.posexplode(F.arrays_zip(F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))).alias("i", "z"))
    p = px.softmax_second(F.col("z.a").cast("double"), F.col("z.b").cast("double"))
    return pair.select("vec_id", "i", F.round(p, 6).alias("prob"), px.over_threshold(p).alias("mask"))


def q_stitch(s, sf):
    return st.stitch(_pixels(s, sf))


def q_mask_255(s, sf):
    return q_stitch(s, sf).select("canvas", "x", "y", (F.col("mask") * 255).alias("value"))


def q_mask_area(s, sf):
    return q_stitch(s, sf).groupBy("canvas").agg(F.sum("mask").alias("area"), F.count(F.lit(1)).alias("written"))


def q_pyramid(s, sf):
    return st.pyramid(q_stitch(s, sf), 4)


def q_preview_nearest(s, sf):
    sizes = v.logit_patches(s, sf).select("canvas", F.lit(v.CANVAS).alias("w"), F.lit(v.CANVAS).alias("h")).distinct()
    return st.preview(q_stitch(s, sf), sizes, 20, 17)


def q_stitch_chunks(s, sf):
    """Chunk painting, unpacked to pixels; equal to q_stitch where a patch wrote, 0 elsewhere."""
    probs = F.transform("logits", lambda x: (F.lit(1.0) / (F.lit(1.0) + F.exp(-x.cast("double")))).cast("float"))
    p = v.logit_patches(s, sf).withColumn("values", probs)

    def pack(batches):
        for pdf in batches:
            yield pdf.assign(probs=[np.asarray(x, np.float32).tobytes() for x in pdf["values"]]).drop(columns="values")

    packed = p.drop("logits").mapInPandas(pack, "canvas int, out_x int, out_y int, out_w int, out_h int, probs binary")
    chunks = st.paint_chunks(packed, v.SMALL, v.SMALL_HALO, v.SMALL_TILE, chunk=16)

    def unpack(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                y, x = np.mgrid[: r.h, : r.w].astype(np.int32)
                yield pd.DataFrame({"canvas": np.int32(r.canvas), "x": x.ravel() + np.int32(r.cx * 16), "y": y.ravel() + np.int32(r.cy * 16), "mask": np.frombuffer(r.data, np.uint8).astype(np.int32)})

    return chunks.mapInPandas(unpack, "canvas int, x int, y int, mask int")


def q_score_mapinpandas(s, sf):
    """Supertiles of synthetic pixels of every slide, at 16 microns a pixel, through the built-in scorer."""
    t = pl.supertiles(pl.patch_grid(pl.output_frames(v.slides(s, sf), 16.0), 32, 24), 64, 32).withColumns({"canvas": F.col("slide_id"), "out_w": F.lit(0), "out_h": F.lit(0)})

    def paint(batches):
        for pdf in batches:
            images = [((np.add.outer(np.arange(h) * 3 + c, np.arange(w) * 5)[..., None] + np.array([0, 40, 80])) % 256).astype(np.uint8).tobytes() for h, w, c in zip(pdf.tile_h, pdf.tile_w, pdf.canvas)]
            yield pdf.assign(image=images)

    n = int(s.conf.get("spark.sql.shuffle.partitions"))
    some = t.repartition(n, "slide_id", "kx", "ky").select("canvas", "tile_x", "tile_y", "tile_w", "tile_h", "patches", "out_w", "out_h")
    schema = ", ".join(f"`{k}` {x}" for k, x in some.dtypes) + ", image binary"
    probs = sc.score_supertiles(some.mapInPandas(paint, schema), 32)
    return probs.select("canvas", "out_x", "out_y", F.length("probs").alias("n_bytes"), F.sha2("probs", 256).alias("probs_sha256"))


def q_region_resize(s, sf):
    ship(s)

    def run(batches):
        for pdf in batches:
            out = [sc.resize_area(np.clip(np.asarray(e, float).reshape(8, 8) * 60 + 128, 0, 255).astype(np.uint8), 5, 11) for e in pdf.embedding]
            yield pd.DataFrame({"vec_id": pdf.vec_id, "total": [int(o.sum()) for o in out], "pixels": [o.tobytes() for o in out]})

    return v.table(s, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, total long, pixels binary")


def q_overlay(s, sf):
    ship(s)

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                e = np.asarray(r.embedding, float).reshape(8, 8)
                rgb = np.repeat(np.clip(e * 60 + 128, 0, 255).astype(np.uint8)[..., None], 3, 2)
                yield pd.DataFrame({"vec_id": [r.vec_id], "green": [int(sc.overlay(rgb, e > 0)[..., 1].sum())]})

    return v.table(s, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, green long")


def q_progress_sampling(s, sf):
    return rn.progress_sample(v.run_events(s, sf), 8).select("run_id", "event_id", "idx", "total")


def q_event_counts(s, sf):
    return rn.event_counts(v.run_events(s, sf))


def q_run_throughput(s, sf):
    t = rn.throughput(v.runs(s, sf))
    return t.select("run_id", *[F.round(c, 6).alias(c) for c in t.columns if "_per_" in c])


def q_batch_summary(s, sf):
    return rn.batch_summary(v.runs(s, sf).withColumn("candidates_per_second", F.col("candidate_patches") / F.greatest("wall_seconds", F.lit(1e-9))))


def q_latest_runs(s, sf):
    return rn.latest_runs(v.runs(s, sf)).select("slide_stem", "run_id", "grid_patches", "wall_seconds")


def q_format_bytes(s, sf):
    n = (F.col("o_orderkey") * F.element_at(F.array(*[F.lit(x) for x in (1, 512, 65536, 16777216, 4294967296)]), (F.col("o_orderkey") % 5 + 1).cast("int"))).cast("long")
    return v.table(s, sf, "orders").select("o_orderkey", ps.format_bytes(n).alias("size"))


def q_utc_ts(s, sf):
    return v.table(s, sf, "orders").select("o_orderkey", ps.utc_stamp(F.col("o_orderdate")).alias("stamp"))


def q_run_id(s, sf):
    sha = ps.short_sha(_nth(["4e5e3cf77a", " 9a9d5cc8e1 ", "", "   "], "o_orderkey"))
    return v.table(s, sf, "orders").select("o_orderkey", sha.alias("sha"), ps.run_id(ps.utc_stamp(F.col("o_orderdate")), sha, F.lit("9a9d5cc8")).alias("run_id"))


def q_env_bool(s, sf):
    return v.slides(s, sf).select("slide_id", ps.env_bool(_nth(["1", " True ", "off", "NO", "maybe", "", "y", "n"])).alias("flag"))


def q_suffix_filter(s, sf):
    name = F.concat(F.lit("slide_"), F.col("slide_id").cast("string"), _nth([".SVS", ".tiff", ".txt", ".mrxs", ".json", ".NDPI", ".tif.bak"]))
    return v.slides(s, sf).select("slide_id", name.alias("name")).filter(ps.has_suffix(F.col("name")))


def q_output_kind(s, sf):
    k = F.col("slide_id") % 4
    shape = F.when(k == 0, F.array(F.lit(1), F.lit(1), F.lit(512), F.lit(512))).when(k == 1, F.array(F.lit(1), F.lit(2), F.lit(512), F.lit(512))).when(k == 2, F.array(F.lit(1), F.lit(512), F.lit(512))).otherwise(F.array(F.lit(1), F.lit(9)))
    return v.slides(s, sf).select("slide_id", ps.output_kind(shape).alias("kind"))


def q_export_gates(s, sf):
    t, o, p = (F.col("slide_id") % n == 0 for n in (2, 3, 5))
    return v.slides(s, sf).select("slide_id", (t | o | p).alias("exports_requested"), (t | o).alias("needs_mask"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")} | {f"q_level_select_{n}": partial(_level, p) for n, p in (("nearest", "nearest"), ("prefer_higher", "prefer_higher"), ("bounded", "prefer_higher_bounded"))}
