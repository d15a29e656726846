"""The engine: inspect, plan and run slides, and probe a model."""

from __future__ import annotations

import os
import subprocess
import time
from dataclasses import asdict
from datetime import UTC, datetime
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config
from .functions import geometry as g, parsing as ps
from .operators import planning, scoring, stitching, tissue
from .session import ship, through_table
from .sources import files, formats, slides as src


def git_info(folder: str | None = None) -> dict:
    """Commit, branch and whether the tree is dirty; out of the environment where git gives none."""

    def git(*args: str) -> tuple[int, str]:
        try:
            p = subprocess.run(["git", *args], cwd=folder, capture_output=True, text=True, timeout=10)
            return p.returncode, p.stdout.strip()
        except OSError:
            return 1, ""

    code, sha = git("rev-parse", "HEAD")
    first = lambda *names: next((os.environ[n] for n in names if os.environ.get(n)), None)
    if code:
        sha = first("TESSELIA_GIT_SHA", "GITHUB_SHA", "CI_COMMIT_SHA")
        branch = first("TESSELIA_GIT_BRANCH", "GITHUB_REF_NAME", "CI_COMMIT_REF_NAME")
        return {"git_sha": (sha or "").strip()[:7] or None, "git_branch": branch, "git_dirty": True}
    return {"git_sha": sha[:7], "git_branch": git("rev-parse", "--abbrev-ref", "HEAD")[1] or None, "git_dirty": git("diff", "--quiet")[0] != 0}


def new_run_id(cfg: Config) -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}_{git_info()['git_sha'] or 'nogit'}_{cfg.hash()}"


def find_slides(spark: SparkSession, cfg: Config, path: str | None = None, recursive: bool = False) -> DataFrame:
    """Slides of the given path, else of the configured one, else of data/slides, with resolution, bounds, background and the level to read.

    The path is the key. An error without any slide, and for a slide whose resolution nothing tells.
    """
    where = path or cfg.paths.slide_path or "data/slides"
    if not Path(where).exists():
        raise FileNotFoundError(f"no slides at {where}")
    found = src.slide_files(spark, where, recursive=recursive).withColumns({"slide_id": F.col("path"), "low": ps.lower_keys(F.col("props"))})
    prop = lambda k: F.element_at("low", F.lit(k))
    override = [F.lit(v).cast("double") for v in (cfg.slide.mpp_override_x, cfg.slide.mpp_override_y)]
    unknown = F.raise_error(F.concat(F.lit("no resolution in "), F.col("path"))).cast("struct<mpp_x: double, mpp_y: double, mpp_source: string>")
    found = found.withColumns({
        "mpp": F.coalesce(ps.mpp_with_override(ps.mpp_chain(F.col("low")), *override), unknown),
        "bnd": ps.bounds(*(prop(f"openslide.bounds-{k}") for k in ("x", "y", "width", "height"))),
        "background": ps.background(prop("openslide.background-color")),
        "vendor": ps.vendor(prop("openslide.vendor"), F.col("detected"), F.col("backend")),
    })
    level = lambda v: F.struct(*[v[k].alias(k) for k in ("index", "width", "height", "downsample")], (F.col("mpp.mpp_x") * v["downsample"]).alias("mpp_x"), (F.col("mpp.mpp_y") * v["downsample"]).alias("mpp_y"))
    found = found.withColumn("levels", F.transform("levels", level))
    bounds = {f"bnd_{k[0]}": F.col(f"bnd.{k}") for k in ("x", "y", "width", "height")}
    return level_of(found.select("*", "mpp.*").withColumns(bounds), cfg).drop("low", "props", "mpp", "bnd")


def plan(slides: DataFrame, cfg: Config) -> DataFrame:
    """All patches, with kept: whether the tissue gate lets them through. The gate comes before any pixel is read for scoring."""
    grid = planning.plan(slides.select("slide_id", "width0", "height0", "mpp_x", "mpp_y", "bnd_x", "bnd_y", "bnd_w", "bnd_h"), cfg)
    if not cfg.schedule.use_tissue_mask:
        return grid.withColumn("kept", F.lit(True))
    return tissue.tissue_gate(grid, tissue_of(slides, cfg), cfg.schedule.tissue_mask_min_fraction)


def tissue_of(slides: DataFrame, cfg: Config) -> DataFrame:
    s = cfg.schedule
    return tissue.tissue_images(src.thumbnails(slides, s.tissue_mask_max_size), s.tissue_mask_saturation_threshold, s.tissue_mask_white_threshold)


def inspect(spark: SparkSession, cfg: Config, path: str | None = None, recursive: bool = False) -> DataFrame:
    """Metadata, frame, planning counts and ratios of each slide."""
    slides = find_slides(spark, cfg, path, recursive)
    patches = plan(slides, cfg)
    frames = planning.output_frames(slides, cfg.model.target_mpp, cfg.schedule.use_bounds).select(
        "slide_id", "path", "vendor", "backend", "width0", "height0", "mpp_x", "mpp_y", "mpp_source", "level", F.size("levels").alias("n_levels"), "background", "origin_x", "origin_y", "frame_w", "frame_h", "out_w", "out_h", "ampp_x", "ampp_y"
    )
    return frames.join(planning.planning_ratios(planning.planning_summary(patches, cfg.schedule.supertile_px, F.col("kept"))), "slide_id")


def masks(spark: SparkSession, cfg: Config, slides: DataFrame, chunk: int = 1024, model_path: str | None = None, packed: bool = False) -> DataFrame:
    """Mask chunks of all slides at once: canvas (the slide), cx, cy, w, h, data."""
    m = cfg.model
    tiles = planning.supertiles(plan(slides, cfg).filter("kept"), cfg.schedule.supertile_px, m.patch_px)
    frames = planning.output_frames(slides, m.target_mpp, cfg.schedule.use_bounds).withColumns({"level_mpp_x": F.col("level.mpp_x"), "level_mpp_y": F.col("level.mpp_y")})
    ready = planning.read_addresses(tiles, frames.withColumn("level", F.col("level.index")).drop("levels")).withColumn("canvas", F.col("slide_id"))
    probs = scoring.score_supertiles(src.read_regions(ready.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slide_id", "kx", "ky")), m.patch_px, m.batch_size, m.apply_sigmoid, model_path)
    return stitching.paint_chunks(probs, m.patch_px, m.halo_px, cfg.schedule.supertile_px, chunk, m.threshold, packed)


def exports(slides: DataFrame, chunks: DataFrame, cfg: Config, chunk: int) -> DataFrame:
    """slide_id, name and data of every file to write. One task a slide assembles its mask from packed chunks and encodes it, on executors.

    ``slides``: as ``inspect`` gives them, with run_id. Slides without chunks get an empty mask.
    """
    ship(slides.sparkSession)
    out = cfg.output
    wanted = slides.select("slide_id", "run_id", "path", "width0", "height0", "origin_x", "origin_y", "frame_w", "frame_h", "out_w", "out_h", "ampp_x", "ampp_y", "background")
    rows = wanted.join(chunks.withColumnRenamed("canvas", "slide_id"), "slide_id", "left")

    def render(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        mask = np.zeros((r.out_h, r.out_w), np.uint8)
        for c in pdf[pdf.data.notna()].itertuples():
            x, y, w, h = int(c.cx) * chunk, int(c.cy) * chunk, int(c.w), int(c.h)
            mask[y : y + h, x : x + w] = np.unpackbits(np.frombuffer(c.data, np.uint8), count=w * h).reshape(h, w)
        mask *= np.uint8(255)
        mpp, made = (r.ampp_x, r.ampp_y), {}
        if out.keep_memmap:
            made["mask.npy"] = files.npy_bytes(mask)
        if out.write_tiff:
            made["mask.tiff"] = files.tiff_bytes(mask, mpp, out.tiff_tile_size, {"run_id": r.run_id}, out.bigtiff, out.compression)
        if out.write_ome_tiff:
            made["mask.ome.tiff"] = files.ome_tiff_bytes(mask, mpp, out.ome_tile_size, out.ome_pyramid_min_size, out.bigtiff, out.compression)
        if out.write_previews:
            base = formats.thumbnail(formats.open_slide(r.path), out.preview_max_size, tuple(r.background[k] for k in "rgb"))
            small = scoring.place_mask(mask, base.shape[:2], (r.width0, r.height0), (r.origin_x, r.origin_y, r.frame_w, r.frame_h))
            made |= {"preview_mask.png": files.png_bytes(small), "preview_overlay.png": files.png_bytes(scoring.overlay(base, small))}
        return pd.DataFrame({"slide_id": [r.slide_id] * len(made), "name": list(made), "data": list(made.values())})

    return rows.groupBy("slide_id").applyInPandas(render, f"slide_id {dict(slides.dtypes)['slide_id']}, name string, data binary")


def run(spark: SparkSession, cfg: Config, path: str | None = None, model_path: str | None = None, chunk: int = 1024, recursive: bool = False) -> list[dict]:
    """Masks of all slides in parallel; per slide a folder with exports, previews, run.json and events.jsonl."""
    began = time.time()
    slides = find_slides(spark, cfg, path, recursive)
    opened = []
    for r in inspect(spark, cfg, path, recursive).toLocalIterator():
        run_id = new_run_id(cfg)
        folder = Path(cfg.paths.output_dir) / Path(r["path"]).stem / run_id
        folder.mkdir(parents=True, exist_ok=True)
        log = files.EventLog(folder)
        log.event("slide_opened", path=r["path"])
        log.event("planning_complete", total_grid=r["total_grid"], candidates=r["candidates"])
        log.event("model_loaded", model=model_path or "built-in")
        log.event("processing_started", supertiles=r["supertiles"])
        opened.append((r, run_id, folder, log))
    planned = time.time()
    chunks = through_table(masks(spark, cfg, slides, chunk, model_path, packed=True), "mask-chunks")
    processed = time.time()
    if cfg.output.exports_requested or cfg.output.keep_memmap:
        ids = spark.createDataFrame([(r["slide_id"], run_id) for r, run_id, _, _ in opened], "slide_id string, run_id string")
        folders = {r["slide_id"]: folder for r, _, folder, _ in opened}
        ready = planning.output_frames(slides, cfg.model.target_mpp, cfg.schedule.use_bounds).join(ids, "slide_id")
        for f in through_table(exports(ready, chunks, cfg, chunk), "exports").toLocalIterator():
            (folders[f["slide_id"]] / f["name"]).write_bytes(f["data"])
        if cfg.output.write_previews and cfg.schedule.use_tissue_mask:
            for t in tissue_of(slides, cfg).select("slide_id", "thumb_w", "thumb_h", "mask").toLocalIterator():
                shape = next((f["width0"], f["height0"]) for f, _, _, _ in opened if f["slide_id"] == t["slide_id"])
                image = (np.array(t["mask"], np.uint8) * np.uint8(255)).reshape(t["thumb_h"], t["thumb_w"])
                scale = min(1.0, cfg.output.preview_max_size / max(shape))
                w, h = (max(1, round(n * scale)) for n in shape)
                (folders[t["slide_id"]] / "preview_tissue.png").write_bytes(files.png_bytes(scoring.resize_nearest(image, h, w)))
    exported = time.time()
    summaries = []
    for r, run_id, folder, log in opened:
        log.event("supertile_progress", done=r["supertiles"], total=r["supertiles"])
        log.event("exports_complete" if cfg.output.exports_requested else "exports_skipped")
        ended = time.time()
        wall, loop = ended - began, processed - planned
        row = {
            "slide_stem": folder.parent.name, "run_id": run_id, "grid_patches": r["total_grid"], "candidate_patches": r["candidates"], "supertiles": r["supertiles"],
            "wall_seconds": round(wall, 6), "processing_seconds": round(loop, 6), "candidate_patches_per_second": round(r["candidates"] / max(wall, 1e-9), 6), "run_dir": str(folder),
        }
        some = lambda *names: {k: r[k] for k in names}
        manifest = row | {
            "slide": some("path", "vendor", "backend", "width0", "height0", "mpp_x", "mpp_y", "mpp_source", "n_levels"),
            "selection": r["level"].asDict() | {"policy": cfg.model.level_selection_policy, "resize_x": cfg.model.target_mpp / r["level"]["mpp_x"], "resize_y": cfg.model.target_mpp / r["level"]["mpp_y"]},
            "frame": some("origin_x", "origin_y", "frame_w", "frame_h", "out_w", "out_h", "ampp_x", "ampp_y"),
            "planning": some("total_grid", "candidates", "edge_patches", "padded_patches", "supertiles", "candidate_over_grid", "candidates_per_supertile"),
            "timing": {"wall": round(wall, 6), "components": {"planning": round(planned - began, 6), "processing": round(loop, 6), "exports": round(exported - processed, 6)}},
            "throughput": {f"{k}_per_{n}_second": round(r[c] / max(t, 1e-9), 6) for k, c in (("grid", "total_grid"), ("candidate", "candidates")) for n, t in (("wall", wall), ("processing", loop))},
            "mask_to_level0": {"origin": [r["origin_x"], r["origin_y"]], "scale": [r["ampp_x"] / r["mpp_x"], r["ampp_y"] / r["mpp_y"]]},
            "git": git_info(), "config": asdict(cfg),
        }
        files.write_json(manifest, folder / "run.json")
        log.event("run_complete", wall_seconds=wall)
        summaries.append(row)
    if len(summaries) > 1:
        files.write_summary(spark.createDataFrame(summaries), str(Path(cfg.paths.output_dir) / "_batches" / f"batch_{summaries[0]['run_id']}"))
    return summaries


def level_of(levels: DataFrame, cfg: Config) -> DataFrame:
    m = cfg.model
    return levels.withColumn("level", g.choose_level(F.col("levels"), m.target_mpp, m.level_selection_policy, m.max_native_oversample_factor))


def probe_model(cfg: Config, model_path: str | None = None) -> dict:
    return scoring.probe(scoring.scorer_for(model_path), cfg.model.patch_px)
