"""A whole run over synthetic slides, and events as a stream."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselia import engine
from tesselia.config import Config
from tesselia.streaming import monitor


def test_run(spark, tmp_path):
    image = np.full((700, 900, 3), 250, np.uint8)
    image[200:500, 100:600] = (90, 30, 60)
    np.save(tmp_path / "one.npy", image)
    (tmp_path / "two.ppm").write_bytes(b"P6\n300 200\n255\n" + np.full((200, 300, 3), 240, np.uint8).tobytes())
    cfg = Config.from_dict({"model": {"target_mpp": 0.5, "patch_px": 128, "stride_px": 96, "halo_px": 16}, "schedule": {"supertile_px": 256, "tissue_mask_max_size": 128}})
    cfg.paths.output_dir, cfg.output.write_tiff = str(tmp_path / "out"), True
    found = engine.inspect(spark, cfg, str(tmp_path)).orderBy("path").collect()
    assert [r.total_grid for r in found] == [70, 6] and 0 < found[0].candidates < 70
    rows = engine.run(spark, cfg, str(tmp_path), chunk=256)
    assert len(rows) == 2
    folder = Path(next(r for r in rows if r["slide_stem"] == "one")["run_dir"])
    assert {p.name for p in folder.iterdir()} >= {"mask.tiff", "mask.ome.tiff", "preview_mask.png", "preview_overlay.png", "preview_tissue.png", "run.json", "events.jsonl"}
    manifest = json.loads((folder / "run.json").read_text())
    assert manifest["grid_patches"] == manifest["planning"]["total_grid"] == 70 and manifest["mask_to_level0"] == {"origin": [0, 0], "scale": [1.0, 1.0]}
    assert set(manifest["timing"]["components"]) == {"planning", "processing", "exports"} and len(manifest["throughput"]) == 4
    events = [json.loads(x)["event"] for x in (folder / "events.jsonl").read_text().splitlines()]
    assert events == ["slide_opened", "planning_complete", "model_loaded", "processing_started", "supertile_progress", "exports_complete", "run_complete"]
    chunks = engine.masks(spark, cfg, engine.find_slides(spark, cfg, str(tmp_path / "one.npy")), chunk=256)
    from tesselia.sources.files import assemble

    mask = assemble(chunks, 900, 700, 256)
    assert (mask[200:500, 100:600] == 1).mean() > 0.99 and mask[:150].mean() < 0.01


def test_no_slides(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    np.save(tmp_path / "deep" / "one.npy", np.zeros((9, 9, 3), np.uint8))
    with pytest.raises(FileNotFoundError):
        engine.find_slides(spark, Config.from_dict({}), str(tmp_path / "none"))
    with pytest.raises(Exception, match="no slides"):
        engine.find_slides(spark, Config.from_dict({}), str(tmp_path)).count()
    assert engine.find_slides(spark, Config.from_dict({}), str(tmp_path), recursive=True).count() == 1


def test_stream(spark, tmp_path):
    e = spark.range(100).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("run_id"), F.lit("x").alias("event"), F.lit(1.0).alias("seconds"))
    e.write.parquet(str(tmp_path / "in"))
    q = monitor.windowed_counts(monitor.event_stream(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 100 and spark.table("counts").count() == 10
