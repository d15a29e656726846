"""python -m tesselia.cli inspect | run | probe-model"""

from __future__ import annotations

import argparse
import json

from . import engine
from .config import Config
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tesselia")
    p.add_argument("command", choices=["inspect", "run", "probe-model"])
    p.add_argument("--config")
    p.add_argument("--slide-path")
    p.add_argument("--model-path")
    p.add_argument("--output-dir")
    p.add_argument("--recursive", action="store_true", help="look for slides in subfolders too")
    p.add_argument("--verbose", action="store_true", help="log at the level INFO")
    p.add_argument("--exports", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--keep-memmap", action=argparse.BooleanOptionalAction, default=None, help="also write the mask as mask.npy")
    a = p.parse_args(argv)
    cfg = Config.from_yaml(a.config) if a.config else Config()
    if a.output_dir:
        cfg.paths.output_dir = a.output_dir
    if a.keep_memmap is not None:
        cfg.output.keep_memmap = a.keep_memmap
    if not a.exports:
        cfg.output.write_tiff = cfg.output.write_ome_tiff = cfg.output.write_previews = False
    if a.command == "probe-model":
        print(json.dumps(engine.probe_model(cfg, a.model_path)))
        return 0
    spark = build_session()
    spark.sparkContext.setLogLevel("INFO" if a.verbose else "WARN")
    if a.command == "inspect":
        engine.inspect(spark, cfg, a.slide_path, a.recursive).show(truncate=False)
    else:
        for row in engine.run(spark, cfg, a.slide_path, a.model_path, recursive=a.recursive):
            print(json.dumps(row))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
