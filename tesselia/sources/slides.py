"""Slide discovery, a data source for slide metadata, and reads of their pixels.

``slide_files`` lists slides and reads metadata with one partition a slide; ``read_regions`` reads the pixels of planned
supertiles where they are needed, one supertile a row. Executors open slides by path, so slides lie on a mount that all share.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.parsing import SUFFIXES, has_suffix
from ..operators.scoring import resize_area
from ..session import ship
from .formats import RASTERS, downsamples, open_slide, region, thumbnail


def discover(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Sorted paths of slides: a file itself if its suffix fits, or a folder's. ``pattern`` replaces the suffixes. Contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).select("path")
    return (files if pattern else files.filter(has_suffix(F.col("path"), suffixes))).orderBy("path")


class _OneSlide(InputPartition):
    pass


class _SlideReader(DataSourceReader):
    def __init__(self, options):
        self.mpp = float(options.get("mpp", "0.5"))
        top = Path(options["path"])
        every = top.rglob("*") if options.get("recursive", "false") == "true" else top.glob("*")
        found = [top] if top.is_file() else sorted(p for p in every if p.suffix.lower() in SUFFIXES + RASTERS)
        if not found:
            raise FileNotFoundError(f"no slides at {top}")
        self.paths = [str(p) for p in found]

    def partitions(self):
        return [_OneSlide(p) for p in self.paths]

    def read(self, partition) -> Iterator[tuple]:
        slide = open_slide(partition.value, self.mpp)
        levels = [(k, w, h, s) for k, ((w, h), s) in enumerate(zip(slide.sizes, downsamples(slide.sizes)))]
        yield partition.value, slide.backend, slide.detected, slide.props, *slide.sizes[0], levels


class SlideFiles(DataSource):
    """``spark.read.format("slide_files").option("path", folder)``: one row of metadata a slide."""

    @classmethod
    def name(cls) -> str:
        return "slide_files"

    def schema(self) -> str:
        return "path string, backend string, detected string, props map<string, string>, width0 int, height0 int, levels array<struct<index: int, width: int, height: int, downsample: double>>"

    def reader(self, schema) -> DataSourceReader:
        return _SlideReader(self.options)


def slide_files(spark: SparkSession, path: str, mpp: float = 0.5, recursive: bool = False) -> DataFrame:
    """Metadata of the slides of a path; ``mpp`` is that of plain rasters, which state none."""
    ship(spark)
    spark.dataSource.register(SlideFiles)
    return spark.read.format("slide_files").option("mpp", str(mpp)).option("recursive", str(recursive).lower()).load(path)


def _colour(value) -> tuple[int, int, int]:
    return (value["r"], value["g"], value["b"])


def read_regions(tiles: DataFrame, path_col: str = "path") -> DataFrame:
    """Adds the image of each supertile, resized to tile_w x tile_h; what lies outside of the slide has its background.

    ``tiles`` has level, read_x, read_y (level 0), read_w, read_h (that level), tile_w, tile_h and background. Only the parts of a file
    that a supertile touches are decoded. The last slide stays open for the next row.
    """
    ship(tiles.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, slide = None, None
        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                if r[path_col] != held:
                    held, slide = r[path_col], open_slide(r[path_col])
                part = region(slide, r["level"], r["read_x"], r["read_y"], r["read_w"], r["read_h"], _colour(r["background"]))
                out.append(resize_area(part, r["tile_h"], r["tile_w"]).tobytes())
            yield pdf.assign(image=out)

    schema = ", ".join(f"`{k}` {t}" for k, t in tiles.dtypes) + ", image binary"
    return tiles.mapInPandas(run, schema)


def thumbnails(slides: DataFrame, most: int = 1536, path_col: str = "path") -> DataFrame:
    """Thumbnails within most x most pixels: slide_id, thumb_w, thumb_h and rgb, the pixels as bytes. ``slides`` has background."""
    ship(slides.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.to_dict("records"):
                small = thumbnail(open_slide(r[path_col]), most, _colour(r["background"]))
                yield pd.DataFrame({"slide_id": [r["slide_id"]], "thumb_w": [small.shape[1]], "thumb_h": [small.shape[0]], "rgb": [np.ascontiguousarray(small, np.uint8).tobytes()]})

    kind = dict(slides.dtypes)["slide_id"]
    return slides.select("slide_id", path_col, "background").mapInPandas(run, f"slide_id {kind}, thumb_w int, thumb_h int, rgb binary")
