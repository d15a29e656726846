"""Slides, thumbnails, logit patches and runs, derived from the driver's tables by integer arithmetic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

TARGET, PATCH, STRIDE, HALO, TILE = 0.88, 512, 384, 64, 1024
#: Logit patches: size, halo, stride and canvas side.
SMALL, SMALL_HALO, SMALL_STRIDE, CANVAS, SMALL_TILE = 8, 2, 4, 30, 16
THUMB_W, THUMB_H = 16, 12


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


SLIDES = """
SELECT slide_id, width0, height0, mpp_x, mpp_x AS mpp_y,
       CASE WHEN b > 0 THEN width0 {div} 8 END AS bnd_x, CASE WHEN b > 0 THEN height0 {div} 8 END AS bnd_y,
       CASE WHEN b > 0 THEN width0 {div} b END AS bnd_w, CASE WHEN b > 0 THEN height0 {div} b END AS bnd_h
FROM (SELECT cast(p_partkey AS int) AS slide_id, cast(4096 + (p_partkey * 7919) % 9000 AS int) AS width0, cast(4096 + (p_partkey * 6101) % 7000 AS int) AS height0,
             cast(CASE WHEN p_partkey % 2 = 0 THEN 0.25 ELSE 0.5 END AS double) AS mpp_x, CASE WHEN p_partkey % 9 = 0 THEN 40 WHEN p_partkey % 3 = 0 THEN 2 ELSE 0 END AS b
      FROM {part})
"""

#: One property map for each arm of the resolution chain, by slide_id % 8.
PROPS = {
    0: {"openslide.MPP-X": "0.2425", "openslide.mpp-y": " 0.2426 "}, 1: {"mpp_x": "0.51"}, 2: {"aperio.MPP": "0.4990"},
    3: {"openslide.comment": "scan; microns per pixel = 0.88"}, 4: {"tiff.XResolution": "50800", "tiff.YResolution": "101600", "tiff.ResolutionUnit": " Inch "},
    5: {"tiff.XResolution": "20000", "tiff.ResolutionUnit": "centimeter"}, 6: {"aperio.AppMag": "20"}, 7: {"openslide.mpp-x": "1/4", "openslide.mpp-y": "x"},
}

TEXTS = ["AppMag = 20|MPP = 0.2520|Left = 3", "mpp_x: 0.5", "2 Microns per pixel 0.25", "micrometers per pixel=1", "Pixel size: 0.46 um", "pixelsize = 0.30 µm", "nothing here", ""]
NUMBERS = ["0.25", " 1e-1 ", "1/4", "3 / 0", "abc", "", "7", "-2.5"]


def slides(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "part").createOrReplaceTempView("_part")
    return spark.sql(SLIDES.format(div="div", part="_part")).select("slide_id", "width0", "height0", "mpp_x", "mpp_y", *[F.col(c).cast("int") for c in ("bnd_x", "bnd_y", "bnd_w", "bnd_h")])


def levels(spark: SparkSession, sf: str) -> DataFrame:
    """slide_id and levels: array of structs, downsampled by 1 to 16."""
    s = slides(spark, sf)
    downs = F.array(*[F.lit(float(d)) for d in (1, 2, 4, 8, 16)])
    level = lambda d, i: F.struct(i.alias("index"), d.alias("downsample"), (F.col("mpp_x") * d).alias("mpp_x"), (F.col("mpp_y") * d).alias("mpp_y"))
    return s.withColumn("levels", F.transform(downs, level))


def thumbs(spark: SparkSession, sf: str) -> DataFrame:
    """A thumbnail of every slide: near-white, with a coloured rectangle and a band of noise."""
    s = slides(spark, sf).select("slide_id")
    g = s.withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(THUMB_H - 1)))).withColumn("tx", F.explode(F.sequence(F.lit(0), F.lit(THUMB_W - 1))))
    shift = F.col("slide_id") % 7
    rect = (F.col("tx") >= 2 + shift) & (F.col("tx") < 9 + shift) & (F.col("ty") >= 2) & (F.col("ty") < 8)
    noise = (F.col("tx") * 31 + F.col("ty") * 17 + F.col("slide_id") * 13) % 256
    band = (F.col("ty") >= 9) & (F.col("ty") < 11)
    colour = lambda full, k: F.when(rect, full).when(band, noise * k % 256).otherwise(250 + (F.col("tx") + F.col("ty")) % 6).cast("int")
    return g.select("slide_id", "tx", "ty", colour(180, 1).alias("r"), colour(60, 7).alias("g"), colour(120, 3).alias("b"))


def thumb_images(spark: SparkSession, sf: str) -> DataFrame:
    """``thumbs``, one row a slide: the pixels as bytes."""
    ty, tx = np.mgrid[:THUMB_H, :THUMB_W]

    def paint(batches):
        for batch in batches:
            n = batch.column(0).to_numpy().astype(np.int64)[:, None, None]
            rect = (tx >= 2 + n % 7) & (tx < 9 + n % 7) & (ty >= 2) & (ty < 8)
            noise = (tx * 31 + ty * 17 + n * 13) % 256
            band = np.broadcast_to((ty >= 9) & (ty < 11), noise.shape)
            rgb = np.stack([np.where(rect, full, np.where(band, noise * k % 256, 250 + (tx + ty) % 6)) for full, k in ((180, 1), (60, 7), (120, 3))], -1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in rgb], pa.binary())], ["slide_id", "rgb"])

    s = slides(spark, sf).select("slide_id").mapInArrow(paint, "slide_id int, rgb binary")
    return s.select("slide_id", F.lit(THUMB_W).alias("thumb_w"), F.lit(THUMB_H).alias("thumb_h"), "rgb")


def logit_patches(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as 8 x 8 logits at the places of a 7 x 7 grid; canvases are numbered by label and block of 49."""
    n = F.row_number().over(W.partitionBy("label").orderBy("vec_id")) - 1
    e = table(spark, sf, "embeddings").withColumn("rn", n)
    place = lambda c: F.when(c == 6, CANVAS - SMALL).otherwise(c * SMALL_STRIDE).cast("int")
    cell = F.col("rn") % 49
    return e.select((F.col("label") * 1000 + F.expr("rn div 49")).cast("int").alias("canvas"), place(cell % 7).alias("out_x"), place(F.floor(cell / 7)).alias("out_y"), F.lit(CANVAS).alias("out_w"), F.lit(CANVAS).alias("out_h"), F.col("embedding").alias("logits"))


def run_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.col("user_id").alias("run_id"), F.col("event_type").alias("event"), "ts", F.col("value").alias("seconds"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as runs: patches and seconds in fixed steps."""
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("slide_"), (F.col("o_custkey") % 50).cast("string")).alias("slide_stem"), F.concat_ws("_", F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'"), F.col("o_orderkey").cast("string")).alias("run_id"),
        (F.col("o_orderkey") % 9000 + 100).alias("grid_patches"), (F.col("o_orderkey") % 900 + 10).alias("candidate_patches"),
        (F.col("o_orderkey") % 128).cast("double").alias("wall_seconds"), ((F.col("o_orderkey") % 128).cast("double") / 2).alias("processing_seconds"),
    )
