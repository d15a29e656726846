"""Tesselia: tiled-raster planning, scoring and stitching, expressed as Spark DataFrames."""

__version__ = "0.1.0"
