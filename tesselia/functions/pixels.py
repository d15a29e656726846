"""Pixel and probability expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def gray(r: Column, g: Column, b: Column) -> Column:
    """Luma in fixed point with 16 fractional bits."""
    return F.shiftright(r * 19595 + g * 38470 + b * 7471 + 32768, 16)


def saturation(r: Column, g: Column, b: Column) -> Column:
    """0 to 255, cut off; the ratio is rounded to single precision first."""
    hi, lo = F.greatest(r, g, b), F.least(r, g, b)
    ratio = ((hi - lo).cast("double") / F.nullif(hi, F.lit(0)).cast("double")).cast("float").cast("double")
    return F.when(hi == lo, 0).otherwise(F.floor(ratio * 255).cast("int"))


def is_tissue(gray_: Column, otsu: Column, sat: Column, val: Column, sat_least: int = 18, white: int = 235) -> Column:
    return (gray_ < otsu) | ((sat >= sat_least) & (val < white))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def softmax_second(a: Column, b: Column) -> Column:
    return sigmoid(b - a)


def over_threshold(prob: Column, threshold: float = 0.5) -> Column:
    """0 or 1, compared in single precision."""
    return (prob.cast("float") >= F.lit(threshold).cast("float")).cast("int")
