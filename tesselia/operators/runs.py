"""Analytics over the registry of runs and their events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def progress_sample(events: DataFrame, every: int = 8, run: str = "run_id", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Of each run's steps the first, the last and every ``every``-th."""
    by = W.partitionBy(run)
    numbered = events.withColumns({"idx": F.row_number().over(by.orderBy(*order)).cast("long"), "total": F.count(F.lit(1)).over(by)})
    return numbered.filter((F.col("idx") == 1) | (F.col("idx") == F.col("total")) | (F.col("idx") % every == 0))


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("run_id", "event").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def throughput(runs: DataFrame) -> DataFrame:
    """Patches a second of the wall and of the processing loop."""
    rate = lambda n, s: F.col(n) / F.greatest(F.col(s), F.lit(1e-9))
    return runs.withColumns({f"{k}_per_{s}_second": rate(f"{k}_patches", f"{s}_seconds") for k in ("grid", "candidate") for s in ("wall", "processing")})


def batch_summary(runs: DataFrame) -> DataFrame:
    """One row a run; seconds and rates to six places."""
    numbers = [c for c, t in runs.dtypes if t == "double"]
    return runs.withColumns({c: F.round(c, 6) for c in numbers})


def latest_runs(runs: DataFrame) -> DataFrame:
    """Each slide's newest run; run ids start with their UTC time."""
    newest = runs.groupBy("slide_stem").agg(F.max_by(F.struct(*[c for c in runs.columns if c != "slide_stem"]), "run_id").alias("r"))
    return newest.select("slide_stem", "r.*")
