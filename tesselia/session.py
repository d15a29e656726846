"""Sessions, shared scratch space and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: Settings that bound batches of rows, so that executors and workers hold little of long texts at once; set only where a user left the default.
_BATCHES = [("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.parquet.columnarReaderBatchSize", "4096", "1024")]


def build_session(cores: int | str = 8, memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tesselia")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Also bounds Arrow batches. Executors may not have the repository on their path, so the package's sources are zipped and added
    to the application. The zip is built on the driver and served by Spark itself.
    """
    sc = spark.sparkContext
    for key, default, value in _BATCHES:
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tesselia-")) / "tesselia_src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share.

    It lies under ``spark.checkpoint.dir``. Only where that is unset (local tests) a temporary folder of
    this machine is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = "file://" + os.path.join(tempfile.gettempdir(), "tesselia-shared")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
