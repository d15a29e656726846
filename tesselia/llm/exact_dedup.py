"""Exact deduplication as a stateful stream, with DataFrame operations only.

Fingerprints (digest, stable identifier, content locator) stream into a keyed aggregation whose state lies in RocksDB on
disk, without watermark or expiry. A key's state is the number of its rows and the identifier and locator of the row
that stays. The locator (file and row of the file) leads back to the content: rows whose digest was
hit more than once are read again and their full bytes compared. Should two texts share a digest, the rows of
that digest are grouped by text instead.

Null counts as the empty text. Of rows with equal text, the one with the largest ``doc_id`` stays, ids that are null being
the smallest; of rows repeated with that same id, one. An empty table gives no rows. Long texts are hashed and compared whole, and
columns other than ``doc_id`` and ``text`` may have any names. Grouping sums up before the shuffle, so a text with a third of all rows
sends one row a task; joins on the digest are ones that adaptive execution can split.

With a ``state`` folder, fingerprints, state and the stream's progress stay there. A later call with the same folder streams the
rows of files not seen before and finds their copies among all rows ever seen; ``docs`` is then the whole table, new files
included, from which hits are read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir, through_table
from .common import filter_by

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """All columns by position (_0, _1, ...), doc_id, text and the locator: file (its path) and row.

    Rows that don't come straight from files are written to the shared folder first, which gives them a locator.
    """
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        rows = docs.select("*", *at)
    except AnalysisException:
        n = len(docs.columns)
        table = through_table(docs.toDF(*[f"_{i}" for i in range(n)]), "dedup-input")
        rows = table.select("*", *at).toDF(*docs.columns, "_file", "_row")
    names = rows.columns
    flat = rows.toDF(*[f"_{i}" for i in range(len(names))])
    col = lambda n: F.col(f"_{names.index(n)}")
    return flat.select(
        *[f"_{i}" for i in range(len(names) - 2)],
        col("doc_id").cast("long").alias("doc_id"), F.coalesce(col("text").cast("string"), F.lit("")).alias("text"),
        F.col(f"_{len(names) - 2}").alias("file"), F.col(f"_{len(names) - 1}").alias("row"),
    )


def stream_state(spark: SparkSession, prints: str, folder: str, schema, files_per_batch: int) -> DataFrame:
    """digest, group_size and keep (doc_id, file, row) from a stream over the table of fingerprints, which goes on where it ended in ``folder``."""
    out, checkpoint, batches = f"{folder}/groups", f"{folder}/stream", []

    def store(groups: DataFrame, batch: int) -> None:
        groups.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        batches.append(batch)

    before = {k: spark.conf.get(k, None) for k in _STATE}
    try:
        for k, v in _STATE.items():
            spark.conf.set(k, v)
        keyed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(prints)
        groups = keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "file", "row")).alias("keep"))
        query = groups.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    groups = "digest binary, group_size long, keep struct<doc_id long, file string, row long>"
    try:
        found = spark.read.schema(groups).parquet(out)
    except AnalysisException:
        return spark.createDataFrame([], groups)  # no batch yet
    # Both only grow from batch to batch.
    return found if batches == [0] else found.groupBy("digest").agg(F.max("group_size").alias("group_size"), F.max("keep").alias("keep"))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 10_000, state: str | None = None) -> DataFrame:
    """One row per row: doc_id, file, row, digest, keep_id, group_size, kept.

    ``state``: a shared folder from which the next call goes on; then ``docs`` must come straight from files.
    """
    if state and not docs.inputFiles():
        raise ValueError("with a state folder, documents must come straight from files")
    return _groups(located(docs), digest, files_per_batch, state)


def _groups(at: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 10_000, state: str | None = None) -> DataFrame:
    """exact_groups of rows that have their locators."""
    spark = at.sparkSession
    folder = state or shared_dir(spark, "dedup-state")
    path, schema = f"{folder}/prints", "digest binary, doc_id long, file string, row long"
    rows, new = at.withColumn("digest", digest(F.col("text"))), at
    if state:
        try:
            seen = through_table(spark.read.schema(schema).parquet(path).select("file").distinct(), "dedup-files")
            new = filter_by(at, seen, ["file"], "left_anti")
        except AnalysisException:
            pass  # the first call
    new.withColumn("digest", digest(F.col("text"))).select("digest", "doc_id", "file", "row").write.mode("append").parquet(path)
    prints = spark.read.schema(schema).parquet(path)
    groups = stream_state(spark, path, folder, prints.schema, files_per_batch)
    hits = through_table(groups.filter("group_size > 1").select("digest"), "dedup-hits")
    texts = filter_by(rows.select("digest", "text"), hits, ["digest"], "left_semi")
    clash = through_table(texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b").select("digest"), "dedup-clash")
    columns = ["doc_id", "file", "row", "digest", "keep", "group_size"]
    found = prints.join(groups, "digest").select(columns)
    if clash.take(1):
        some = filter_by(rows.select("digest", "text", "doc_id", "file", "row"), clash, ["digest"], "left_semi")
        by_text = some.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "file", "row")).alias("keep"))
        found = found.join(clash, "digest", "left_anti").unionByName(some.join(by_text, ["digest", "text"]).select(columns))
    same = F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))
    return found.select("doc_id", "file", "row", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size", same.alias("kept"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without copies, columns as they were."""
    rows = located(docs)
    gone = through_table(_groups(rows).filter("not kept").select("file", "row"), "dedup-gone")
    n = len(docs.columns)
    return filter_by(rows, gone, ["file", "row"], "left_anti").select(*[f"_{i}" for i in range(n)]).toDF(*docs.columns)
