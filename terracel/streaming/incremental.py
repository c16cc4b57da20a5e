"""Incremental runs: only inputs that have no finished output are processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def pending(inputs: DataFrame, done: DataFrame, key: str, overwrite: bool = False, products: int = 1) -> DataFrame:
    """Inputs whose outputs are missing or incomplete (fewer than ``products``); all with ``overwrite``."""
    if overwrite:
        return inputs
    finished = done.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= products)
    return inputs.join(finished.select(key), key, "left_anti")


def process_new_files(
    spark: SparkSession, source: str, schema: StructType | str, op: Callable[[DataFrame], DataFrame],
    target: str, checkpoint: str, max_files: int = 1000, fmt: str = "parquet",
) -> int:
    """Run ``op`` over files that arrived since the last call; returns the number of batches.

    A file stream with an available-now trigger; each batch is written to its own folder, so a
    batch repeated after a failure replaces itself.
    """
    batches = []

    def write(batch: DataFrame, batch_id: int) -> None:
        op(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        batches.append(batch_id)

    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(batches)


def upsert_days(current: DataFrame, fresh: DataFrame, key: str = "day", order: str = "seq") -> DataFrame:
    """Registry with one row per key: the latest by ``order`` wins, fresh rows over current ones."""
    rows = current.withColumn("_f", F.lit(0)).unionByName(fresh.withColumn("_f", F.lit(1)))
    rest = [c for c in current.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("_f", order)).alias("_r"))
    return best.select(key, "_r.*")


def register_days(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, key: str = "day", order: str = "seq") -> None:
    """Keep the registry at ``target`` up to date from files arriving in ``source``.

    Each batch writes a new version beside the old one and then moves the pointer file-free:
    readers take the highest version (``latest_registry``).
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c != key]
        fresh = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*")
        old = latest_registry(spark, target, below=batch_id)
        out = fresh if old is None else upsert_days(old, fresh, key, order)
        out.write.mode("overwrite").parquet(f"{target}/version={batch_id}")

    stream = spark.readStream.format("parquet").schema(schema).load(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_registry(spark: SparkSession, target: str, below: int | None = None) -> DataFrame | None:
    """Newest registry version (before batch ``below``), if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    versions = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if s.getPath().getName().startswith("version=")]
    versions = [v for v in versions if below is None or v < below]
    return spark.read.parquet(f"{target}/version={max(versions)}") if versions else None
