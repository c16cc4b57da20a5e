"""Cutting long lineages through reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="terracel-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made.

    A checkpoint keeps the size estimated for its plan, which is far too low behind an explode; the next join
    with it sorts and merges instead of sending it through the driver.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True).hint("merge")
