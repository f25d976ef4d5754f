"""Intermediate tables in the folder the cluster shares.

A written table cuts the lineage and survives the loss of executors, so a
multi-pass operator reads the same rows, in the same order, in every pass.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only for a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="corpusflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and return the table, so that later passes do not recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `materialize` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        root = scratch_root(spark).rstrip("/")
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().toUri().getPath() == spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; one whose files give fewer splits than there are cores is spread over them."""
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)
