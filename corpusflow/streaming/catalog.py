"""A run catalog kept up to date by a stream of checkpoint reports.

The catalog is a folder of versions, one per micro-batch, each with the kept
checkpoints of every run and, in one row per run, its best and last checkpoint. A
version is complete when its marker exists, so a batch that is played again after a
failure either finds its version complete and does nothing, or writes it anew from
the one before. A catalog belongs to one stream, whose batch numbers name its versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.runs import checkpoint_retention

ENTRY = "run_id string, step bigint, path string"
ENDS = "run_id string, best struct<val_loss: double, step: bigint, path: string>, last struct<step: bigint, path: string>"
MARKER = "_COMPLETE"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions, ascending; a catalog holds two at most between batches."""
    path, files = _path(spark, f"{folder}/version=*/{MARKER}")
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in files.globStatus(path) or [])


def _version(spark: SparkSession, folder: str, number: int | None) -> tuple[DataFrame, DataFrame]:
    if number is None:
        return spark.createDataFrame([], ENTRY), spark.createDataFrame([], ENDS)
    at = f"{folder}/version={number}"
    return spark.read.schema(ENTRY).parquet(f"{at}/kept"), spark.read.schema(ENDS).parquet(f"{at}/ends")


def upsert_checkpoints(folder: str, max_checkpoints: int = 5) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch` over `(run_id, step, path, val_loss)`, rows in any order and repeated at will.

    Keeps the newest `max_checkpoints` steps of each run; what leaves the catalog, or
    arrives too old for it, goes to `evicted/version=n`. A step reported again takes
    the new path and the old one is evicted. The best checkpoint has the smallest loss
    ever reported, null losses aside and NaN above all numbers, ties by smallest step.
    Rows without a run or a step are no checkpoints and are left out.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        versions = complete_versions(spark, folder)
        if versions and number <= versions[-1]:
            return
        before, ends = _version(spark, folder, versions[-1] if versions else None)
        reports = batch.filter("run_id IS NOT NULL AND step IS NOT NULL").select(
            F.col("run_id").cast("string"), F.col("step").cast("bigint"), "path", F.col("val_loss").cast("double")
        ).persist()
        try:
            at = f"{folder}/version={number}"
            listed = before.withColumn("_new", F.lit(0)).unionByName(
                reports.select("run_id", "step", "path", F.lit(1).alias("_new"))
            )
            steps = listed.groupBy("run_id", "step").agg(F.max_by("path", F.struct("_new", "path")).alias("path"))
            checkpoint_retention(steps, max_checkpoints=max_checkpoints).write.mode("overwrite").parquet(f"{at}/kept")
            kept = spark.read.schema(ENTRY).parquet(f"{at}/kept")
            gone = listed.select("run_id", "step", "path").distinct().join(kept, ["run_id", "step", "path"], "left_anti")
            gone.write.mode("overwrite").parquet(f"{folder}/evicted/version={number}")

            best = F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "step", "path"))
            reported = reports.select("run_id", best.alias("best"), F.struct("step", "path").alias("last"))
            merged = ends.unionByName(reported).groupBy("run_id").agg(
                F.min("best").alias("best"),
                F.max("last").alias("last"),
            )
            merged.write.mode("overwrite").parquet(f"{at}/ends")
        finally:
            reports.unpersist()
        marker, files = _path(spark, f"{at}/{MARKER}")
        files.create(marker, True).close()
        for old in versions[:-1]:  # the one before stays for readers that have begun with it
            outdated, files = _path(spark, f"{folder}/version={old}")
            files.delete(outdated, True)

    return upsert


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete version in the columns of `read_run_catalog`, one row per run."""
    versions = complete_versions(spark, folder)
    kept, ends = _version(spark, folder, versions[-1] if versions else None)
    lists = kept.groupBy("run_id").agg(  # a bounded list per run
        F.transform(F.array_sort(F.collect_list(F.struct("step", "path"))), lambda c: c["path"]).alias("checkpoints")
    )
    return ends.join(lists, "run_id", "left").select(
        "run_id",
        F.coalesce("checkpoints", F.array().cast("array<string>")).alias("checkpoints"),
        F.col("best.path").alias("best_checkpoint"),
        F.col("best.val_loss").alias("best_metric"),
        F.col("last.path").alias("last_checkpoint"),
    )


def read_evicted(spark: SparkSession, folder: str) -> DataFrame:
    """`(run_id, step, path)` of all checkpoints that complete versions dropped, for whoever deletes their files."""
    versions = complete_versions(spark, folder)
    if not versions:
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(f"{ENTRY}, version bigint").parquet(f"{folder}/evicted")
    return rows.filter(F.col("version") <= versions[-1]).drop("version")
