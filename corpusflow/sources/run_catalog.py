"""Checkpoint metadata of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = (
    "checkpoints array<string>, best_checkpoint string, best_metric double, last_checkpoint string"
)


def read_run_catalog(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per metadata file, with `run_id` where the folders name the run."""
    rows = spark.read.schema(CATALOG_SCHEMA).option("multiLine", "true").json(list(paths))
    return rows.withColumn("file", F.input_file_name())


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """One row per listed checkpoint, with the step in its name."""
    listed = catalog.select("*", F.posexplode("checkpoints").alias("position", "path")).drop("checkpoints")
    return listed.withColumn("step", F.regexp_extract("path", r"checkpoint-(\d+)", 1).try_cast("bigint"))


def resolve_from_catalog(catalog: DataFrame, explicit: str | None = None, load_best: bool = False,
                         load_latest: bool = False) -> DataFrame:
    """Path to resume from: explicit, else best, else latest, else the last listed; NULL without any."""
    choices = [F.lit(explicit)]
    if load_best:
        choices.append(F.col("best_checkpoint"))
    if load_latest:
        choices.append(F.col("last_checkpoint"))
    choices.append(F.try_element_at("checkpoints", F.lit(-1)))
    return catalog.withColumn("path", F.coalesce(*choices))
