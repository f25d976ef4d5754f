"""Positions in a corpus that grows.

Rows are laid out once, when they arrive, and written with their place in their own
append. A segment table has one row for each range of each append, with its rows and
weight; the sums of earlier appends give where an append starts. Reading adds two
numbers to each row and orders nothing, and an append reads no earlier rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.operators.ordering import PART, ordered_layout

SEGMENTS = f"{PART} int, rows bigint, weight bigint, append bigint"


def _segments(spark: SparkSession, path: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/segments")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], SEGMENTS)
    return spark.read.schema(SEGMENTS).parquet(f"{path}/segments")


def append_rows(df: DataFrame, path: str, keys: Sequence[str], weight: str | None = None, number: int | None = None) -> int:
    """Add rows after all earlier appends, among each other in key order; returns the number of the append.

    The columns `_row` and `_start` are the rows and the weight before a row in its own
    append. Segments are written last and rows without segments are not read, so an
    append that was cut short is as if it had not begun. With a `number`, as of a
    micro-batch, an append that is there already is not made again; numbers must ascend.
    """
    spark = df.sparkSession
    last = _segments(spark, path).agg(F.max("append")).first()[0]
    if number is None:
        number = 0 if last is None else last + 1
    elif last is not None and number <= last:
        return number
    placed = ordered_layout(df, keys, position="_row", weight=weight, start="_start")
    placed = placed if weight else placed.withColumn("_start", F.lit(0).cast("bigint"))
    rows = f"{path}/rows/append={number}"
    placed.write.mode("overwrite").parquet(rows)
    sizes = F.count("*").alias("rows"), F.coalesce(F.sum(weight) if weight else F.lit(0), F.lit(0)).cast("bigint").alias("weight")
    written = spark.read.schema(placed.schema).parquet(rows).groupBy(PART).agg(*sizes)
    written.write.mode("overwrite").parquet(f"{path}/segments/append={number}")
    return number


def read_rows(spark: SparkSession, path: str, position: str = "position", start: str = "start") -> DataFrame:
    """All rows with their `position` and the weight before them, `start`, in the whole corpus."""
    before = Window.orderBy("append").rowsBetween(Window.unboundedPreceding, -1)  # one row per append
    appends = _segments(spark, path).groupBy("append").agg(F.sum("rows").alias("_n"), F.sum("weight").alias("_w")).select(
        "append",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_weight_before"),
    )
    joined = spark.read.parquet(f"{path}/rows").withColumn("append", F.col("append").cast("bigint")).join(appends, "append")
    return joined.withColumns(
        {position: F.col("_row") + F.col("_rows_before"), start: F.col("_start") + F.col("_weight_before")}
    ).drop("append", PART, "_row", "_start", "_rows_before", "_weight_before")
