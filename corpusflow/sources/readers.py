"""Readers for corpora and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import is_blank, strip
from corpusflow.operators.samples import with_text_column

TEXT_SCHEMA = "text string"


def load_corpus(spark: SparkSession, splits: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One table from a path per split, with a `split` column."""
    tables = [
        with_text_column(spark.read.format(fmt).load(path)).withColumn("split", F.lit(split))
        for split, path in splits.items()
    ]
    corpus = tables[0]
    for table in tables[1:]:
        corpus = corpus.unionByName(table, allowMissingColumns=True)
    return corpus


def read_jsonl_samples(spark: SparkSession, *paths: str) -> DataFrame:
    """Every line must parse and have `text`; the job fails otherwise."""
    rows = spark.read.schema(TEXT_SCHEMA).option("mode", "FAILFAST").json(list(paths))
    missing = F.raise_error(F.lit("a line has no text")).cast("string")
    return rows.select(F.when(F.col("text").isNull(), missing).otherwise(F.col("text")).alias("text"))


def read_jsonl_lenient(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines without a text are dropped; a line that does not parse still fails the job."""
    rows = spark.read.schema(TEXT_SCHEMA).option("mode", "FAILFAST").json(list(paths))
    return rows.filter(F.coalesce("text", F.lit("")) != "")


def read_mixed_jsonl(spark: SparkSession, *paths: str) -> DataFrame:
    """`(field, text)` of JSON objects whose fields differ from line to line.

    Each line gives its `text`, else its `story`, else the field that comes first in
    the first line (in order of file and place) if that line has neither, else its own
    first field. A field that is present with a null gives a null text, other values
    their JSON text; an object without fields gives null for both. A line that is
    no object, or names a field twice, fails the job.
    """
    lines = _filled_lines(spark, *paths)
    names, fields = F.json_object_keys("value"), F.parse_json("value").cast("map<string,variant>")
    opening = _opening_names(spark, lines.inputFiles())
    common = F.lit(None if {"text", "story"} & set(opening) else next(iter(opening), None)).cast("string")
    rows = lines.select(names.alias("names"), fields.alias("fields"))
    present = [F.when(F.array_contains("names", n), n) for n in (F.lit("text"), F.lit("story"), common)]
    chosen = rows.withColumn("field", F.coalesce(*present, F.try_element_at("names", F.lit(1))))
    value = F.try_element_at("fields", F.col("field"))
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
    return chosen.select("field", F.when(~F.is_variant_null(value), text).alias("text"))


def _filled_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths)).filter(F.trim("value") != "")


def _opening_names(spark: SparkSession, files: list[str]) -> list[str]:
    """Fields of the first line of the first file that has one."""
    for file in sorted(files):
        opening = _filled_lines(spark, file).filter("_metadata.file_block_start = 0").select(F.json_object_keys("value")).first()
        if opening is not None:
            return opening[0] or []
    return []


def read_paragraph_text(spark: SparkSession, *paths: str) -> DataFrame:
    """Samples separated by a blank line, stripped, none of them empty."""
    rows = spark.read.option("lineSep", "\n\n").text(list(paths))
    return rows.filter(~is_blank(F.col("value"))).select(strip(F.col("value")).alias("text"))


def read_prompts(spark: SparkSession, *paths: str) -> DataFrame:
    """One prompt per line."""
    return spark.read.text(list(paths)).filter(F.col("value") != "").withColumnRenamed("value", "prompt")


def _listed(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> list[str]:
    """Sorted paths of the files below `folder` whose name fits the pattern; file contents are not read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    # One spelling per level keeps a flat listing flat where the reader would enter `key=value` folders.
    source = f"{folder.rstrip('/')}/{pattern}" if not recursive else folder
    if not recursive:
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
            spark._jvm.org.apache.hadoop.fs.Path(source)
        )
        return sorted(s.getPath().toString() for s in found if s.isFile()) if found is not None else []
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(source)
    )
    return sorted(r["path"] for r in files.select("path").collect())


def discover_training_files(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    """Format and sorted paths: `train*.jsonl`, then the same in `processed/`, then any `*.jsonl` there, then text."""
    processed = f"{folder.rstrip('/')}/processed"
    for place, pattern in ((folder, "train*.jsonl"), (processed, "train*.jsonl"), (processed, "*.jsonl")):
        paths = _listed(spark, place, pattern)
        if paths:
            return "jsonl", paths
    return "text", _listed(spark, folder, "*.txt", recursive=True)


def read_training_files(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of the files that `discover_training_files` finds."""
    fmt, paths = discover_training_files(spark, folder)
    if not paths:
        raise FileNotFoundError(f"no training files in {folder}")
    return read_jsonl_lenient(spark, *paths) if fmt == "jsonl" else read_paragraph_text(spark, *paths)
