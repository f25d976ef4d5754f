"""Writers for samples and results. All splits of a table are written by one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusflow.operators.runs import checkpoint_retention
from corpusflow.operators.samples import SMALL_BUNDLE, head_per_split


def write_splits_jsonl(samples: DataFrame, path: str) -> None:
    """`split=…/` folders of `{"text": …}` lines."""
    samples.select("split", "text").write.partitionBy("split").json(path)


def write_splits_text(samples: DataFrame, path: str) -> None:
    """`split=…/` folders of samples, each closed by a blank line."""
    samples.select("split", "text").write.partitionBy("split").option("lineSep", "\n\n").text(path)


def write_splits(samples: DataFrame, path: str) -> None:
    write_splits_text(samples, f"{path}/text")
    write_splits_jsonl(samples, f"{path}/jsonl")


def write_small_bundle(samples: DataFrame, path: str, keys: tuple[str, ...] = ("sample_no",),
                       sizes: dict[str, int] | None = None) -> None:
    write_splits(head_per_split(samples, keys, SMALL_BUNDLE if sizes is None else sizes), f"{path}/small")


def write_tokenizer_corpus(corpus: DataFrame, path: str) -> int:
    """One text per line, as training reads it; returns how many were written."""
    written = Observation()
    counted = corpus.select("text").observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.option("lineSep", "\n").text(path)
    return written.get["n"]


def write_eval_results(results: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON per kind of result."""
    for kind, table in results.items():
        table.write.mode("overwrite").json(f"{path}/{kind}")


def write_run_catalog(catalog: DataFrame, path: str, max_checkpoints: int = 5) -> None:
    """Per run one JSON file: kept checkpoints, best checkpoint and metric, last checkpoint."""
    summary = catalog_summary(catalog, max_checkpoints).repartition("run_id")
    summary.write.mode("overwrite").partitionBy("run_id").json(path)


def catalog_summary(catalog: DataFrame, max_checkpoints: int = 5) -> DataFrame:
    kept = checkpoint_retention(catalog, max_checkpoints=max_checkpoints)  # a bounded list per run
    lists = kept.groupBy("run_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", "path"))), lambda c: c["path"]).alias("checkpoints")
    )
    scored = F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "step"))
    ends = catalog.groupBy("run_id").agg(
        F.min_by("path", scored).alias("best_checkpoint"),
        F.min("val_loss").alias("best_metric"),
        F.max_by("path", "step").alias("last_checkpoint"),
    )
    return lists.join(ends, "run_id")
