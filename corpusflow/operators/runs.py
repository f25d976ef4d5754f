"""Analysis of training-run logs: long tables `(run or metric name, order keys, value)`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.ordering import PART, group_positions, newest_per_group, ordered_layout, scan
from corpusflow.operators.stopping import mark_best
from corpusflow.scratch import materialize

MOVING_WINDOW = 100
BLOCK_ROWS = 65_536


def _order(keys: Sequence[str]) -> Column:
    return F.struct(*keys)


def cadence_filter(log: DataFrame, interval: int, step: str = "step") -> DataFrame:
    """Rows at steps 0, interval, 2*interval, ..."""
    return log.filter(F.col(step) % interval == 0)


# Metric tracker ---------------------------------------------------------------


def metric_averages(log: DataFrame) -> DataFrame:
    return log.groupBy("name").agg(F.avg("value").alias("average"))


def metric_average(log: DataFrame, name: str) -> DataFrame:
    """One row; NULL when the metric has no value."""
    return log.filter(F.col("name") == name).agg(F.avg("value").alias("average"))


def metric_current(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest value of every metric."""
    return log.groupBy("name").agg(F.max_by("value", _order(keys)).alias("latest"))


def metric_latest(log: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return log.filter(F.col("name") == name).agg(F.max_by("value", _order(keys)).alias("latest"))


def metric_current_wide(log: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Latest values as one row with a column per named metric."""
    return log.agg(
        *[F.max_by(F.col("value"), F.when(F.col("name") == n, _order(keys))).alias(n) for n in names]
    )


def moving_average(log: DataFrame, keys: Sequence[str], window: int = MOVING_WINDOW) -> DataFrame:
    """Mean of the last `window` values of every metric."""
    last = newest_per_group(log.select("name", *keys, "value"), "name", keys, window)
    return last.groupBy("name").agg(F.avg("value").alias("moving_average"))


def moving_average_series(log: DataFrame, keys: Sequence[str], window: int = MOVING_WINDOW) -> DataFrame:
    """Moving average at every update.

    A metric is cut into blocks of rows; the `window - 1` rows before a block are
    copied into it, so a frequent metric is spread over many tasks.
    """
    size = max(BLOCK_ROWS, window)
    rows = group_positions(log.select("name", *keys, "value"), ["name"], keys)
    block = F.floor(F.col("row") / size)
    reaches_next = F.col("row") % size >= size - (window - 1)
    blocks = F.when(reaches_next, F.array(block, block + 1)).otherwise(F.array(block))
    placed = rows.withColumn("_home", block).withColumn("_block", F.explode(blocks))
    frame = Window.partitionBy("name", "_block").orderBy("row").rowsBetween(-(window - 1), 0)
    averaged = placed.withColumn("moving_average", F.avg("value").over(frame))
    return averaged.filter(F.col("_home") == F.col("_block")).select("name", *keys, "moving_average")


# Best value and early stopping ------------------------------------------------


def best_so_far(log: DataFrame, run: str, keys: Sequence[str], loss: str) -> DataFrame:
    """Smallest earlier loss of the run, and whether this row is strictly below it."""
    layout = ordered_layout(log.select(run, *keys, loss), [run, *keys], position=None)
    scanned = scan(layout, [run], keys, {"best_before": ("min", F.col(loss))}).drop(PART)
    better = F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    return scanned.withColumn("is_best", better)


def early_stopping(
    log: DataFrame, run: str, keys: Sequence[str], loss: str, patience: int = 5, min_delta: float = 0.0
) -> DataFrame:
    """Counter and latched stop flag after every validation loss of every run.

    The counter is the number of losses since the best one, where a loss at most the
    best so far less `min_delta` becomes the best; the flag stays once the counter has
    reached `patience`. Rows without a loss are no checks: they repeat the counter.
    """
    rows = log.select(run, *keys, F.col(loss).cast("double").alias(loss))
    layout = ordered_layout(rows.filter(F.col(loss).isNotNull()), [run, *keys], position="_at")
    marked = materialize(mark_best(layout, run, loss, min_delta), "marked")
    # Every run begins with a best loss, so the last one before a row is of its own run.
    counted = scan(marked, [run], keys, {"_last": ("max", F.when(F.col("_best"), F.col("_at")))}, inclusive=True)
    counted = materialize(counted.withColumn("counter", F.col("_at") - F.col("_last")), "counters")
    latched = scan(counted, [run], keys, {"_highest": ("max", F.col("counter"))}, inclusive=True)
    checks = latched.select(run, *keys, loss, "counter", (F.col("_highest") >= patience).alias("early_stop"))
    empty = rows.filter(F.col(loss).isNull())
    return checks if empty.isEmpty() else _with_empty(checks, empty, run, keys)


def _with_empty(checks: DataFrame, empty: DataFrame, run: str, keys: Sequence[str]) -> DataFrame:
    """Rows without a loss beside the checks, with what the check before them came to, or 0 and false."""
    both = checks.unionByName(empty.withColumns({"counter": F.lit(None).cast("bigint"), "early_stop": F.lit(None).cast("boolean")}))
    layout = ordered_layout(both, [run, *keys], position="_at")
    # The latest check is the one of the greatest position.
    known = F.when(F.col("counter").isNotNull(), F.struct("_at", "counter", "early_stop"))
    filled = scan(layout, [run], keys, {"_seen": ("max", known)}, inclusive=True)
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    return filled.select(*[c for c in checks.columns if c not in ("counter", "early_stop")],
                         F.coalesce("_seen.counter", zero).alias("counter"), F.coalesce("_seen.early_stop", no).alias("early_stop"))


def early_stopping_summary(log: DataFrame, run: str, step: str, loss: str, patience: int = 5,
                           min_delta: float = 0.0) -> DataFrame:
    """Per run: losses seen, whether it stopped and at which step."""
    stops = early_stopping(log, run, [step], loss, patience, min_delta)
    return stops.groupBy(run).agg(
        F.count(loss).alias("checks"),
        F.bool_or("early_stop").alias("stopped"),
        F.min(F.when(F.col("early_stop"), F.col(step))).alias("stop_step"),
    )


# Checkpoints ------------------------------------------------------------------


def checkpoint_retention(catalog: DataFrame, run: str = "run_id", step: str = "step",
                         max_checkpoints: int = 5) -> DataFrame:
    """The newest `max_checkpoints` of each run."""
    return newest_per_group(catalog, run, [step], max_checkpoints)


def resolve_checkpoint(catalog: DataFrame, explicit: str | None = None, load_best: bool = False,
                       load_latest: bool = False) -> DataFrame:
    """Checkpoint to resume each run from: the explicit path, else best, else latest.

    The catalog holds `(run_id, step, path, val_loss)`. The list's last entry is
    also the newest, so it serves when no flag is given.
    """
    latest = F.max_by("path", "step")
    best = F.min_by("path", F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "step")))
    chosen = F.coalesce(best, latest) if load_best else latest
    if explicit is not None:
        chosen = F.coalesce(F.lit(explicit), chosen)
    return catalog.groupBy("run_id").agg(chosen.alias("path"))


# Throughput -------------------------------------------------------------------


def step_throughput(steps: DataFrame) -> DataFrame:
    return steps.withColumn("tokens_per_sec", F.try_divide(F.col("tokens"), F.col("seconds")))


def throughput_summary(steps: DataFrame, run: str = "run_id") -> DataFrame:
    rate = F.when(F.sum("seconds") > 0, F.sum("tokens") / F.sum("seconds")).otherwise(F.lit(0.0))
    return steps.groupBy(run).agg(
        F.sum("tokens").alias("total_tokens"),
        F.sum("seconds").alias("total_time"),
        rate.alias("tokens_per_sec"),
        F.max("mem_mb").alias("max_memory_mb"),
    )


def epoch_estimate(summary: DataFrame, batch_size: int, seq_length: int, batches: Column | int) -> DataFrame:
    """Tokens in one epoch, and the seconds they take at the measured rate."""
    batches = F.lit(batches) if isinstance(batches, int) else batches
    tokens = F.lit(batch_size * seq_length).cast("bigint") * batches.cast("bigint")  # an epoch may have over 2**31 tokens
    return summary.withColumn("tokens_per_epoch", tokens).withColumn(
        "seconds_per_epoch", F.try_divide(F.col("tokens_per_epoch"), F.col("tokens_per_sec"))
    )


def epoch_loss(steps: DataFrame) -> DataFrame:
    return steps.groupBy("epoch").agg(F.avg("loss").alias("epoch_loss"))
