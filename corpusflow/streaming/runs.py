"""The metric tracker and early stopping on streams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues


def stream_metric_tracker(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average, latest value and count of every metric; for update or complete mode.

    The state is a few numbers per metric, whatever the number of updates.
    """
    return updates.groupBy("name").agg(
        F.avg("value").alias("average"),
        F.max_by("value", F.struct(*keys)).alias("latest"),
        F.count("*").alias("updates"),
    )


class _EarlyStopping(StatefulProcessor):
    """Per run what the losses up to the watermark came to, and the later ones, whose order is still open.

    Each micro-batch folds what the watermark has passed into the first part for
    good, and reports it with the open losses folded in their present order.
    """

    def __init__(self, run: str, patience: int, min_delta: float, timed: bool):
        self.run, self.patience, self.min_delta, self.timed = run, patience, min_delta, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.settled = handle.getValueState("settled", "checks bigint, counter bigint, best double, stop_step bigint")
        self.open = handle.getListState("open", "at bigint, step bigint, loss double")

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        state = tuple(self.settled.get()) if self.settled.exists() else (0, 0, None, None)
        waiting = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        waiting += [(r["_time"], r["_step"], r["_loss"]) for r in rows]
        waiting.sort(key=lambda r: r[:2])
        passed = timerValues.getCurrentWatermarkInMs() * 1000 if self.timed else None
        for number, (at, step, loss) in enumerate(waiting):
            if passed is not None and at > passed:
                later = waiting[number:]
                break
            state = self._after(state, step, loss)
        else:
            later = []
        if state[0]:
            self.settled.update(state)
        self.open.put(later) if later else self.open.clear()
        for _, step, loss in later:
            state = self._after(state, step, loss)
        checks, counter, best, stop_step = state
        report = {"checks": checks, "counter": counter, "best_loss": best, "stopped": stop_step is not None, "stop_step": stop_step}
        yield Row(**{self.run: key[0]}, **report)

    def _after(self, state: tuple, step: int, loss: float) -> tuple:
        """A loss not above the best less `min_delta` is the new best, and a NaN on either side always."""
        checks, counter, best, stop_step = state
        if best is None or math.isnan(loss) or math.isnan(best) or loss <= best - self.min_delta:
            return checks + 1, 0, loss, stop_step
        counter += 1
        reached = counter >= self.patience and stop_step is None
        return checks + 1, counter, best, step if reached else stop_step

    def close(self) -> None:
        pass


def stream_early_stopping(losses: DataFrame, run: str, step: str, loss: str, patience: int = 5,
                          min_delta: float = 0.0, time: str | None = None) -> DataFrame:
    """Checks, counter, best loss and latched stop of every run, in update mode; the query needs the RocksDB state store.

    With `time`, a column of a watermark, losses may arrive in any order as far as the
    watermark lets them: they are taken in the order of time and step. Without it,
    losses of a run must arrive in step order across micro-batches. The state of a run
    is a few numbers and the losses newer than the watermark. Rows without a loss are no checks.
    """
    at = F.unix_micros(F.col(time).cast("timestamp")) if time else F.lit(0).cast("bigint")
    rows = losses.filter(F.col(loss).isNotNull()).select(run, *([time] if time else []), at.alias("_time"), F.col(step).cast("bigint").alias("_step"), F.col(loss).cast("double").alias("_loss"))
    output = (
        f"`{run}` {losses.schema[run].dataType.simpleString()}, checks bigint, counter bigint, best_loss double, "
        "stopped boolean, stop_step bigint"
    )
    processor = _EarlyStopping(run, patience, min_delta, time is not None)
    return rows.groupBy(run).transformWithState(processor, output, "update", "eventTime" if time else "none")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting is put back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)
