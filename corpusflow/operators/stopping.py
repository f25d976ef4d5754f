"""Which validation losses of a run become its best one, for runs of any length.

A loss becomes the best if it is at most the best so far less `min_delta`. What a
range of a run does to the best one is a step function: a best value enters the range
at the first loss that is low enough, which must be a running minimum of the range,
and from there every best loss leads to the next, up to the exit of the range. Each
range computes these steps by itself. Steps then lead from range to range: those that
the run passes are found by pointer doubling, and every range marks its rows from its
own entry. So one long run uses as many tasks as it has ranges.

A NaN always becomes the best loss, and so does whatever follows it, since nothing can
be compared with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.ordering import PART
from corpusflow.scratch import materialize

NONE = -1


def bars(losses: np.ndarray, min_delta: float) -> tuple[np.ndarray, np.ndarray]:
    """Each loss as it is compared, and the bar it sets for later ones once it is the best."""
    unknown = np.isnan(losses)
    return np.where(unknown, -np.inf, losses), np.where(unknown, np.inf, losses - min_delta)


def following(low: np.ndarray, bar: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the first later one before `ends` that is at or below its bar, or NONE.

    Minima over 2, 4, 8, ... rows are kept, and a search skips the longest stretch
    above the bar first, so n rows take n log n steps.
    """
    minima = [low]
    while 2 ** len(minima) <= len(low):
        half = 2 ** (len(minima) - 1)
        minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
    at = np.arange(1, len(low) + 1)
    for k in range(len(minima) - 1, -1, -1):
        fits = np.flatnonzero(at + 2**k <= len(low))
        above = fits[minima[k][at[fits]] > bar[fits]]
        at[above] += 2**k
    return np.where(at < ends, at, NONE)


def _segments(runs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Where the run of each row begins and ends; rows of a run are neighbours, and NULL is a run like any other."""
    before = runs.shift()
    new = ((runs != before) & ~(runs.isna() & before.isna())).to_numpy(bool)
    new[:1] = True
    begins = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    return begins[number], np.append(begins[1:], len(runs))[number]


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one range at a time; batches come sorted by range."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for _, rows in batch.groupby(PART, sort=False):
            if held and held[-1][PART].iloc[0] != rows[PART].iloc[0]:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held, ignore_index=True)


def _steps(run: str, loss: str, min_delta: float):
    """The step function of every run in every range: `low` enters at row `at` and leaves with `bar`."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _ranges(batches):
            low, bar = bars(rows[loss].to_numpy(float), min_delta)
            begins, ends = _segments(rows[run])
            onward = following(low, bar, ends)
            leaves = np.where(onward == NONE, np.arange(len(low)), onward)
            while not np.array_equal(leaves, further := leaves[leaves]):
                leaves = further
            least = pd.Series(low).groupby(begins).cummin()
            before = least.groupby(begins).shift().to_numpy()
            entries = np.flatnonzero(np.isnan(before) | (low < before))
            yield rows.iloc[entries][[run, PART, "_at"]].assign(low=low[entries], bar=bar[leaves[entries]])

    return make


def _marked(run: str, loss: str, min_delta: float):
    """Rows with `_best`: reached from the entries of their range."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _ranges(batches):
            low, bar = bars(rows[loss].to_numpy(float), min_delta)
            begins, ends = _segments(rows[run])
            onward = np.append(following(low, bar, ends), NONE)  # NONE leads to itself
            first = begins == np.arange(len(low))
            reached = np.append(rows["_entry"].to_numpy(bool) | (first & ~rows["_long"].to_numpy(bool)), False)
            while (onward != NONE).any():
                reached[onward[np.flatnonzero(reached)]] = True
                reached[NONE] = False
                onward = onward[onward]
            # A NaN in a plain float column would come back as NULL.
            exact = pd.arrays.FloatingArray(rows[loss].to_numpy(float), np.zeros(len(rows), bool))
            yield rows.drop(columns=["_entry", "_long"]).assign(**{loss: exact, "_best": reached[:-1]})

    return mark


def _by_range(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    return rows.repartition(F.col(PART)).sortWithinPartitions(PART, "_at").mapInPandas(work, schema)


def _typed(rows: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)


def mark_best(layout: DataFrame, run: str, loss: str, min_delta: float) -> DataFrame:
    """Add `_best` to the rows of an `ordered_layout` by run with the position `_at`; losses must not be NULL."""
    ranges = layout.groupBy(run, PART).agg(F.min("_at").alias("_first"), F.min(F.when(~F.isnan(loss), F.col(loss)).otherwise(-np.inf)).alias("_low"))
    # A run in two ranges covers the edge between them: there are fewer such runs than ranges, and two rows a range at most.
    parts = F.array_sort(F.collect_list(F.struct(PART, "_first", "_low")))
    long = ranges.groupBy(run).agg(parts.alias("_parts")).filter(F.size("_parts") > 1)
    long = materialize(long.withColumnRenamed(run, "_run"), "long-runs")
    rows = layout.join(F.broadcast(long.select("_run")), layout[run].eqNullSafe(F.col("_run")), "left_semi")
    entries = _entries(rows, long, run, loss, min_delta)
    of_long = long.select(F.col("_run"), F.explode(F.col("_parts._part")).alias("_range"), F.lit(True).alias("_is_long"))
    here = layout[run].eqNullSafe(F.col("_run")) & (F.col(PART) == F.col("_range"))
    told = layout.join(F.broadcast(of_long), here, "left").join(entries, "_at", "left")
    told = told.select(*layout.columns, F.coalesce("_is_long", F.lit(False)).alias("_long"), F.coalesce("_entry", F.lit(False)).alias("_entry"))
    return _by_range(told, _marked(run, loss, min_delta), _typed(layout, layout.columns) + ", _best boolean")


def _entries(rows: DataFrame, long: DataFrame, run: str, loss: str, min_delta: float) -> DataFrame:
    """`(_at, _entry)`: the rows at which runs of several ranges enter each of them."""
    steps = _by_range(rows, _steps(run, loss, min_delta), _typed(rows, [run, PART, "_at"]) + ", low double, bar double")
    steps = materialize(steps, "steps")
    known = steps.join(F.broadcast(long), steps[run].eqNullSafe(F.col("_run")))
    ahead = F.filter("_parts", lambda p: (p[PART] > F.col(PART)) & (p["_low"] <= F.col("bar")))
    targets = known.select("_run", "_at", "bar", F.get(ahead, F.lit(0))[PART].alias("_to")).filter("_to IS NOT NULL")
    # In the next range the entry is the highest step at or below the bar: the last one before it in their order.
    arriving = targets.select("_run", F.col("_to").alias(PART), F.col("bar").alias("low"), F.lit(1).alias("_kind"), F.col("_at").alias("_from"), F.lit(None).cast("bigint").alias("_step"))
    standing = steps.select(F.col(run).alias("_run"), PART, "low", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("_from"), F.col("_at").alias("_step"))
    meeting = Window.partitionBy("_run", PART).orderBy("low", "_kind", "_from").rowsBetween(Window.unboundedPreceding, 0)
    met = standing.unionByName(arriving).withColumn("_next", F.last("_step", ignorenulls=True).over(meeting))
    jumps = materialize(met.filter("_kind = 1").select(F.col("_from").alias("_at"), "_next"), "jumps")
    reached = materialize(long.select(F.col("_parts")[0]["_first"].alias("_at")), "entries")
    while not jumps.isEmpty():
        beyond = reached.join(jumps, "_at").select(F.col("_next").alias("_at"))
        reached = materialize(reached.union(beyond), "entries")
        twice = jumps.select(F.col("_at").alias("_next"), F.col("_next").alias("_end"))
        jumps = materialize(jumps.join(twice, "_next").select("_at", F.col("_end").alias("_next")), "jumps")
    return reached.distinct().withColumn("_entry", F.lit(True))
