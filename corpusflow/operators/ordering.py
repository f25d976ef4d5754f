"""Row order at scale: global positions, prefix sums, heads and segmented scans.

An order over the whole table never goes through one task. Rows are range
partitioned by their key, sorted inside each partition and written once with
their position in the partition; a table with one row per partition then holds
where each partition starts. Keys must be unique as a tuple, so a value that
holds a third of the rows is still cut into many ranges by the rest of the key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.scratch import materialize

PART = "_part"
_LOCAL = "_local"
_LOCAL_WEIGHT = "_local_weight"
SORTED_KEYS = 50_000  # as few keys as these are sorted in one task
SAMPLED_KEYS = 10_000
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _running_sum(weight: str) -> Column:
    """Sum of the weights of the earlier rows of the partition. Only the weights go to Python, not the rows."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        before = 0
        for batch in batches:
            values = batch.to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(values)
            if len(values):
                before = int(ends[-1])
            yield pa.array(ends - values)

    # It depends on the rows before it, so it must be evaluated once and where it stands.
    return F.arrow_udf(run, "bigint").asNondeterministic()(weight)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered_layout(
    df: DataFrame,
    keys: Sequence[str],
    position: str | None = "position",
    weight: str | None = None,
    start: str = "start",
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of `df` with their 0-based global `position` in key order.

    With `weight` (a non-negative whole-number column) also `start`, the sum of
    the weights of all earlier rows. `_part` names the range a row lies in; with
    neither a position nor a weight it is the only column added.

    Range partitioning computes its input twice, once to sample the keys. Costly
    columns belong in `derive`, which runs once on the sorted rows; it must keep
    the keys, the rows and their order.
    """
    columns = [F.col(k) for k in keys]
    if derive is None:
        ranged = df.repartitionByRange(*columns).sortWithinPartitions(*keys)
    else:  # a fixed number of ranges: work to come is not seen in the size of the shuffled rows
        ranged = derive(df.repartitionByRange(shuffle_partitions(df), *columns).sortWithinPartitions(*keys))
    columns = ranged.columns
    if weight is not None:
        ranged = ranged.withColumn(_LOCAL_WEIGHT, _running_sum(weight))
    numbered = ranged.withColumn("_row", F.monotonically_increasing_id())
    local = numbered.withColumn(PART, F.shiftright("_row", _ROW_BITS).cast("int")).withColumn(
        _LOCAL, F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    if position is None and weight is None:
        return materialize(local.drop("_row", _LOCAL), "layout")
    table = materialize(local.drop("_row"), "layout")

    sums = [F.count("*").alias("_rows")]
    if weight is not None:
        sums.append(F.sum(F.col(weight).cast("bigint")).alias("_weight"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so neither the window nor the broadcast grows with the rows.
    offsets = table.groupBy(PART).agg(*sums)
    earlier = [F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before")]
    if weight is not None:
        earlier.append(F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_weight_before"))
    offsets = offsets.select(PART, *earlier)

    placed = table.join(F.broadcast(offsets), PART)
    out = list(columns)
    if position is not None:
        out.append((F.col(_LOCAL) + F.col("_rows_before")).alias(position))
    if weight is not None:
        out.append((F.col(_LOCAL_WEIGHT) + F.col("_weight_before")).alias(start))
    return placed.select(*out, PART)


def global_index(df: DataFrame, keys: Sequence[str], name: str = "idx") -> DataFrame:
    return ordered_layout(df, keys, position=name).drop(PART)


def not_after(keys: Sequence[str], values: Sequence[object]) -> Column:
    """`keys <= values` in tuple order, NULL first as Spark sorts it, written so that it reaches the scan as a filter."""
    return _up_to(keys, values, F.col(keys[-1]).eqNullSafe(F.lit(values[-1])))


def _earlier(keys: Sequence[str], values: Sequence[object]) -> Column:
    """`keys < values` in the same order."""
    return _up_to(keys, values, F.lit(False))


def _up_to(keys: Sequence[str], values: Sequence[object], tie: Column) -> Column:
    condition = _before(keys[-1], values[-1]) | tie
    for key, value in reversed(list(zip(keys[:-1], values[:-1]))):
        condition = _before(key, value) | (F.col(key).eqNullSafe(F.lit(value)) & condition)
    return condition


def _before(key: str, value: object) -> Column:
    return F.lit(False) if value is None else F.col(key).isNull() | (F.col(key) < F.lit(value))


def nth_key(df: DataFrame, keys: Sequence[str], n: int, rows: int | None = None) -> tuple | None:
    """The key of the `n`-th row (from 1) in key order; None if there are fewer rows. `rows` is their number if known.

    A bounded sample of the keys left gives two pivots near the place wanted, exact
    counts tell on which side of them it lies, and only the keys between them stay.
    Each pass keeps about four by the root of the sample of them, until few enough
    are left to be sorted. Keys are read, never written or range partitioned, and
    the sample decides how many passes it takes, not what is found.
    """
    left = df.select(*keys)
    rows = left.count() if rows is None else rows
    if n > rows:
        return None
    while rows > SORTED_KEYS:
        sample = left.sample(min(1.0, SAMPLED_KEYS / rows)).limit(2 * SAMPLED_KEYS).orderBy(*keys).collect()
        if not sample:
            continue
        place, spread = n / rows * len(sample), 2 * len(sample) ** 0.5
        low = tuple(sample[min(max(int(place - spread), 0), len(sample) - 1)])
        high = tuple(sample[min(int(place + spread), len(sample) - 1)])
        sides = [side(keys, pivot) for pivot in (low, high) for side in (_earlier, not_after)]
        below_low, to_low, below_high, to_high = left.agg(*[F.count_if(s) for s in sides]).first()
        if n <= below_low:
            left, rows = left.filter(sides[0]), below_low
        elif n <= to_low:
            return low
        elif n <= below_high:
            left, rows, n = left.filter(~sides[1] & sides[2]), below_high - to_low, n - to_low
        elif n <= to_high:
            return high
        else:
            left, rows, n = left.filter(~sides[3]), rows - to_high, n - to_high
    return tuple(left.orderBy(*keys).offset(n - 1).first())


def head_rows(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    """The first `n` rows in key order; `None` keeps all.

    The rows are taken by comparing with the n-th key, which is a pushed-down
    filter and not a shuffle.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    last = nth_key(df, keys, n)
    return df if last is None else df.filter(not_after(keys, last))


def head_per_group(df: DataFrame, group: str, keys: Sequence[str], sizes: dict[str, int]) -> DataFrame:
    """The first `sizes[g]` rows, in key order, of each group named in `sizes`."""
    named = df.filter(F.col(group).isin(*sizes))
    found = {r[group]: r["count"] for r in named.groupBy(group).count().collect()}  # one row per name in `sizes`
    keep = F.lit(False)
    for name, size in sizes.items():
        here = F.col(group) == name
        if found.get(name, 0) <= size:
            keep = keep | here
        elif size > 0:
            keep = keep | (here & not_after(keys, nth_key(df.filter(here), keys, size, found[name])))
    return df.filter(keep)


def scan(
    layout: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    aggregates: dict[str, tuple[str, Column]],
    inclusive: bool = False,
) -> DataFrame:
    """Running aggregates inside groups of any size, on rows from `ordered_layout` by group and order.

    `aggregates` maps a new column to ("min" | "max" | "sum", value column), taken
    over the earlier rows of the group, with `inclusive` also the row itself. Each
    group is scanned range by range and the totals of its earlier ranges are
    carried over, so one large group is spread over many tasks.
    """
    combine = {"min": F.min, "max": F.max, "sum": F.sum}
    segment = [*group, PART]
    local = Window.partitionBy(*segment).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    # Ranges are numbered in key order: one row per group and range it reaches into.
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)

    totals = layout.groupBy(*segment).agg(*[combine[k](v).alias(f"_t_{n}") for n, (k, v) in aggregates.items()])
    carried = totals.select(
        *segment, *[combine[k](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (k, _) in aggregates.items()]
    )
    scanned = layout.select("*", *[combine[k](v).over(local).alias(f"_l_{n}") for n, (k, v) in aggregates.items()])
    result = []
    for name, (kind, _) in aggregates.items():
        here, there = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            value = F.coalesce(here, F.lit(0)) + F.coalesce(there, F.lit(0))
        else:
            value = (F.least if kind == "min" else F.greatest)(here, there)  # both skip NULL
        result.append(value.alias(name))
    carried = carried.withColumnsRenamed({k: f"_k_{k}" for k in segment})
    same = F.lit(True)
    for key in segment:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return scanned.join(carried, same).select(*layout.columns, *result)


def newest_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """The last `n` rows of each group in the given order.

    For a small `n` Spark applies the rank limit before the shuffle, so a task
    passes on at most `n` rows of a group. Beyond the limit's threshold positions
    are compared with the group's end instead.
    """
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        newest = Window.partitionBy(group).orderBy(*[F.col(k).desc() for k in order])
        ranked = df.withColumn("_rank", F.row_number().over(newest))
        return ranked.filter(F.col("_rank") <= n).drop("_rank")
    rows = ordered_layout(df, [group, *order], position="_position")
    ends = rows.groupBy(F.col(group).alias("_group")).agg(F.max("_position").alias("_last"))
    joined = rows.join(ends, F.col(group).eqNullSafe(F.col("_group")))
    return joined.filter(F.col("_position") > F.col("_last") - n).select(*df.columns)


def group_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "row") -> DataFrame:
    """0-based position of each row inside its group, for groups of any size."""
    layout = ordered_layout(df, [*group, *order], position=None)
    return scan(layout, group, order, {name: ("sum", F.lit(1).cast("bigint"))}).drop(PART)
