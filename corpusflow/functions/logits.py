"""Functions over an array of logits, one row per scored position. Indexes are 0-based."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE_INDEX = -100


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, not once per array element inside `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def valid_label(label: Column, ignore_index: int = IGNORE_INDEX) -> Column:
    return label != ignore_index


def argmax(logits: Column) -> Column:
    """Index of the largest value, the lowest one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def _ranked(logits: Column) -> Column:
    """Structs `(neg, idx)` from the largest logit down, ties by index."""
    pairs = F.transform(logits, lambda x, i: F.struct((-x.cast("double")).alias("neg"), i.alias("idx")))
    return F.array_sort(pairs)


def top_n_indices(logits: Column, n: int = 5) -> Column:
    return F.transform(F.slice(_ranked(logits), 1, n), lambda p: p["idx"])


def label_in_top(logits: Column, label: Column, n: int = 5) -> Column:
    """Whether fewer than `n` entries rank before the label's; linear, no sort."""
    own = F.try_element_at(logits, label + 1)
    before = F.filter(logits, lambda x, i: (x > own) | ((x == own) & (i < label)))
    return F.coalesce(F.size(before) < n, F.lit(False))


def log_sum_exp(logits: Column) -> Column:
    def shifted(top: Column) -> Column:
        total = F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top))
        return top + F.ln(total)

    return let(F.array_max(logits).cast("double"), shifted)


def negative_log_likelihood(logits: Column, label: Column, ignore_index: int = IGNORE_INDEX) -> Column:
    """`logsumexp(x) - x[label]`; NULL for an ignored label."""
    own = F.try_element_at(logits, label + 1).cast("double")
    return F.when(valid_label(label, ignore_index), log_sum_exp(logits) - own)


def top_k_filter(logits: Column, k: int) -> Column:
    """Entries below the k-th largest become NULL; ties with it stay."""

    def keep(largest: Column) -> Column:
        return F.transform(logits, lambda x: F.when(x >= largest, x))

    descending = F.sort_array(logits, asc=False)
    return let(F.element_at(descending, F.least(F.lit(k), F.size(logits))), keep)


def candidates(
    logits: Column, temperature: float = 1.0, top_k: int | None = None, top_p: float | None = None
) -> Column:
    """Tokens one may sample: structs `(idx, p)` from the most likely down, `p` adding up to 1.

    Temperature, then top-k, then top-p, as folds over each row's own array.
    """
    scaled = F.transform(logits, lambda x: x.cast("double") / F.lit(float(temperature)))
    return let(_ranked(scaled), lambda pairs: _filtered(pairs, top_k, top_p))


def _filtered(pairs: Column, top_k: int | None, top_p: float | None) -> Column:
    if top_k is not None:
        everything = pairs
        kth = F.element_at(everything, F.least(F.lit(top_k), F.size(everything)))["neg"]
        pairs = let(kth, lambda neg: F.filter(everything, lambda p: p["neg"] <= neg))
    if top_p is None:
        return let(pairs, _softmax)
    return let(let(pairs, _softmax), lambda ranked: _nucleus(ranked, top_p))


def _softmax(pairs: Column) -> Column:
    best = F.element_at(pairs, 1)["neg"]
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.exp(best - p["neg"]))
    return let(
        total,
        lambda t: F.transform(
            pairs, lambda p: F.struct(p["idx"].alias("idx"), (F.exp(best - p["neg"]) / t).alias("p"))
        ),
    )


def _nucleus(ranked: Column, top_p: float) -> Column:
    """Leading entries with at most `top_p` mass before them, rescaled."""
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("kept"))

    def add(state: Column, item: Column) -> Column:
        keep = (state["mass"] <= top_p).cast("int")
        return F.struct((state["mass"] + item["p"]).alias("mass"), (state["kept"] + keep).alias("kept"))

    kept = F.aggregate(ranked, start, add, lambda state: F.greatest(state["kept"], F.lit(1)))

    def rescale(entries: Column) -> Column:
        mass = F.aggregate(entries, F.lit(0.0), lambda acc, p: acc + p["p"])
        return let(
            mass,
            lambda m: F.transform(entries, lambda p: F.struct(p["idx"].alias("idx"), (p["p"] / m).alias("p"))),
        )

    return let(F.slice(ranked, F.lit(1), kept), rescale)


def draw(ranked: Column, uniform: Column) -> Column:
    """First index whose cumulated probability exceeds `uniform` in [0, 1)."""
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(None).cast("int").alias("idx"))

    def add(state: Column, item: Column) -> Column:
        mass = state["mass"] + item["p"]
        hit = state["idx"].isNull() & (mass > uniform)
        return F.struct(mass.alias("mass"), F.when(hit, item["idx"]).otherwise(state["idx"]).alias("idx"))

    # Rounding may leave the total just below 1: the last entry then takes the rest.
    last = F.element_at(ranked, -1)["idx"]
    return F.aggregate(ranked, start, add, lambda state: F.coalesce(state["idx"], last))
