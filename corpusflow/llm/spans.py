"""Places of pattern matches as column expressions, each in time linear in the text and its matches.

Spark's functions return matches without their places. A place is the length of the
texts between the earlier matches, which `split` with the same pattern gives, and of
these matches. Patterns must not match the empty string.

`aggregate` copies its state at each element, so no state here holds a list: running
sums and largest values come from blocks of STEP values and the totals of blocks. Texts
are cut out of blocks of BLOCK code points, as a place in a string is found by walking
to it from the string's start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.logits import let

SPANS = "array<struct<start:int,end:int,found:string>>"
STEP = 32
LEVELS = 3  # a block of the top level stands for STEP ** LEVELS values
BLOCK = 1024


def before(values: Column, of: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """For each of `values`, which are at least 0, what `of` (a sum or the largest) makes of all earlier ones; 0 at first."""
    total = lambda some: F.aggregate(some, F.lit(0), of)
    plain = F.transform(values, lambda _, i: total(F.slice(values, 1, i)))
    if not levels:
        return plain
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int")),
                         lambda k: total(F.slice(values, k * STEP + 1, STEP)))

    def placed(ahead: Column) -> Column:
        return F.transform(values, lambda _, i: of(
            F.get(ahead, F.floor(i / STEP).cast("int")), total(F.slice(values, i - i % STEP + 1, i % STEP))))

    far = let(blocks, lambda b: let(before(b, of, levels - 1), placed))
    return F.when(F.size(values) <= STEP, plain).otherwise(far)


def find_spans(text: Column, pattern: str, valid: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost matches that do not overlap, as `start`, `end` (code points) and `found`; those not `valid` are dropped."""

    def spans(matches: Column, between: Column, lengths: Column, places: Column) -> Column:
        every = F.transform(matches, lambda m, i: F.struct(
            (F.get(places, i) + F.length(F.get(between, i))).alias("start"), (F.get(places, i) + F.get(lengths, i)).alias("end"), m.alias("found")))
        return every if valid is None else F.filter(every, lambda s: valid(s["found"]))

    def placed(matches: Column, between: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: F.length(F.get(between, i)) + F.length(m))
        return let(lengths, lambda n: let(before(n, lambda x, y: x + y), lambda at: spans(matches, between, n, at)))

    none = F.array().cast(SPANS)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = let(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda b: placed(m, b))))
    return F.when(text.rlike(pattern), found).otherwise(none)


def ahead_of(spans: Column) -> Column:
    """For each of `spans`, which are ordered by `start`, the largest `end` of those before it, 0 for the first."""
    return let(F.transform(spans, lambda s: s["end"]), lambda ends: before(ends, lambda x, y: F.greatest(x, y)))


def covered(runs: Column, spans: Column) -> Column:
    """`runs` as `start`, `end`, `found` and whether one of `spans` covers part of them.

    The last span that starts before a run's end is looked up by halving; a span
    overlaps the run if one up to there reaches beyond the run's start.
    """

    def told(runs: Column, starts: Column, reach: Column, steps: Column) -> Column:
        def overlaps(r: Column) -> Column:
            last = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
                F.coalesce(F.get(starts, n + step - 1) < r["end"], F.lit(False)), n + step).otherwise(n))
            return let(last, lambda n: (n > 0) & F.coalesce(F.get(reach, n - 1) > r["start"], F.lit(False)))

        return F.transform(runs, lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["found"].alias("found"), overlaps(r).alias("covered")))

    def against(runs: Column, ordered: Column) -> Column:
        starts = F.transform(ordered, lambda s: s["start"])
        reach = let(ahead_of(ordered), lambda a: F.transform(ordered, lambda s, i: F.greatest(s["end"], F.get(a, i))))
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), lambda p: p <= F.size(ordered))
        return let(starts, lambda x: let(reach, lambda y: let(steps, lambda z: told(runs, x, y, z))))

    def free(runs: Column) -> Column:
        return F.transform(runs, lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["found"].alias("found"), F.lit(False).alias("covered")))

    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return let(runs, lambda r: F.when((F.size(spans) == 0) | (F.size(r) == 0), free(r)).otherwise(let(ordered, lambda o: against(r, o))))


def blocks_of(text: Column) -> Column:
    """The text in blocks of BLOCK code points, for `cut_out`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut_out(blocks: Column, start: Column, end: Column) -> Column:
    """Code points from `start` to before `end` of the text that was cut into `blocks`."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")

    def part(k: Column) -> Column:
        low = F.greatest(start - k * BLOCK, F.lit(0))
        return F.substring(F.get(blocks, k), low + 1, end - k * BLOCK - low)

    return F.when(end <= start, "").otherwise(F.array_join(F.transform(F.sequence(first, last), part), ""))


def as_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined, of ordered spans with a `kind`."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def tagged(spans: Column, kind: str, order: int) -> Column:
    """Spans with their kind and its place in the list of kinds."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))
