"""Near-duplicate groups with SuperMinHash.

Every element of a document's shingle set draws its own random permutation of the
signature's places and puts rank + fraction there, round by round; a place keeps the
least value. The ranks of one element are all different, which makes the estimate
less varied than with independent draws, and once every place holds a value below the
next round's rank no later round can change it: a document of n shingles needs about
m log m / n rounds (Ertl, 2017).

1. A document becomes the digest of its set and `bands` hashes of `rows`
   signature places. Documents with equal sets are one class from then on, so copies
   are never paired.
2. Classes that share a band hash form a bucket. Pairs are not enumerated: a bucket
   first compares its members with its middle, the one that meets most others, and
   links them where the full sets agree. In further rounds members outside the middle's
   component are compared with the others, except with those they are joined to and
   those that cannot be near: Jaccard distance is a metric, so two members whose
   distances to the middle differ by more than 0.2 are no link, nor are sets whose
   elements are spread too differently over PARTS hash parts. Rounds go on until every
   bucket is one component or has no pair left, so no connection is lost.
3. Links are reduced by union-find inside partitions and then joined across them.

With 40 bands of 5 rows a pair of similarity 0.8 shares no bucket with probability
1.3e-7.

Rows with a null or blank text have an empty set and are linked with nothing. A row
with a null id is kept, with a null component. Rows that repeat an id are one node:
they share the links of all of them and are kept or dropped together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.words import mix, shingles, slices, word_hashes
from corpusflow.scratch import discard, materialize

BANDS, ROWS = 40, 5
LEADERS = 64  # leaders of a bucket in the second round; twice as many in each later one, up to
MOST_LEADERS = 1000  # what Spark selects per group before it shuffles
BROADCAST_ELEMENTS = 2_000_000  # elements of all leaders' sets, 8 bytes each, that go to every task
PARTS = 128  # hash parts whose sizes bound how far two sets differ
PIECE = 1000  # pairs of one leader that are compared together
ELEMENTS = 60_000  # elements whose permutations are held at a time

_U = np.uint64
Batches = Iterator[pa.RecordBatch]


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures of sets of distinct 64-bit elements: a row of `places` values for each; empty sets stay infinite."""
    lengths = np.array([len(s) for s in sets], np.int64)
    signature = np.full((len(sets), places), np.inf, np.float32)
    if not lengths.sum():
        return signature
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lengths)
    order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(element), 1))
    flat = signature.reshape(-1)
    steps = np.arange(1, places + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F)
    for j in range(places):
        drawn = mix(element + steps[j])
        k = j + ((drawn >> _U(40)) % _U(places - j)).astype(np.int64)
        row = np.arange(len(element))
        place = order[row, k]
        order[row, k] = order[:, j]
        value = ((drawn & _U(0x7FFFFF)).astype(np.float32) / np.float32(1 << 23)) + np.float32(j)
        np.minimum.at(flat, owner * places + place, value)
        open_ = signature.max(axis=1) >= j + 1  # the next round draws values from j + 1 on
        going = open_[owner]
        if not going.any():
            break
        if not going.all():
            element, owner, order = element[going], owner[going], order[going]
    return signature


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signature[:, : bands * rows].copy().view(np.uint32).astype(np.uint64).reshape(len(signature), bands, rows)
    value = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15), bits.shape[:2]).copy()
    for r in range(rows):
        value = mix(value * _U(0xD1342543DE82EF95) + bits[:, :, r])
    return value


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    words, at = word_hashes(texts)
    return [np.unique(shingles(words[a:b], size)) for a, b in zip(at[:-1], at[1:])]


def _digest(elements: np.ndarray) -> int:
    """64 bits that name the set."""
    total = np.add.reduce(mix(elements), dtype=np.uint64)
    return int(mix(np.array([total], np.uint64) + _U(len(elements))).view(np.int64)[0])


def _sketch(size: int, bands: int, rows: int):
    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            sets = _sets(batch.column("text"), size)
            counts = np.array([len(s) for s in sets])
            groups = np.cumsum(counts) // ELEMENTS
            parts = [sets[a:b] for a, b in _runs(groups)]
            hashes = np.concatenate([band_hashes(super_minhash(p, bands * rows), bands, rows) for p in parts])
            digests = pa.array([_digest(s) for s in sets], pa.int64())
            at = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands)
            lists = pa.ListArray.from_arrays(at, pa.array(hashes.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), digests, lists],
                names=["id", "n", "class", "bands"],
            )

    return run


def _runs(groups: np.ndarray) -> list[tuple[int, int]]:
    at = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    return list(zip(at, np.r_[at[1:], len(groups)]))


def _full_sets(size: int):
    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            sets = _sets(batch.column("text"), size)
            at = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32))
            flat = np.concatenate(sets).view(np.int64)
            digests = pa.array([_digest(s) for s in sets], pa.int64())
            parts = [np.bincount((s >> _U(32)).astype(np.int64) % PARTS, minlength=PARTS) for s in sets]
            spread = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * PARTS, pa.array(np.concatenate(parts), pa.int32()))
            yield pa.RecordBatch.from_arrays([digests, pa.ListArray.from_arrays(at, pa.array(flat)), spread], names=["id", "elements", "spread"])

    return run


def _forest(batches: Batches) -> Batches:
    """Union-find over the links of a task: every node with the least node it reaches here."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (above := parent.setdefault(root, root)) != root:
            root = above
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    nodes = list(parent)
    found = pa.array([find(x) for x in nodes], pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), found], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """`(node, component)` for the nodes of `links(a, b)`: the least node each one reaches.

    Partitions reduce their links to stars first. Then each node takes the least
    label among its neighbours and jumps to the label of its label, until no label
    changes; the number of rounds grows with the logarithm of the longest chain.
    """
    reduced = materialize(links.select("a", "b").mapInArrow(_forest, "a bigint, b bigint"), "stars")
    stars = reduced.filter("a != b")
    both = materialize(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    discard(reduced)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    while True:
        reached = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        near = labels.join(reached, labels["node"] == reached["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("farther"))
        step = materialize(near.join(jump, near["component"] == jump["at"], "left").select(
            "node", "old", F.least("component", "farther").alias("component")), "labels")
        discard(labels)
        labels = step.select("node", "component")
        if step.filter("component < old").isEmpty():
            discard(both)
            return labels


def _may_link(one: Column, two: Column, percent: int) -> Column:
    """Whether sets with these sizes of hash parts can be as similar as that.

    Elements of only one set are at least as many as the differences of the sizes, and
    sets that are linked have at most (100 - percent) / (100 + percent) of all elements of both so.
    """
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    apart = total(F.zip_with(one, two, lambda x, y: F.abs(x - y)))
    return apart * (100 + percent) <= (total(one) + total(two)) * (100 - percent)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs(leader, id)` with their similarity on full sets; the pairs of a frequent leader are cut into pieces."""
    sets = sets.select("id", "elements")
    ahead = sets.join(pairs.select(F.col("leader").alias("id")).distinct(), "id").select(
        F.col("id").alias("leader"), F.col("elements").alias("theirs"))
    if (ahead.agg(F.sum(F.size("theirs")).alias("n")).first()["n"] or 0) <= BROADCAST_ELEMENTS:
        return _counted(pairs.join(sets, "id").join(F.broadcast(ahead), "leader"))
    sized = pairs.join(pairs.groupBy("leader").agg(F.ceil(F.count("*") / PIECE).alias("pieces")), "leader")
    sized = sized.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")))
    leaders = sized.groupBy("leader").agg(F.max("pieces").alias("pieces"))
    copies = leaders.join(sets.select(F.col("id").alias("leader"), F.col("elements").alias("theirs")), "leader").select(
        "leader", "theirs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece"))
    members = sized.join(sets, "id")
    return _counted(members.join(copies, ["leader", "piece"]))


def _counted(both: DataFrame) -> DataFrame:
    shared = F.size(F.array_intersect("elements", "theirs"))
    counted = both.select("leader", "id", shared.alias("shared"), (F.size("elements") + F.size("theirs")).alias("both"))
    return counted.select("leader", "id", "shared", (F.col("both") - F.col("shared")).alias("joint"))


def _links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links `(a, b)` between members of the same bucket `(bucket, id)`, enough to join all that are connected."""
    found: DataFrame | None = None  # every node with its component, as far as known
    slack = 1 - percent / 100
    # Who shares buckets with most others is nearest to the middle of a group, and the same in all its buckets.
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size"))
    rank = buckets.join(sizes, "bucket").groupBy("id").agg(F.sum("size").alias("met"), F.collect_list("bucket").alias("mine"))
    members = materialize(buckets.join(rank, "id").withColumns({"label": F.col("id"), "near": F.lit(None).cast("double")}), "members")
    number = 1
    while True:
        table = members
        # Later leaders come from outside the component of the bucket's middle.
        first = members.groupBy("bucket").agg(F.max(F.struct("met", "label")).alias("middle"))
        inside = F.lit(False) if number == 1 else F.col("label") == F.col("middle.label")
        placed = members.join(first, "bucket").withColumn("place", F.struct(inside.alias("inside"), (-F.col("met")).alias("met"), F.col("id").alias("id")))
        ranked = placed.withColumn("_r", F.row_number().over(Window.partitionBy("bucket").orderBy("place")))
        leaders = ranked.filter(F.col("_r") <= number).select(
            "bucket", F.col("id").alias("leader"), F.col("label").alias("theirs"), F.col("near").alias("leader_near"), F.col("place").alias("ahead"), F.col("mine").alias("leads"),
            *([] if number == 1 else [F.col("spread").alias("leader_spread")]))
        # Two members whose distances to the bucket's middle differ by more than the limit are farther apart than it.
        apart = F.coalesce(F.abs(F.col("near") - F.col("leader_near")) > slack + 1e-9, F.lit(False))
        # Two members may share many buckets: the least of them has the pair. The middle meets all in all its buckets.
        once = F.lit(True) if number == 1 else F.array_min(F.array_intersect("mine", "leads")) == F.col("bucket")
        close = F.lit(True) if number == 1 else _may_link(F.col("spread"), F.col("leader_spread"), percent)
        meets = placed.join(leaders, "bucket").filter((F.col("place") > F.col("ahead")) & (F.col("label") != F.col("theirs")) & ~apart & once & close)
        meets = materialize(meets.select("bucket", "id", "leader"), "meets")
        done = materialize(_compared(meets.select("leader", "id").distinct(), sets), "compared")
        if number == 1:
            gauge = meets.join(done.select("leader", "id", (F.col("shared") / F.col("joint")).alias("near")), ["leader", "id"]).select("bucket", "id", "near")
            members = members.drop("near").join(gauge, ["bucket", "id"], "left")
        new = done.filter(F.col("shared") * 100 >= F.col("joint") * percent).select(F.col("leader").alias("a"), F.col("id").alias("b"))
        if found is None or not new.isEmpty():
            known = new if found is None else found.unionByName(new)
            last, found = found, components(known).select(F.col("node").alias("a"), F.col("component").alias("b"))
            if last is not None:
                discard(last)
        gone = leaders.select("bucket", F.col("leader").alias("id"))
        rest = members.select("bucket", "id", "met", "mine", "near").join(gone, ["bucket", "id"], "left_anti").join(found, F.col("id") == F.col("a"), "left")
        rest = rest.select("bucket", "id", "met", "mine", "near", F.coalesce("b", "id").alias("label"))
        # Members that are joined already need no comparison, and a bucket of such members is done.
        mixed = rest.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
        members = materialize(rest.join(mixed, "bucket").join(sets.select("id", "spread"), "id"), "buckets")
        discard(table, meets, done)
        if members.isEmpty():
            return found
        number = min(max(LEADERS, 2 * number), MOST_LEADERS)


def near_duplicates(
    df: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, key: str = "doc_id"
) -> DataFrame:
    """`(key, n_shingles, component_id, kept)` for every row of `df(key, text)`.

    Rows are linked when their sets of `size`-word shingles share at least `percent`
    of a hundred of their union; a component is named by its least key.
    """
    texts = df.select(F.col(key).cast("bigint").alias("id"), "text")
    sketch = materialize(texts.mapInArrow(_sketch(size, bands, rows), "id bigint, n bigint, class bigint, bands array<bigint>"), "sketch")
    usable = sketch.filter("n > 0 AND id IS NOT NULL")
    classes = materialize(usable.groupBy("class").agg(F.min("id").alias("first")), "classes")

    alone = usable.join(classes, (usable["id"] == classes["first"]) & (usable["class"] == classes["class"]), "left_semi")
    banded = alone.select(F.col("class").alias("id"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("bucket")
    buckets = materialize(banded.join(shared, "bucket").distinct(), "buckets")
    # Rows with the same id tie their classes together.
    ids = usable.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a < b")
    links = [usable.join(ids, "id").select("a", F.col("class").alias("b")).filter("a != b")]
    if not buckets.isEmpty():
        wanted = buckets.select(F.col("id").alias("class")).distinct().join(classes, "class")
        read = texts.join(wanted.select(F.col("first").alias("id")), "id", "left_semi")
        sets = materialize(read.mapInArrow(_full_sets(size), "id bigint, elements array<bigint>, spread array<int>"), "sets").dropDuplicates(["id"])
        links.append(_links(buckets, sets, percent))
        discard(buckets, sets)
    found = components(reduce(DataFrame.unionByName, links))
    named = classes.join(found, classes["class"] == found["node"], "left").select(
        classes["class"], "first", F.coalesce("component", classes["class"]).alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    member = named.join(least, "component").select("class", "component_id")
    out = sketch.join(member, "class", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
