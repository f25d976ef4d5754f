"""A Merkle manifest of a dataset: digests, a digest-to-children store, and inclusion proofs by descent.

Every row is a leaf. Within a source, leaves stand in key order, and runs of FANOUT
nodes become a parent until one node, the subroot, remains; the subroots, in order of
their source, become the root the same way.

The store has a record for a node and its descendants of up to STEPS generations,
addressed by the node's digest, so a lookup resolves several digits of a rank. A
request for a leaf descends from the root: it looks up a record by digest, follows the
digits of the leaf's rank in base FANOUT, and collects the children it does not take.
Requests that share a way down share its lookups, so no digest is joined once for each
leaf below it. The segments, read backwards, are the proof from the leaf up.

Null fields have a digest of their own, rows are ordered with null keys first, equal
rows by digest, so repeated rows are leaves of their own next to each other. An empty
table has no records, no root and no proofs. Texts are hashed as they are, whatever
their length; columns that are not named take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordering import global_index, group_positions
from corpusflow.scratch import materialize

FANOUT = 3
STEPS = 5
BLOCK = FANOUT**STEPS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Digests ---------------------------------------------------------------------


def digest(parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined strings of an array."""
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its text, or `-` for a null."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed).cast("binary"), 256)


def ranked_leaves(rows: DataFrame, tree: str, keys: Sequence[str]) -> DataFrame:
    """Add `rank`, the place of each row (with a `leaf`) within its `tree`, to be read several times."""
    return materialize(group_positions(rows, [tree], [*keys, "leaf"], "rank"), "leaves")


# Store -----------------------------------------------------------------------


def _generations(leaves: Column, alone: Column) -> Column:
    """Levels of digests from the top of a block down to `leaves`; a tree of one block ends where one node remains."""

    def parents(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FANOUT).cast("int"))
        return F.transform(runs, lambda i: digest(F.slice(level, i * FANOUT + 1, F.lit(FANOUT))))

    def climb(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, 1)
        return F.when(alone & (F.size(top) == 1), levels).otherwise(F.concat(F.array(parents(top)), levels))

    start = F.array(leaves).cast("array<array<string>>")
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, climb)


def _store(nodes: DataFrame) -> list[DataFrame]:
    """Records `(tree, block, alone, digest, levels)` over `nodes(tree, rank, digest)`, the lowest generations first.

    A record's `digest` is that of its top; `alone` marks the top of a tree. A pass
    leaves one node of BLOCK, and groups have at most BLOCK nodes whatever the tree.
    """
    stages = []
    while True:
        sizes = nodes.groupBy("tree").agg(F.max("rank").alias("_last"))
        small = sizes.filter(F.col("_last") < BLOCK).select(F.col("tree").alias("_tree"), F.lit(True).alias("_alone"))
        block = F.floor(F.col("rank") / BLOCK).alias("block")
        held = nodes.groupBy("tree", block).agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("held"))
        # Only the first block of a tree can be its only one, so the join has one row per tree on either side.
        one = (F.col("block") == 0) & F.col("tree").eqNullSafe(F.col("_tree"))
        blocks = held.join(small, one, "left").withColumn("alone", F.coalesce("_alone", F.lit(False)))
        blocks = blocks.select("tree", "block", "alone", _generations(F.col("held.digest"), F.col("alone")).alias("levels"))
        records = materialize(blocks.withColumn("digest", F.col("levels")[0][0]), "records")
        stages.append(records)
        nodes = records.filter(~F.col("alone")).select("tree", F.col("block").alias("rank"), "digest")
        if nodes.isEmpty():
            return stages


@dataclass(frozen=True)
class Manifest:
    """The stores of the trees of all sources and of the tree over them, and `subroots(tree, place, digest)`."""

    sources: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None


def _tops(stages: list[DataFrame]) -> DataFrame:
    parts = [s.filter("alone").select("tree", "digest") for s in stages]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build(leaves: DataFrame) -> Manifest:
    """Manifest of `leaves(tree, rank, leaf)`; trees stand in the order of their names, null first."""
    sources = _store(leaves.select("tree", "rank", F.col("leaf").alias("digest")))
    subroots = materialize(global_index(_tops(sources), ["tree"], "place"), "subroots")
    top = _store(subroots.select(F.lit(0).alias("tree"), F.col("place").alias("rank"), "digest"))
    root = _tops(top).first()
    return Manifest(sources, top, subroots, root["digest"] if root else None)


def children(manifest: Manifest) -> DataFrame:
    """The store as plain `(digest, children)`, one row per parent."""
    parts = []
    for stage in [*manifest.sources, *manifest.top]:
        levels = F.sequence(F.lit(1), F.size("levels") - 1)
        pairs = F.transform(levels, lambda k: F.transform(F.col("levels")[k - 1], lambda d, i: F.struct(
            d.alias("digest"), F.slice(F.col("levels")[k], i * FANOUT + 1, F.lit(FANOUT)).alias("children"))))
        parts.append(stage.filter(F.size("levels") > 1).select(F.inline(F.flatten(pairs))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Descent ---------------------------------------------------------------------


def _segment(levels: Column, rank: Column) -> Column:
    """From the top of a record to the node of `rank` at its bottom: the children not taken, left and right of the one taken."""
    powers = F.array(*[F.lit(FANOUT**k) for k in range(STEPS + 1)])

    def step(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        at = F.floor(rank / F.element_at(powers, F.size(levels) - k)).cast("int")
        digit = at % FANOUT
        return F.struct(
            F.array_join(F.slice(level, at - digit + 1, digit), "").alias("left"),
            F.array_join(F.slice(level, at + 2, FANOUT - 1 - digit), "").alias("right"),
        )

    empty = F.array().cast("array<struct<left:string,right:string>>")
    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(1), F.size(levels) - 1), step)).otherwise(empty)


def _same_tree(frame: DataFrame, name: str) -> Column:
    return frame["tree"].eqNullSafe(F.col(name))


def _descend(stages: list[DataFrame], starts: DataFrame, requests: DataFrame) -> DataFrame:
    """`requests(tree, rank, …)` with the `path` from the top of their tree, after that of `starts(tree, digest, path)`.

    Each start enters at the record its digest names; from there a frontier of
    records goes down, one lookup for each record that some request needs.
    """
    entry = starts.withColumns({"block": F.lit(0).cast("bigint")})
    frontier = entry
    for number in range(len(stages) - 1, -1, -1):
        records = stages[number].select(
            F.col("tree").alias("_tree"), F.col("block").alias("_block"), F.col("digest").alias("_digest"), "levels")
        here = (frontier["digest"] == F.col("_digest")) & (frontier["block"] == F.col("_block")) & _same_tree(frontier, "_tree")
        found = frontier.join(records, here).select(*frontier.columns, "levels")
        if number == 0:
            wanted = requests.withColumns({"_of": F.floor(F.col("rank") / BLOCK), "_at": (F.col("rank") % BLOCK).cast("int")})
            found = found.withColumnsRenamed({"tree": "_tree", "digest": "_digest"})
            joined = wanted.join(found, (F.col("_of") == F.col("block")) & _same_tree(wanted, "_tree"))
            joined = joined.filter((F.col("_at") >= 0) & (F.col("_at") < F.size(F.element_at("levels", -1))))
            path = F.concat("path", _segment(F.col("levels"), F.col("_at")))
            extra = [c for c in starts.columns if c not in ("tree", "digest", "path")]
            return joined.select(*requests.columns, *extra, path.alias("path"))
        below = F.transform(F.element_at("levels", -1), lambda d, i: F.struct(
            (F.col("block") * BLOCK + i).alias("_rank"), d.alias("_child"), F.concat("path", _segment(F.col("levels"), i)).alias("_path")))
        rest = [c for c in frontier.columns if c not in ("block", "digest", "path")]
        nodes = found.select(*rest, F.inline(below)).withColumnsRenamed({"_rank": "block", "_child": "digest", "_path": "path"})
        needed = requests.select(F.col("tree").alias("_tree"), F.floor(F.col("rank") / BLOCK**number).alias("_block")).distinct()
        nodes = nodes.join(needed, (F.col("block") == F.col("_block")) & _same_tree(nodes, "_tree"), "left_semi")
        frontier = nodes.select(*frontier.columns).unionByName(entry)
    raise ValueError("a store has at least one stage")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """`requests(tree, rank, …)` with `root`, `subroot` and `path`, the siblings from the root down to the leaf.

    Requests for a leaf that does not exist have no proof and no row.
    """
    asked = requests.select("tree").distinct()
    places = manifest.subroots.withColumnRenamed("tree", "_tree")
    places = places.join(asked, _same_tree(asked, "_tree"), "left_semi")
    sources = places.select(F.lit(0).alias("tree"), F.col("place").alias("rank"), F.col("_tree").alias("source"), F.col("digest").alias("subroot"))
    root = _tops(manifest.top).select(
        "tree", "digest", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    down = _descend(manifest.top, root, sources)
    starts = materialize(down.select(F.col("source").alias("tree"), F.col("subroot").alias("digest"), "root", "subroot", "path"), "starts")
    return _descend(manifest.sources, starts, requests)


def proof_digest(path: Column) -> Column:
    """Digest of the siblings from the leaf's level to the root's, left to right within a level."""
    return digest(F.transform(F.reverse(path), lambda p: F.concat(p["left"], p["right"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that `leaf` gives with the siblings of `path`."""
    return F.aggregate(F.reverse(path), leaf, lambda below, p: digest(F.array(p["left"], below, p["right"])))


# Documents -------------------------------------------------------------------


def manifest_report(docs: DataFrame, altered: Column) -> DataFrame:
    """Every row of `docs` (with FIELDS) as a leaf, its proof, and whether its text still proves it.

    Where `altered` holds, the line ends of the text are deleted before the root is
    recomputed, so a text with a line end must fail and every other must hold.
    """
    def digest_with(text: Column) -> Column:
        return leaf_digest([*[F.col(f) for f in FIELDS[:-1]], text])

    stripped = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    leaves = docs.select(
        "doc_id", F.col("source").alias("tree"), digest_with(F.col("text")).alias("leaf"),
        F.when(F.coalesce(altered, F.lit(False)) & F.col("text").contains("\n"), digest_with(stripped)).alias("presented"),
    )
    leaves = ranked_leaves(materialize(leaves, "hashed"), "tree", ["doc_id"])
    proven = prove(build(leaves), leaves)
    shown = F.coalesce("presented", "leaf")
    report = proven.select(
        "doc_id", "leaf", "subroot", "root", F.struct(proof_digest(F.col("path")).alias("proof"), fold(shown, F.col("path")).alias("folded")).alias("_p"))
    return report.select(
        "doc_id", "leaf", "subroot", "root", F.col("_p.proof").alias("proof_sha256"), F.col("_p.folded").alias("folded_root"),
        (F.col("_p.folded") == F.col("root")).alias("verified"))
