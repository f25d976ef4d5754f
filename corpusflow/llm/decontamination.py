"""Benchmark decontamination: windows of documents that repeat a benchmark item.

A window of an item's length is compared with the item. Two sides of a and b shingles
reach a similarity only with enough of them in common, so windows come from every start
with as many places of shared shingles, in whatever order they stand. Each window and
each item has a 64-bit SimHash over its weighted shingles; fingerprints are cut into
RADIUS + 1 blocks, and two of them within RADIUS agree in one block at least, so the
join on blocks finds every pair within the radius. Sides with fewer than LEAST_HASHED
shingles skip the fingerprints, which are too rough for them. What is left is verified by
exact weighted similarity: shingles with their counts, sum of least over sum of largest.

At similarity 0.8 fingerprints differ by 10 bits on average; more than RADIUS
bits happen with a probability of about 2e-5.

Words are blank-separated and lower-cased. A document shorter than an item is one
window. A null or blank text, of either side, matches nothing. Rows that repeat id and
text are one row; items with equal texts are all reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import let
from corpusflow.llm.quality import words_of
from corpusflow.operators.ordering import shuffle_partitions
from corpusflow.scratch import materialize

SHINGLE = 5
LEAST_SIMILARITY = 0.8
RADIUS = 21
LEAST_HASHED = 10
BITS = 64
BROADCAST_SHINGLES = 500_000  # a shingle takes about 40 bytes
ROW_BUCKETS = 1 << 19  # buckets of rows with enough shared shingles: at most as many are broadcast


def shingle_hashes(words: Column, size: int) -> Column:
    """Hashes of `size` words in a row, none if there are fewer."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) < size, F.array().cast("array<bigint>")).otherwise(hashes)


def simhash_blocks(hashes: Column) -> Column:
    """The fingerprint's blocks as numbers: for each bit, whether most shingles (with repetition) have it."""
    def bit(b: Column) -> Column:
        votes = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.when(F.getbit(h, b) == 1, 1).otherwise(-1))
        return F.when(votes > 0, 1).otherwise(0)

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return let(bits, lambda x: F.transform(
        F.sequence(F.lit(0), F.lit(RADIUS)),
        lambda k: F.aggregate(F.slice(x, _edge(k) + 1, _edge(k + 1) - _edge(k)), F.lit(0), lambda s, v: s * 2 + v)))


def _edge(block: Column) -> Column:
    return F.floor(block * BITS / (RADIUS + 1)).cast("int")


def weighted_similarity(one: Column, two: Column) -> Column:
    """Sum of the least counts over the sum of the largest."""
    count = lambda values, x: F.size(F.filter(values, lambda v: v == x))
    shared = F.aggregate(F.array_distinct(one), F.lit(0), lambda s, x: s + F.least(count(one, x), count(two, x)))
    return let(shared, lambda s: s / (F.size(one) + F.size(two) - s))


def starts_of(length: Column, cut: Column) -> Column:
    """Starts of all windows with enough places of shared shingles, in a text of `length` words."""
    at, theirs = cut["at"], cut["n"] - cut["size"] + 1
    mine = F.least(cut["n"], length) - cut["size"] + 1
    least = F.ceil((mine + theirs) * LEAST_SIMILARITY / (1 + LEAST_SIMILARITY) - 1e-9).cast("int")
    last = F.greatest(length - cut["n"], F.lit(0))

    def span(j: Column) -> Column:  # starts of windows with `least` places from the j-th on, but not from the one before
        before = F.when(j > 0, F.least(F.get(at, j - 1), last) + 1)
        return F.struct(F.greatest(F.get(at, j + least - 1) - mine + 1, F.lit(0), before).alias("low"), F.least(F.get(at, j), last).alias("high"))

    spans = F.filter(F.transform(F.sequence(F.lit(0), F.size(at) - least), span), lambda s: s["low"] <= s["high"])
    listed = F.flatten(F.transform(spans, lambda s: F.sequence(s["low"], s["high"])))
    return F.when(F.size(at) < least, F.array().cast("array<int>")).otherwise(listed)


def _items(benchmark: DataFrame, key: str) -> DataFrame:
    words = benchmark.select(F.col(key).alias("item"), words_of(F.lower(F.coalesce("text", F.lit("")))).alias("w"))
    size = F.least(F.lit(SHINGLE), F.size("w"))
    by_size = F.lit(None).cast("array<bigint>")
    for n in range(1, SHINGLE + 1):
        by_size = F.when(size == n, shingle_hashes(F.col("w"), n)).otherwise(by_size)
    sized = words.filter(F.size("w") > 0).select("item", F.size("w").alias("n"), size.alias("size"), by_size.alias("theirs"))
    return materialize(sized.select("*", simhash_blocks(F.col("theirs")).alias("their_blocks")), "items")


def find_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """`(key, item_key, similarity, start_word, n_words, n_windows, _text)`: the best window of every item a row repeats.

    `_text` is a 64-bit hash of the row's id and text, by which rows can be told apart even when ids are null or repeat.
    """
    items = _items(benchmark, item_key)
    row = F.xxhash64(F.col(key), F.col("text"))
    docs = df.select(F.col(key).alias("doc"), row.alias("_text"), F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    keys = items.select("item", "n", "size", F.explode("theirs").alias("hash")).distinct()
    small = keys.count() <= BROADCAST_SHINGLES
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most SHINGLE values
    if not sizes:
        empty = df.select(F.col(key), F.lit(None).cast(benchmark.schema[item_key].dataType).alias(item_key)).limit(0)
        return empty.select("*", F.lit(0.0).alias("similarity"), F.lit(0).alias("start_word"), F.lit(0).alias("n_words"),
                            F.lit(0).cast("bigint").alias("n_windows"), F.lit(0).cast("bigint").alias("_text"))
    seeds = []
    for size in sizes:
        own = keys.filter(F.col("size") == size)
        said = docs.select("_text", F.posexplode(let(words_of(F.col("t")), lambda w: shingle_hashes(w, size))).alias("pos", "hash"))
        met = said.join(F.broadcast(own) if small else own, "hash")
        seeds.append(met.select("_text", "item", "n", "size", "pos"))
    places = reduce(DataFrame.unionByName, seeds).groupBy("_text", "item", "n", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    # A shorter document has at least LEAST_SIMILARITY of the item's shingles, all of them shared.
    enough = places.filter(F.size("at") >= LEAST_SIMILARITY * (F.col("n") - F.col("size") + 1) - 1e-9)
    wanted = materialize(enough.groupBy("_text").agg(F.collect_list(F.struct("item", "n", "size", "at")).alias("cuts")), "seeds")

    # Most rows share too little with any item. A bounded set of buckets keeps their texts out of the shuffle.
    bucket = F.pmod(F.col("_text"), F.lit(ROW_BUCKETS))
    buckets = wanted.select(bucket.alias("_bucket")).distinct()
    near_rows = docs.join(F.broadcast(buckets), bucket == F.col("_bucket"), "left_semi")
    # Windows multiply the rows after the shuffle, so its partitions are not merged by their size before that.
    met = near_rows.repartition(shuffle_partitions(df), "_text").join(wanted, "_text").select("doc", "_text", words_of(F.col("t")).alias("w"), "cuts")

    def window(words: Column, cut: Column, at: Column) -> Column:
        part = F.slice(words, at + 1, cut["n"])
        mine = F.lit(None).cast("array<bigint>")
        for n in range(1, SHINGLE + 1):
            mine = F.when(cut["size"] == n, shingle_hashes(part, n)).otherwise(mine)
        return F.struct(cut["item"].alias("item"), at.alias("start"), mine.alias("mine"), (cut["n"] - cut["size"] + 1).alias("most"))

    cut_out = F.flatten(F.transform("cuts", lambda c: F.transform(starts_of(F.size("w"), c), lambda at: window(F.col("w"), c, at))))
    windows = met.select("doc", "_text", F.explode(cut_out).alias("x")).select("doc", "_text", "x.*")
    few = F.least(F.size("mine"), F.col("most")) < LEAST_HASHED
    short = windows.filter(few)
    windows = windows.filter(~few).withColumn("blocks", simhash_blocks(F.col("mine")))
    theirs = items.select("item", "n", "theirs", F.posexplode("their_blocks").alias("block", "value"), "their_blocks")
    mine = windows.select("doc", "_text", "item", "start", "mine", "blocks", F.posexplode("blocks").alias("block", "value"))
    # A pair agrees in several blocks; the first of them stands for it.
    first = lambda a, b: F.array_position(F.zip_with(a, b, lambda x, y: x == y), F.lit(True)) - 1
    met = mine.join(F.broadcast(theirs) if small else theirs, ["item", "block", "value"]).filter(F.col("block") == first("blocks", "their_blocks"))
    apart = F.aggregate(F.zip_with("blocks", "their_blocks", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
    columns = ["doc", "_text", "item", "n", "start", "mine", "theirs"]
    own = items.select("item", "n", "theirs")
    unhashed = short.join(F.broadcast(own) if small else own, "item").select(*columns)
    near = met.filter(apart <= RADIUS).select(*columns).unionByName(unhashed).withColumn("similarity", weighted_similarity(F.col("mine"), F.col("theirs")))
    hits = near.filter(F.col("similarity") >= LEAST_SIMILARITY)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    per_item = hits.groupBy("doc", "_text", "item", "n").agg(best, F.count_distinct("start").alias("n_windows"))
    return per_item.select(
        F.col("doc").alias(key), F.col("item").alias(item_key), "best.similarity", (-F.col("best.back")).alias("start_word"),
        F.col("n").alias("n_words"), "n_windows", "_text")


def drop_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """The rows of `df` that repeat no benchmark item, with all their columns."""
    leaks = find_leaks(df, benchmark, key, item_key).select(F.col("_text").alias("_leak")).distinct()
    return df.join(leaks, F.xxhash64(F.col(key), F.col("text")) == F.col("_leak"), "left_anti")
