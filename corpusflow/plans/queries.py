"""Registered queries: every operator over the whole given tables.

Arrays are rendered as space-separated text and floats are rounded, so that the
results compare by value with the SQL in `corpusflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.functions.sequences import (
    add_special_tokens,
    attention_mask,
    pad_ids,
    token_type_ids,
    truncate_ids,
)
from corpusflow.functions.logits import IGNORE_INDEX, valid_label
from corpusflow.functions.permutation import permuted
from corpusflow.operators import bpe, encode, evaluation, examples, runs, samples, segments, vocabulary, windows
from corpusflow.operators.ordering import global_index
from corpusflow.plans.corpus import create_dataset_splits, make_training_batches
from corpusflow.scratch import load_table, materialize, scratch_path
from corpusflow.sources import readers, run_catalog, tokenizer_files, writers
from corpusflow.streaming import catalog as stream_catalog
from corpusflow.streaming import runs as stream_runs

Query = Callable[[SparkSession, str], DataFrame]

LENGTH = 128  # tokens in a training window
BATCH = 16
MAX_LENGTH = 64  # tokens that `truncate` keeps
DOC = ["doc_id"]
CONV = ["conv_id", "turn"]
UPDATE = ["ts", "event_id"]
SMALL_VOCAB = 300

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Tables -----------------------------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, f"{sf}/documents.parquet").select("doc_id", "text")


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return samples.clean(documents(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as logits. A label of 9 is ignored, so that both kinds of rows occur."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    label = F.when(F.col("label") == 9, IGNORE_INDEX).otherwise(F.col("label"))
    return table.select(
        F.col("vec_id"),
        F.col("embedding").alias("logits"),
        label.cast("int").alias("label"),
        F.floor(F.col("vec_id") / BATCH).alias("batch_id"),
        F.floor(F.col("vec_id") / 10).alias("prompt_id"),
    )


def metric_log(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/events.parquet")
    return table.select(F.col("event_type").alias("name"), "ts", "event_id", "value")


def loss_log(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/events.parquet")
    return table.select(F.col("user_id").alias("run_id"), "ts", F.col("event_id").alias("step"), "value")


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("run-"), F.col("run_id"), F.lit("/checkpoint-"), F.col("step"), F.lit(".pt"))
    return loss_log(spark, sf).select("run_id", "step", path.alias("path"), F.col("value").alias("val_loss"))


def throughput_steps(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/lineitem.parquet")
    return table.select(
        F.col("l_returnflag").alias("run_id"),
        F.col("l_quantity").cast("bigint").alias("tokens"),
        (F.col("l_tax") + 0.01).alias("seconds"),
        F.col("l_extendedprice").alias("mem_mb"),
    )


def generated(spark: SparkSession, sf: str) -> DataFrame:
    said = conversations(spark, sf).filter(F.col("role") == "assistant")
    return evaluation.generation_diversity(said, F.filter(F.split("text", r"\s+"), lambda t: t != ""))


def byte_encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Documents encoded with the alphabet alone, through the operator that encodes any vocabulary."""
    return encode.encode_ids(documents(spark, sf), bpe.Tokenizer.base())


def byte_stream(spark: SparkSession, sf: str, packed: bool = True) -> DataFrame:
    return windows.encoded_stream(documents(spark, sf), DOC, bpe.Tokenizer.base(), packed)


def document_batches(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("batch_id", F.floor(F.col("doc_id") / BATCH))


_TRAINED: dict[tuple[str, str], bpe.Tokenizer] = {}


def small_tokenizer(spark: SparkSession, sf: str) -> bpe.Tokenizer:
    """Trained once per application and data set, as one would load a saved tokenizer."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = bpe.train_bpe(documents(spark, sf), SMALL_VOCAB)
    return _TRAINED[key]


def text_of(ids: Column | str) -> Column:
    """Ids as text."""
    column = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(column.cast("array<string>"), " ")


def rounded(value: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


# Sources and sinks ------------------------------------------------------------


@query
def load_corpus(spark, sf):
    corpus = readers.load_corpus(spark, {"train": f"{sf}/documents.parquet", "validation": f"{sf}/conversations.parquet"})
    return corpus.select("split", "text")


@query
def jsonl_round_trip(spark, sf):
    path = scratch_path(spark, "jsonl")
    writers.write_splits_jsonl(documents(spark, sf).withColumn("split", F.lit("train")), path)
    return readers.read_jsonl_samples(spark, f"{path}/split=train")


@query
def jsonl_lenient_round_trip(spark, sf):
    path = scratch_path(spark, "jsonl")
    documents(spark, sf).write.json(path)
    return readers.read_jsonl_lenient(spark, path)


@query
def jsonl_lenient_without_text(spark, sf):
    """What an assistant said is a text; other lines have a prompt instead."""
    path = scratch_path(spark, "jsonl")
    said = F.col("role") == "assistant"
    rows = conversations(spark, sf)
    rows.select(F.when(said, F.col("text")).alias("text"), F.when(~said, F.col("text")).alias("prompt")).write.json(path)
    return readers.read_jsonl_lenient(spark, path)


@query
def read_training_files(spark, sf):
    """Text files below a folder, found by their name."""
    path = scratch_path(spark, "training")
    writers.write_splits_text(cleaned(spark, sf).withColumn("split", F.lit("train")), f"{path}/text")
    return readers.read_training_files(spark, path)


@query
def resolve_text_column(spark, sf):
    """Lines of four kinds: with a text, a story, both, or neither."""
    path = scratch_path(spark, "mixed")
    kinds = (("source", "text"), ("lang", "story"), ("story", "source", "text"), ("body", "source"))
    table = load_table(spark, f"{sf}/documents.parquet").select("doc_id", "source", "lang", "text")
    named = {"story": "text", "body": "text"}
    both = F.when(F.col("doc_id") % 4 == 2, F.concat(F.lit("not "), F.col("lang"))).otherwise(F.col("text"))
    columns = [
        F.struct(*[(both if n == "story" else F.col(named.get(n, n))).alias(n) for n in kind]) for kind in kinds
    ]
    line = F.coalesce(*[F.when(F.col("doc_id") % 4 == k, F.to_json(c, {"ignoreNullFields": "false"})) for k, c in enumerate(columns)])
    table.select(line.alias("value")).write.text(path)
    return readers.read_mixed_jsonl(spark, path)


@query
def paragraph_text_round_trip(spark, sf):
    path = scratch_path(spark, "paragraphs")
    writers.write_splits_text(cleaned(spark, sf).withColumn("split", F.lit("train")), path)
    return readers.read_paragraph_text(spark, f"{path}/split=train")


@query
def read_prompts(spark, sf):
    path = scratch_path(spark, "prompts")
    samples.clean(conversations(spark, sf)).select("text").write.text(path)
    return readers.read_prompts(spark, path)


@query
def small_bundle(spark, sf):
    path = scratch_path(spark, "bundle")
    split = create_dataset_splits(documents(spark, sf), DOC, max_samples=None, shortest=1, longest=100_000_000)
    writers.write_small_bundle(split, path)
    return spark.read.schema("text string, split string").json(f"{path}/small/jsonl").select("split", "text")


@query
def tokenizer_corpus(spark, sf):
    parts = [(cleaned(spark, sf), DOC), (samples.clean(conversations(spark, sf)), CONV)]
    path = scratch_path(spark, "tokenizer-corpus")
    writers.write_tokenizer_corpus(samples.tokenizer_corpus(parts), path)
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "text")


@query
def tokenizer_tables_round_trip(spark, sf):
    path = scratch_path(spark, "tokenizer")
    tokenizer_files.save_tokenizer_tables(spark, small_tokenizer(spark, sf), path)
    return vocabulary.merges_table(spark, tokenizer_files.load_tokenizer_tables(spark, path))


@query
def run_catalog_round_trip(spark, sf):
    path = scratch_path(spark, "catalog")
    writers.write_run_catalog(checkpoints(spark, sf), path)
    read = run_catalog.read_run_catalog(spark, path)
    listed = F.array_join("checkpoints", " ").alias("checkpoints")
    return read.select("run_id", listed, "best_checkpoint", "best_metric", "last_checkpoint")


@query
def eval_results_round_trip(spark, sf):
    path = scratch_path(spark, "evaluation")
    writers.write_eval_results({"perplexity": evaluation.prompt_perplexity(scored(spark, sf))}, path)
    read = spark.read.schema("prompt_id bigint, perplexity double").json(f"{path}/perplexity")
    return read.select("prompt_id", rounded("perplexity", 4).alias("perplexity"))


# Projections and filters ------------------------------------------------------


@query
def clean_text(spark, sf):
    return cleaned(spark, sf)


@query
def filter_length(spark, sf):
    return samples.filter_length(cleaned(spark, sf))


@query
def scan_cap(spark, sf):
    return samples.head_rows(documents(spark, sf), DOC, 500)


@query
def extract_samples(spark, sf):
    return samples.extract_samples(documents(spark, sf), DOC, 800)


@query
def non_empty(spark, sf):
    return samples.non_empty(cleaned(spark, sf))


@query
def is_special(spark, sf):
    tokens = byte_encoded(spark, sf).select("doc_id", F.explode(add_special_tokens(F.col("ids"))).alias("id"))
    return vocabulary.flag_special(tokens).groupBy("doc_id", "special").agg(F.count("*").alias("n"))


@query
def valid_labels(spark, sf):
    return scored(spark, sf).filter(valid_label(F.col("label"))).select("vec_id", "label")


@query
def cadence_filter(spark, sf):
    return runs.cadence_filter(checkpoints(spark, sf), 100).select("run_id", "step")


# Lookups ----------------------------------------------------------------------


def base_vocab(spark: SparkSession) -> DataFrame:
    return vocabulary.vocab_table(spark, bpe.Tokenizer.base())


@query
def token_to_id(spark, sf):
    """Every character of the texts looked up; those outside the byte alphabet have no id."""
    chars = cleaned(spark, sf).select(F.explode(F.split("text", "")).alias("token")).filter("token <> ''")
    counts = chars.groupBy("token").agg(F.count("*").alias("n"))
    found = vocabulary.token_to_id(counts, base_vocab(spark))
    return found.select("token", "n", F.coalesce("id", F.lit(-1)).alias("id"))


@query
def id_to_token(spark, sf):
    ids = byte_encoded(spark, sf).select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return vocabulary.id_to_token(ids, base_vocab(spark)).select("id", "token", "n")


@query
def encode_words(spark, sf):
    words = bpe.pretoken_counts(cleaned(spark, sf), by_line=False)
    return encode.encode_words(words, bpe.Tokenizer.base()).select("word", "cnt", text_of("ids").alias("ids"))


@query
def special_token_filter(spark, sf):
    tokens = byte_encoded(spark, sf).select("doc_id", F.explode(add_special_tokens(F.col("ids"))).alias("id"))
    return vocabulary.drop_special(tokens).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


@query
def vocab_lookup(spark, sf):
    return vocabulary.vocab_table(spark, small_tokenizer(spark, sf))


# Aggregations -----------------------------------------------------------------


@query
def pretoken_counts(spark, sf):
    return bpe.pretoken_counts(cleaned(spark, sf), by_line=False)


@query
def pair_counts(spark, sf):
    return bpe.pair_counts(bpe.pretoken_counts(cleaned(spark, sf), by_line=False))


@query
def most_frequent_pair(spark, sf):
    return bpe.most_frequent_pairs(bpe.pair_counts(bpe.pretoken_counts(cleaned(spark, sf), by_line=False)), 10)


@query
def train_bpe(spark, sf):
    return vocabulary.merges_table(spark, bpe.train_bpe(documents(spark, sf), SMALL_VOCAB))


@query
def train_bpe_ids(spark, sf):
    """The trained merges as ids, which SQL can train as well."""
    merges = bpe.train_bpe(documents(spark, sf), SMALL_VOCAB).merges
    rows = [(rank, *merge) for rank, merge in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left_id int, right_id int, merged_id int")


@query
def vocab_size(spark, sf):
    return vocabulary.vocab_size(vocabulary.vocab_table(spark, small_tokenizer(spark, sf)))


@query
def split_counts(spark, sf):
    return samples.split_counts(create_dataset_splits(documents(spark, sf), DOC))


@query
def batch_max_length(spark, sf):
    encoded = byte_encoded(spark, sf).withColumn("batch_id", F.floor(F.col("doc_id") / BATCH))
    return encode.with_batch_length(encoded).select("doc_id", "batch_id", "batch_length")


@query
def metric_average(spark, sf):
    return runs.metric_average(metric_log(spark, sf), "purchase").select(rounded("average").alias("average"))


@query
def metric_averages(spark, sf):
    return runs.metric_averages(metric_log(spark, sf)).select("name", rounded("average").alias("average"))


@query
def metric_latest(spark, sf):
    return runs.metric_latest(metric_log(spark, sf), UPDATE, "error")


@query
def metric_current(spark, sf):
    return runs.metric_current(metric_log(spark, sf), UPDATE)


@query
def metric_current_wide(spark, sf):
    return runs.metric_current_wide(metric_log(spark, sf), UPDATE, ["click", "error", "purchase", "signup", "view"])


@query
def accuracy(spark, sf):
    return evaluation.accuracy(scored(spark, sf)).select(rounded("accuracy").alias("accuracy"))


@query
def top5_accuracy(spark, sf):
    metrics = evaluation.token_level_metrics(scored(spark, sf))
    return metrics.select(*[rounded(c).alias(c) for c in ("accuracy", "top5_accuracy")])


@query
def cross_entropy(spark, sf):
    return evaluation.cross_entropy(scored(spark, sf)).select(rounded("loss").alias("loss"))


@query
def validation_loss(spark, sf):
    return evaluation.validation_loss(scored(spark, sf)).select(
        rounded("loss").alias("loss"), rounded("perplexity", 4).alias("perplexity")
    )


@query
def validation_loss_token_weighted(spark, sf):
    return evaluation.validation_loss(scored(spark, sf), token_weighted=True).select(
        rounded("loss").alias("loss"), rounded("perplexity", 4).alias("perplexity")
    )


@query
def epoch_loss(spark, sf):
    epochs = loss_log(spark, sf).select(F.col("run_id").alias("epoch"), F.col("value").alias("loss"))
    return runs.epoch_loss(epochs).select("epoch", rounded("epoch_loss").alias("epoch_loss"))


@query
def perplexity(spark, sf):
    batches = evaluation.with_loss(scored(spark, sf)).groupBy("batch_id").agg(F.avg("nll").alias("loss"))
    return evaluation.perplexity(batches).select(
        "batch_id", rounded("loss").alias("loss"), rounded("perplexity", 4).alias("perplexity")
    )


@query
def throughput_summary(spark, sf):
    return runs.throughput_summary(throughput_steps(spark, sf)).select(
        "run_id", "total_tokens", rounded("total_time", 4).alias("total_time"),
        rounded("tokens_per_sec", 4).alias("tokens_per_sec"), "max_memory_mb",
    )


@query
def step_throughput(spark, sf):
    steps = runs.step_throughput(throughput_steps(spark, sf))
    return steps.select("run_id", "tokens", rounded("tokens_per_sec", 4).alias("tokens_per_sec"))


@query
def epoch_estimate(spark, sf):
    summary = runs.throughput_summary(throughput_steps(spark, sf))
    batches = windows.window_count(byte_stream(spark, sf), LENGTH, LENGTH) // BATCH
    estimated = runs.epoch_estimate(summary, BATCH, LENGTH, batches)
    return estimated.select("run_id", "tokens_per_epoch", rounded("seconds_per_epoch", 4).alias("seconds_per_epoch"))


@query
def loader_length(spark, sf):
    rows = documents(spark, sf)
    full = windows.loader_length(rows, BATCH, drop_last=True).withColumn("loader", F.lit("train"))
    return full.unionByName(windows.loader_length(rows, BATCH, drop_last=False).withColumn("loader", F.lit("validation")))


@query
def roundtrip_audit(spark, sf):
    return encode.roundtrip_audit(documents(spark, sf), small_tokenizer(spark, sf))


@query
def roundtrip_audit_truncated(spark, sf):
    """Texts of more than `MAX_LENGTH` bytes do not come back from their first ids."""
    return encode.roundtrip_audit(documents(spark, sf), bpe.Tokenizer.base(), MAX_LENGTH)


@query
def generation_diversity(spark, sf):
    return generated(spark, sf).select("conv_id", "turn", "n_tokens", "n_chars", rounded("diversity").alias("diversity"))


@query
def distribution_histogram(spark, sf):
    samples_said = generated(spark, sf)
    parts = []
    for column, width in (("diversity", 0.05), ("n_chars", 50.0)):
        parts.append(evaluation.histogram(samples_said, column, width).withColumn("measure", F.lit(column)))
    ppl = evaluation.prompt_perplexity(scored(spark, sf))
    parts.append(evaluation.histogram(ppl, "perplexity", 5.0).withColumn("measure", F.lit("perplexity")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def length_vs_diversity(spark, sf):
    return evaluation.diversity_by_length(generated(spark, sf), 10).select(
        "bucket", rounded("mean_diversity").alias("mean_diversity"), "n"
    )


@query
def length_diversity_correlation(spark, sf):
    return evaluation.length_correlation(generated(spark, sf)).select(rounded("correlation").alias("correlation"))


@query
def prompt_perplexity(spark, sf):
    return evaluation.prompt_perplexity(scored(spark, sf)).select("prompt_id", rounded("perplexity", 4).alias("perplexity"))


@query
def retention_rate(spark, sf):
    return samples.retention(documents(spark, sf)).select("scanned", "kept", rounded("rate").alias("rate"))


# Windows and ordered sequences ------------------------------------------------


@query
def tail_split(spark, sf):
    return create_dataset_splits(documents(spark, sf), DOC)


@query
def tail_split_with_validation(spark, sf):
    return create_dataset_splits(documents(spark, sf), DOC, conversations(spark, sf), CONV)


@query
def global_index_by_key(spark, sf):
    return global_index(conversations(spark, sf).select(*CONV), CONV)


@query
def sliding_windows(spark, sf):
    """Stride `LENGTH`: each token once as an input."""
    cut = windows.sliding_windows(byte_stream(spark, sf), LENGTH, LENGTH)
    return cut.select("window_start", text_of("input_ids").alias("input_ids"), text_of("labels").alias("labels"))


@query
def sliding_windows_every_token(spark, sf):
    """Stride 1, the default: one window per token, described by its ends and sums."""
    length = 16
    # One array a window, its inputs and the last label, in place of two.
    cut = windows.sliding_windows(byte_stream(spark, sf), length, joined=True)
    total = sum((F.element_at("tokens", i + 1) for i in range(1, length)), F.element_at("tokens", 1))
    return cut.select(
        "window_start", total.cast("bigint").alias("input_sum"),
        F.element_at("tokens", 1).alias("first_input"), F.element_at("tokens", -1).alias("last_label"),
    )


@query
def sliding_windows_stride_1(spark, sf):
    """Stride 1 at the training length: digests of the arrays of 4,096 windows each."""
    part = 4096
    cut = windows.sliding_windows(byte_stream(spark, sf), LENGTH, block=part, digests=True)
    return cut.select(
        F.floor(F.col("block_start") / part).alias("part"), "windows",
        *[F.md5(F.col(c).cast("binary")).alias(name) for c, name in (("input_ids", "inputs_md5"), ("labels", "labels_md5"))],
    )


@query
def next_token_labels(spark, sf):
    inputs = byte_encoded(spark, sf).select("doc_id", add_special_tokens(F.col("ids")).alias("input_ids"))
    return examples.with_causal_labels(inputs).select("doc_id", text_of("labels").alias("labels"))


@query
def moving_average(spark, sf):
    return runs.moving_average(metric_log(spark, sf), UPDATE).select("name", rounded("moving_average").alias("moving_average"))


@query
def moving_average_series(spark, sf):
    series = runs.moving_average_series(metric_log(spark, sf), UPDATE)
    return series.select("name", "event_id", rounded("moving_average", 9).alias("moving_average"))


@query
def best_so_far(spark, sf):
    return runs.best_so_far(loss_log(spark, sf), "run_id", ["ts", "step"], "value").select(
        "run_id", "step", "value", "best_before", "is_best"
    )


@query
def early_stopping(spark, sf):
    stops = runs.early_stopping(loss_log(spark, sf), "run_id", ["ts", "step"], "value")
    return stops.select("run_id", "step", "counter", "early_stop")


@query
def early_stopping_with_delta(spark, sf):
    stops = runs.early_stopping_summary(loss_log(spark, sf), "run_id", "step", "value", patience=5, min_delta=0.25)
    return stops.withColumn("stop_step", F.coalesce("stop_step", F.lit(-1).cast("bigint")))


@query
def early_stopping_long_runs(spark, sf):
    """Five runs hold all rows, and their losses fall with noise, so that many of them become the best."""
    log = metric_log(spark, sf).withColumn("loss", F.col("value") - F.col("event_id") * 0.01)
    stops = runs.early_stopping(log, "name", UPDATE, "loss", patience=20, min_delta=0.5)
    return stops.select("name", "event_id", "counter", "early_stop")


@query
def checkpoint_retention(spark, sf):
    return runs.checkpoint_retention(checkpoints(spark, sf)).select("run_id", "step", "path")


@query
def assign_batches(spark, sf):
    batched = windows.assign_batches(documents(spark, sf).select("doc_id"), DOC, BATCH, drop_last=True)
    return batched.select("doc_id", "batch_id", "slot")


@query
def assign_batches_keep_last(spark, sf):
    batched = windows.assign_batches(documents(spark, sf).select("doc_id"), DOC, BATCH, drop_last=False)
    return batched.select("doc_id", "batch_id", "slot")


@query
def nucleus_filter(spark, sf):
    kept = evaluation.with_nucleus(scored(spark, sf), top_p=0.8, temperature=0.5, top_k=40)
    return kept.select("vec_id", F.inline("candidates")).select("vec_id", "idx", rounded("p").alias("p"))


@query
def document_token_offsets(spark, sf):
    encoded = byte_encoded(spark, sf).select("doc_id", add_special_tokens(F.col("ids")).alias("ids"))
    # Ordering reads its input twice, so the ids are written first.
    return windows.document_token_offsets(materialize(encoded, "encoded"), DOC).select("doc_id", "n_tokens", "start_pos")


# Sorts, limits, top-k ---------------------------------------------------------


@query
def appended_positions(spark, sf):
    """Documents that arrive in three parts, the last one twice, with their place in the stream of tokens."""
    path = scratch_path(spark, "corpus")
    # Every append reads its rows twice, so the sizes are written first.
    sized = materialize(byte_encoded(spark, sf).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens")), "sized")
    arrival = F.floor(F.col("doc_id") / 64) % 3
    for number in (0, 1, 2, 2):
        segments.append_rows(sized.filter(arrival == number), path, DOC, "n_tokens", number)
    return segments.read_rows(spark, path, start="start_pos")


@query
def head_per_split(spark, sf):
    split = create_dataset_splits(documents(spark, sf), DOC, conversations(spark, sf), CONV)
    return samples.head_per_split(split, ["sample_no"], {"train": 50, "validation": 40, "test": 40}).select(
        "split", "sample_no", "text"
    )


@query
def shuffle_examples(spark, sf):
    keyed = windows.shuffle_examples(documents(spark, sf).select("doc_id"), "doc_id", seed=7, epoch=1)
    return global_index(keyed, ["shuffle_key", "doc_id"], "place").select("doc_id", "place")


@query
def top_k_filter(spark, sf):
    kept = evaluation.with_top_k(scored(spark, sf), 10)
    exploded = kept.select("vec_id", F.posexplode("logits").alias("idx", "logit"))
    return exploded.filter(F.col("logit").isNotNull()).select("vec_id", "idx")


@query
def top_n_indices(spark, sf):
    return evaluation.with_top_indices(scored(spark, sf)).select("vec_id", text_of("top_indices").alias("top_indices"))


@query
def argmax(spark, sf):
    return evaluation.with_predictions(scored(spark, sf)).select("vec_id", "predicted")


@query
def resolve_checkpoint_best(spark, sf):
    return runs.resolve_checkpoint(checkpoints(spark, sf), load_best=True)


@query
def resolve_checkpoint_latest(spark, sf):
    return runs.resolve_checkpoint(checkpoints(spark, sf), load_latest=True)


# Set operations ---------------------------------------------------------------


@query
def union_files(spark, sf):
    extra = spark.read.parquet(f"{sf}/benchmark.parquet")
    return samples.union_files([(documents(spark, sf), DOC), (extra, ["item_id"])])


@query
def concat_token_streams(spark, sf):
    return windows.token_stream(byte_stream(spark, sf, packed=False), DOC)


@query
def split_complement(spark, sf):
    return samples.split_complement(documents(spark, sf).select("doc_id"), DOC, 50)


# Encoding and training examples -----------------------------------------------


def _rendered(encoded: DataFrame, *keys: str) -> DataFrame:
    kinds = dict(encoded.dtypes)
    columns = [c for c in encoded.columns if c not in (*keys, "batch_id")]
    return encoded.select(*keys, *[(F.col(c) if kinds[c] == "string" else text_of(c)).alias(c) for c in columns])


@query
def encode_corpus(spark, sf):
    return _rendered(encode.encode_corpus(documents(spark, sf), bpe.Tokenizer.base()), "doc_id")


@query
def encode_corpus_merged(spark, sf):
    """With trained merges; the decoded text is compared in `decode_corpus`."""
    encoded = encode.encode_corpus(documents(spark, sf), small_tokenizer(spark, sf))
    return encoded.select("doc_id", text_of("input_ids").alias("input_ids"))


@query
def encode_with_own_tokenizer(spark, sf):
    """A caller's batch function: the lengths of what stands between blanks."""
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [len(word) for word in text.split(" ")])

    encoded = encode.encode_with(documents(spark, sf), lengths)
    return encoded.select("doc_id", text_of("ids").alias("ids"))


@query
def encode_batches(spark, sf):
    encoded = encode.encode_batches(document_batches(spark, sf), bpe.Tokenizer.base(), padding=True, text=True)
    return _rendered(encoded, "doc_id")


def _with_special(spark: SparkSession, sf: str) -> DataFrame:
    encoded = encode.encode_ids(cleaned(spark, sf), bpe.Tokenizer.base())
    return encoded.withColumn("ids", add_special_tokens(F.col("ids")))


@query
def add_special(spark, sf):
    return _with_special(spark, sf).select("doc_id", text_of("ids").alias("ids"))


@query
def truncate(spark, sf):
    return _with_special(spark, sf).select("doc_id", text_of(truncate_ids(F.col("ids"), MAX_LENGTH)).alias("ids"))


@query
def pad(spark, sf):
    return _with_special(spark, sf).select("doc_id", text_of(pad_ids(F.col("ids"), 1000)).alias("ids"))


@query
def masks(spark, sf):
    encoded = byte_encoded(spark, sf)
    return encoded.select(
        "doc_id", text_of(attention_mask(F.col("ids"))).alias("attention_mask"),
        text_of(token_type_ids(F.col("ids"))).alias("token_type_ids"),
    )


@query
def decode_corpus(spark, sf):
    """Texts encoded with trained merges and decoded again."""
    tokenizer = small_tokenizer(spark, sf)
    return encode.decode_corpus(encode.encode_ids(documents(spark, sf), tokenizer), tokenizer)


@query
def decode_batches(spark, sf):
    """Padded batches decode to the same texts: special tokens are skipped."""
    tokenizer = bpe.Tokenizer.base()
    batches = encode.encode_batches(document_batches(spark, sf), tokenizer, padding=True)
    return encode.decode_corpus(batches.select("doc_id", F.col("input_ids").alias("ids")), tokenizer)


def whole_query(function: Query) -> Query:
    """Registered under its name and, as before, with `_whole`: texts are never cut."""
    QUERIES[f"{function.__name__}_whole"] = function
    return query(function)


@whole_query
def prepare_inputs(spark, sf):
    """Whole texts, each batch padded to its longest row."""
    return _rendered(examples.prepare_inputs(document_batches(spark, sf), bpe.Tokenizer.base(), text=True), "doc_id")


@whole_query
def causal_lm_inputs(spark, sf):
    return _rendered(examples.causal_lm_inputs(document_batches(spark, sf), bpe.Tokenizer.base(), text=True), "doc_id")


def _masked(spark: SparkSession, sf: str, text: bool = False) -> DataFrame:
    return examples.masked_lm_inputs(document_batches(spark, sf), bpe.Tokenizer.base(), F.col("doc_id"), seed=3, text=text)


@whole_query
def masked_lm_inputs(spark, sf):
    return _rendered(_masked(spark, sf, text=True), "doc_id")


@whole_query
def masked_token_count(spark, sf):
    return examples.masked_token_count(_masked(spark, sf))


@whole_query
def example_audit(spark, sf):
    """Every row must have the length of its batch's longest row."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    return examples.example_audit(_masked(spark, sf).withColumn("_longest", longest), F.col("_longest"))


@query
def custom_collation(spark, sf):
    """Batches with the caller's own columns."""
    own = {"attention_mask": attention_mask(F.col("input_ids")), "first_label": F.element_at("labels", 1)}
    batches = make_training_batches(
        documents(spark, sf), DOC, bpe.Tokenizer.base(), LENGTH, BATCH, LENGTH, training=False, collate=own
    )
    return batches.select("window_start", text_of("attention_mask").alias("attention_mask"), "first_label")


@query
def alignment_check(spark, sf):
    return examples.alignment_check(windows.sliding_windows(byte_stream(spark, sf), LENGTH, LENGTH))


@query
def alignment_check_unshifted(spark, sf):
    """Inputs given as their own labels are not aligned."""
    cut = windows.sliding_windows(byte_stream(spark, sf), LENGTH, LENGTH)
    return examples.alignment_check(cut.withColumn("labels", F.col("input_ids")))


@query
def sample_next_token(spark, sf):
    drawn = evaluation.sample_next_token(scored(spark, sf), F.col("vec_id"), 0.7, 40, 0.9, seed=11)
    return drawn.select("vec_id", "next_token")


@query
def training_batches(spark, sf):
    batches = make_training_batches(documents(spark, sf), DOC, bpe.Tokenizer.base(), LENGTH, BATCH, LENGTH, seed=5)
    return batches.select(
        "batch_id", "slot", "window_start", text_of("input_ids").alias("input_ids"), text_of("labels").alias("labels")
    )


@query
def training_batches_permuted(spark, sf):
    """Places from a keyed permutation: no sort of the windows."""
    batches = make_training_batches(documents(spark, sf), DOC, bpe.Tokenizer.base(), LENGTH, BATCH, LENGTH, seed=5, epoch=2, sort=False)
    return batches.select(
        "batch_id", "slot", "window_start", text_of("input_ids").alias("input_ids"), text_of("labels").alias("labels")
    )


@query
def shuffle_permuted(spark, sf):
    """The documents' numbers 0 .. N-1 permuted."""
    rows = global_index(documents(spark, sf).select("doc_id"), DOC)
    return rows.select("doc_id", permuted(F.col("idx"), rows.count(), seed=7, epoch=1).alias("place"))


@query
def validation_batches(spark, sf):
    batches = make_training_batches(
        documents(spark, sf), DOC, bpe.Tokenizer.base(), LENGTH, BATCH, LENGTH, training=False
    )
    return batches.select("batch_id", "slot", "window_start", text_of("input_ids").alias("input_ids"))


# Streams ----------------------------------------------------------------------


def _final_state(spark: SparkSession, streamed: DataFrame, key: str, order: str) -> DataFrame:
    """Run the stream over all available files, and keep the last row of every key."""
    updates, state = scratch_path(spark, "updates"), scratch_path(spark, "state")

    def append(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("append").parquet(updates)

    run = streamed.writeStream.outputMode("update").option("checkpointLocation", state)
    run.trigger(availableNow=True).foreachBatch(append).start().awaitTermination()
    rows = spark.read.parquet(updates)
    columns = [c for c in rows.columns if c not in (key, "_batch")]
    last = F.max_by(F.struct(*columns), F.struct("_batch", order)).alias("_last")
    return rows.groupBy(key).agg(last).select(key, "_last.*")


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query
def stream_metric_tracker(spark, sf):
    updates = _event_stream(spark, sf).select(F.col("event_type").alias("name"), "ts", "event_id", "value")
    final = _final_state(spark, stream_runs.stream_metric_tracker(updates, UPDATE), "name", "updates")
    return final.select("name", rounded("average").alias("average"), "latest", "updates")


@query
def stream_metric_tracker_restarted(spark, sf):
    """Updates that arrive in four parts, out of order, with a restart before each part."""
    arriving, reports, state = (scratch_path(spark, n) for n in ("updates", "reports", "state"))
    log = metric_log(spark, sf)
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for k in range(4):
        log.filter(part == k).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(log.schema).parquet(arriving)
        tracked = stream_runs.stream_metric_tracker(stream, UPDATE)
        run = tracked.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True)
        run.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(reports)).start().awaitTermination()
    last = F.max_by(F.struct("average", "latest", "updates"), "updates").alias("_last")
    final = spark.read.parquet(reports).groupBy("name").agg(last).select("name", "_last.*")
    return final.select("name", rounded("average").alias("average"), "latest", "updates")


def _last_checks(spark: SparkSession, arrivals: list[DataFrame], delay: str, patience: int, min_delta: float) -> DataFrame:
    """Append one arrival after the other and let a query, restarted from its checkpoint each time, take it."""
    losses, reports, state = (scratch_path(spark, n) for n in ("losses", "reports", "state"))
    for arrival in arrivals:
        arrival.write.mode("append").parquet(losses)
        stream = spark.readStream.schema(arrival.schema).parquet(losses).withWatermark("ts", delay)
        stops = stream_runs.stream_early_stopping(stream, "run_id", "step", "value", patience, min_delta, time="ts")
        with stream_runs.rocksdb_state(spark):
            run = stops.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True)
            run.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(reports)).start().awaitTermination()
    rows = spark.read.parquet(reports)
    columns = [c for c in rows.columns if c != "run_id"]
    return rows.groupBy("run_id").agg(F.max_by(F.struct(*columns), "checks").alias("_last")).select("run_id", "_last.*")


def _streamed_catalog(spark: SparkSession, sf: str) -> str:
    """Checkpoints reported in four parts, newer ones not always later, with the last micro-batch played twice."""
    reports, folder = scratch_path(spark, "reports"), scratch_path(spark, "catalog")
    catalog = checkpoints(spark, sf)
    part = F.pmod(F.xxhash64("step"), F.lit(4))
    upsert, played = stream_catalog.upsert_checkpoints(folder), []

    def take(batch: DataFrame, number: int) -> None:
        played.append(number)
        upsert(batch, number)

    state = scratch_path(spark, "state")
    for k in range(4):
        catalog.filter(part == k).write.mode("append").parquet(reports)
        stream = spark.readStream.schema(catalog.schema).parquet(reports)
        run = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        run.foreachBatch(take).start().awaitTermination()
    upsert(catalog.filter(part == 3), played[-1])
    return folder


@query
def stream_run_catalog(spark, sf):
    read = run_catalog.resolve_from_catalog(stream_catalog.read_catalog(spark, _streamed_catalog(spark, sf)), load_best=True)
    listed = F.array_join("checkpoints", " ").alias("checkpoints")
    return read.select("run_id", listed, "best_checkpoint", "best_metric", "last_checkpoint", "path")


@query
def resolve_from_catalog(spark, sf):
    """The metadata files that `write_run_catalog` leaves, by their latest checkpoint."""
    path = scratch_path(spark, "catalog")
    writers.write_run_catalog(checkpoints(spark, sf), path)
    resolved = run_catalog.resolve_from_catalog(run_catalog.read_run_catalog(spark, path), load_latest=True)
    return resolved.select("run_id", "path")


@query
def stream_evicted_checkpoints(spark, sf):
    return stream_catalog.read_evicted(spark, _streamed_catalog(spark, sf))


@query
def stream_early_stopping(spark, sf):
    losses = _event_stream(spark, sf).select(F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), "value")
    with stream_runs.rocksdb_state(spark):
        final = _final_state(spark, stream_runs.stream_early_stopping(losses, "run_id", "step", "value"), "run_id", "checks")
    stop_step = F.coalesce("stop_step", F.lit(-1).cast("bigint")).alias("stop_step")
    return final.select("run_id", "checks", "counter", "best_loss", "stopped", stop_step)


@query
def stream_early_stopping_late(spark, sf):
    """Losses that arrive in four parts, some up to an eighth of the log's time too late, with a restart before each part."""
    log = loss_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds("ts")
    first, last = log.agg(F.min(seconds), F.max(seconds)).first()
    eighth = max((last - first) // 8, 1)
    held_up = F.pmod(F.xxhash64("step"), F.lit(eighth))
    part = F.least(F.floor((seconds - first + held_up) / (2 * eighth)), F.lit(3))
    final = _last_checks(spark, [log.filter(part == k) for k in range(4)], f"{eighth + 1} seconds", 5, 0.25)
    stop_step = F.coalesce("stop_step", F.lit(-1).cast("bigint")).alias("stop_step")
    return final.select("run_id", "checks", "counter", "best_loss", "stopped", stop_step)
