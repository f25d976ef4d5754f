"""Secrets in texts: fixed patterns, and two character Markov models for the rest.

Long runs of key characters are the candidates. Those that a pattern has labelled as
secret train a model of random strings, the others one of ordinary identifiers: the
transitions between characters, counted by Spark over all texts. A candidate is
reported when its log-likelihood ratio says it is random. Only the table of log
ratios, the square of the alphabet, passes through the driver.

A null text is empty. Rows are independent: repeated rows get repeated answers.
Without labelled secrets the random model is uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import let
from corpusflow.llm.spans import as_text, covered, find_spans, tagged
from corpusflow.scratch import materialize

KINDS = ("assign", "access", "hex", "random")
# The patterns.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"

SMOOTHING = 20.0  # transitions for which the frequencies of single characters count
LEAST_RATIO = 12.0  # nats over a whole candidate
LEAST_MEAN = 0.5  # nats for each transition


def base_spans(text: Column) -> Column:
    assign = find_spans(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 6)
    return F.struct(
        tagged(assign, "assign", 0).alias("assign"),
        tagged(find_spans(text, ACCESS), "access", 1).alias("access"),
        tagged(find_spans(text, HEX), "hex", 2).alias("hex"),
    )


def with_candidates(df: DataFrame, key: str) -> DataFrame:
    """`(key, base, candidates)`: base spans in order, and long runs with whether a base span covers part of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = df.select(key, F.struct(base_spans(text).alias("base"), find_spans(text, CANDIDATE).alias("runs")).alias("_f"))
    kinds = F.col("_f.base")
    base = F.sort_array(F.concat(kinds["assign"], kinds["access"], kinds["hex"]))

    def labelled(spans: Column) -> Column:
        return F.transform(covered(F.col("_f.runs"), spans), lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["found"].alias("found"), r["covered"].alias("secret")))

    counts = [F.size(kinds[k]).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(key, *counts, base.alias("base"), let(base, labelled).alias("candidates"))


def transition_ratios(candidates: DataFrame) -> list[float]:
    """log P(next | character) of random strings less that of ordinary ones, row by row of the alphabet."""
    runs = candidates.select(F.explode("candidates").alias("c")).select("c.found", "c.secret")
    pairs = runs.select("secret", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("found") - 1), lambda i: F.substring("found", i, F.lit(2)))).alias("pair"))
    counted = pairs.groupBy("secret", "pair").count().collect()  # twice the square of the alphabet at most
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    seen = {label: [[0.0] * size for _ in range(size)] for label in (True, False)}
    for row in counted:
        a, b = row["pair"]
        seen[row["secret"]][place[a]][place[b]] += row["count"]
    chance = {label: _chances(counts) for label, counts in seen.items()}
    return [math.log(chance[True][a][b] / chance[False][a][b]) for a in range(size) for b in range(size)]


def _chances(counts: list[list[float]]) -> list[list[float]]:
    """P(next | character), drawn towards how frequent the next character is at all, and this towards uniform."""
    size = len(counts)
    total = sum(map(sum, counts))
    alone = [(sum(row[b] for row in counts) + 0.5) / (total + 0.5 * size) for b in range(size)]
    return [[(row[b] + SMOOTHING * alone[b]) / (sum(row) + SMOOTHING) for b in range(size)] for row in counts]


def log_ratio(run: Column, ratios: list[float]) -> Column:
    table = F.array(*[F.lit(float(x)) for x in ratios])
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(run, i, F.lit(1))) - 1
    return let(table, lambda t: F.aggregate(
        F.sequence(F.lit(1), F.length(run) - 1), F.lit(0.0),
        lambda total, i: total + F.get(t, place(i) * len(ALPHABET) + place(i + 1))))


def scan_secrets(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, n_assign, n_access, n_hex, base, all)` for every row of `df(key, text)`; `base` and `all` are ordered spans."""
    found = materialize(with_candidates(df, key), "candidates")
    ratios = transition_ratios(found)
    others = F.filter("candidates", lambda c: ~c["secret"])
    judged = F.filter(others, lambda c: let(log_ratio(c["found"], ratios), lambda x: (
        (x >= LEAST_RATIO) & (x >= LEAST_MEAN * (F.length(c["found"]) - 1)))))
    every = F.sort_array(F.concat("base", tagged(judged, KINDS[3], 3)))
    return found.select(key, "n_assign", "n_access", "n_hex", "base", F.when(F.size(others) == 0, F.col("base")).otherwise(every).alias("all"))


def digest_of(spans: Column) -> Column:
    return F.sha2(F.encode(as_text(spans), "UTF-8"), 256)
