"""Quality rules: a table of thresholds compiled into one projection.

Every metric is a column expression on the text alone; a rule is a metric with a
least and a largest value. The rules become one projection, without a shuffle and
without user functions.

A null or blank text has no words; ratios over nothing are null and pass, and the
rule on the number of words rejects the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import let

# Frequent function words of the corpus languages, as the tests of the rule need them.
STOP_WORDS = (
    "the of and to in is that it was for on as with be by at this are an from "
    "der die und das den von zu ist mit sich des auf für nicht ein eine dem im es auch "
    "le la les et des en un du une que est pour dans qui par pas au sur avec il "
    "el los las que y del se un con por una para su no al lo como más o"
).split()
BLANK = r"[\x20\x09-\x0D]"
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    least: float | None = None
    largest: float | None = None


RULES = (
    Rule("word_count", "n_words", least=50),
    Rule("mean_word_length", "mean_word_length", least=2, largest=25),
    Rule("symbol_ratio", "symbol_ratio", largest=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.02),
    Rule("duplicate_lines", "duplicate_line_ratio", largest=0.5),
    Rule("repeated_words", "repeated_word_ratio", largest=0.5),
    Rule("lines_per_word", "line_ratio", largest=0.6),
)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))  # a pattern for blanks at the end would begin anew at each blank of a run
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK}+", -1))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more; windows are compared by 64-bit hash."""

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(order: Column) -> Column:
            def repeats(x: Column, k: Column) -> Column:
                return F.coalesce(x["h"] == F.get(order, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(order, k + 1)["h"], F.lit(False))

            starts = F.sort_array(F.transform(F.filter(order, repeats), lambda x: x["i"]))
            return let(starts, lambda s: F.aggregate(
                F.transform(s, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1), at + WINDOW) - at)),
                F.lit(0), lambda total, n: total + n))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, covered))

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) < WINDOW, 0).otherwise(let(hashes, count))


def counts(text: Column) -> Column:
    """The counted part of the metrics as a struct."""
    stop = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: w.isin(stop))).cast("bigint").alias("n_stop_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(rf"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words_of(text), of_words).alias("words"),
        let(lines, of_lines).alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )


def verdict(found: Column, rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """Metrics, the names of the rules that fail, and the verdict, from a column of `counts`."""
    words, lines = found["words"], found["lines"]
    n = words["n_words"]
    metrics = {
        "n_words": n,
        "word_chars": words["word_chars"],
        "n_symbols": found["n_symbols"],
        "n_dup_lines": lines["n_dup_lines"],
        "n_repeat_words": words["n_repeat_words"],
        "n_lines": lines["n_lines"],
        "mean_word_length": F.try_divide(words["word_chars"], n),
        "symbol_ratio": F.try_divide(found["n_symbols"], n),
        "stop_word_ratio": F.try_divide(words["n_stop_words"], n),
        "duplicate_line_ratio": F.try_divide(lines["n_dup_lines"], lines["n_lines"]),
        "repeated_word_ratio": F.try_divide(words["n_repeat_words"], n),
        "line_ratio": F.try_divide(lines["n_lines"], n),
    }
    failing = []
    for rule in rules:
        value, outside = metrics[rule.metric], F.lit(False)
        if rule.least is not None:
            outside = outside | (value < F.lit(rule.least))
        if rule.largest is not None:
            outside = outside | (value > F.lit(rule.largest))
        failing.append(F.when(F.coalesce(outside, F.lit(False)), F.lit(rule.name)))
    failed = F.array_compact(F.array(*failing))
    base = (n < 50) | (100 * words["n_repeat_words"] > 50 * n)
    return {**metrics, "failed_rules": failed, "base_failed": base, "kept": ~base & (F.size(failed) == 0)}


def quality_report(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> DataFrame:
    """A row for each row of `df(key, text)`: metrics, failing rules and verdict."""
    counted = df.select(F.col(key), counts(F.coalesce(F.col("text"), F.lit(""))).alias("_found"))
    return counted.select(key, *[c.alias(n) for n, c in verdict(F.col("_found"), rules).items()])


def keep_good(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `df` that pass, with all their columns."""
    kept = let(counts(F.coalesce(F.col("text"), F.lit(""))), lambda found: verdict(found, rules)["kept"])
    return df.filter(kept)
