"""Length alone rejects no text."""

from pyspark.sql import functions as F

from corpusflow.llm import quality


def test_a_clean_text_of_more_than_a_million_words_is_kept(spark):
    words = F.struct(*[F.lit(n).cast("bigint").alias(c) for c, n in (
        ("n_words", 1_500_000), ("word_chars", 7_500_000), ("n_repeat_words", 0), ("n_stop_words", 300_000))])
    lines = F.struct(F.lit(100_000).cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_dup_lines"))
    found = F.struct(words.alias("words"), lines.alias("lines"), F.lit(0).cast("bigint").alias("n_symbols"))
    told = spark.range(1).select(found.alias("found"))
    out = quality.verdict(F.col("found"))
    row = told.select(out["kept"].alias("kept"), out["failed_rules"].alias("failed")).first()
    assert row.kept and row.failed == []


def test_long_runs_of_blanks_take_linear_time(spark):
    # A pass that was quadratic in the run would take hours here.
    texts = ["a" + " " * 1_000_000 + "b", " \t\n\x0b\f\r" * 100_000, "\r\n x\x0by\u00a0z \t", "", "\u2003a "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", quality.words_of(F.col("text")).alias("words")).orderBy("i").collect()
    assert [r["words"] for r in rows] == [["a", "b"], [], ["x", "y\u00a0z"], [], ["\u2003a"]]
