import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions.text import clean_text, strip
from corpusflow.operators import ordering, samples


def python_clean(text):
    text = " ".join([line.strip() for line in text.split("\n") if line.strip()])
    return text.replace("  ", " ")


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[1] for r in df.select("i", clean_text(F.col("text"))).orderBy("i").collect()]


def test_clean_text_rows(spark):
    texts = ["", "\n\n", "  a  \n\n b", "a   b    c", " x　\ny\x1c", "\ta\x85\n b"]
    assert cleaned(spark, texts) == [python_clean(t) for t in texts]
    assert cleaned(spark, ["a   b    c"]) == ["a  b  c"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t\r\x0b\x1c\x85  　​夜😀"), max_size=30), min_size=1, max_size=20))
def test_clean_text_like_python(spark, texts):
    assert cleaned(spark, texts) == [python_clean(t) for t in texts]


def test_strip_takes_what_python_takes(spark):
    every = "".join(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(c + "x" + c,) for c in every], "t string")
    ours = {r["t"]: r["s"] for r in df.select("t", strip(F.col("t")).alias("s")).collect()}
    assert all(ours[c + "x" + c] == (c + "x" + c).strip() for c in every)


def test_filter_length_is_inclusive(spark):
    df = spark.createDataFrame([(n, "x" * n) for n in (149, 150, 500, 501)], "n int, text string")
    assert sorted(r["n"] for r in samples.filter_length(df).collect()) == [150, 500]


def test_text_column(spark):
    assert samples.resolve_text_column(spark.createDataFrame([("a", "b")], "story string, text string")) == "text"
    assert samples.resolve_text_column(spark.createDataFrame([("a", "b")], "id string, story string")) == "story"
    assert samples.with_text_column(spark.createDataFrame([("a", 1)], "body string, n int")).columns == ["text", "n"]


def test_cap_counts_scanned_rows(spark):
    df = spark.createDataFrame([(i, "x" * (200 if i % 2 else 10)) for i in range(20)], "id int, text string")
    assert sorted(r["id"] for r in samples.extract_samples(df, ["id"], 5).collect()) == [1, 3]
    assert samples.extract_samples(df, ["id"], None).count() == 10
    assert samples.extract_samples(df, ["id"], 0).count() == 0
    assert samples.validation_cap(55) == 5 and samples.validation_cap(None) is None


def python_split(train, validation):
    """Tails by position, where a tail of size 0 is empty."""
    def tail(rows, size):
        return rows[: len(rows) - size], rows[len(rows) - size:]

    if validation is None:
        train, validation = tail(train, int(len(train) * 0.05))
    if len(validation) > 100:
        validation, test = tail(validation, int(len(validation) * 0.5))
    else:
        train, test = tail(train, int(len(train) * 0.05))
    return {"train": train, "validation": validation, "test": test}


@pytest.mark.parametrize(
    "rows,held", [(0, None), (1, None), (19, None), (20, None), (101, None), (2100, None), (30, 0), (40, 100), (40, 101), (5, 200)]
)
def test_tail_split(spark, rows, held):
    train = [(i, f"t{i}") for i in range(rows)]
    validation = None if held is None else [(i, f"v{i}") for i in range(held)]
    schema = "id int, text string"
    got = samples.tail_split(
        spark.createDataFrame(train, schema).repartition(3), ["id"],
        None if validation is None else spark.createDataFrame(validation, schema),
    )
    found = {name: [] for name in ("train", "validation", "test")}
    for r in got.orderBy("sample_no").collect():
        found[r["split"]].append(r["text"])
    wanted = python_split([t for _, t in train], None if validation is None else [t for _, t in validation])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_head_per_split_and_counts(spark):
    rows = [("train", i, "t") for i in range(10)] + [("test", i, "t") for i in range(3)] + [("other", 1, "t")]
    df = spark.createDataFrame(rows, "split string, n int, text string").repartition(4)
    head = samples.head_per_split(df, ["n"], {"train": 4, "test": 5, "validation": 2})
    assert sorted((r["split"], r["n"]) for r in head.collect()) == [("test", i) for i in range(3)] + [("train", i) for i in range(4)]
    assert {r["split"]: r["samples"] for r in samples.split_counts(df).collect()} == {"train": 10, "test": 3, "other": 1}


def test_union_and_corpus_cap(spark):
    a = spark.createDataFrame([(2, "c"), (1, ""), (0, "a")], "id int, text string")
    b = spark.createDataFrame([("y", "d"), ("x", None)], "k string, story string")
    parts = [(a, ["id"]), (b, ["k"])]
    rows = [(r["file_no"], r["line_no"], r["text"]) for r in samples.union_files(parts).orderBy("file_no", "line_no").collect()]
    assert rows == [(0, 0, "a"), (0, 1, ""), (0, 2, "c"), (1, 0, None), (1, 1, "d")]
    assert sorted(r["text"] for r in samples.tokenizer_corpus(parts, 2).collect()) == ["a", "c"]
    assert samples.tokenizer_corpus(parts).count() == 3


def test_complement_and_retention(spark):
    df = spark.createDataFrame([(i, "x" * (100 * i)) for i in range(6)], "id int, text string")
    assert sorted(r["id"] for r in samples.split_complement(df, ["id"], 2).collect()) == [0, 1, 2, 3]
    assert samples.split_complement(df, ["id"], 9).count() == 0
    row = samples.retention(df).first()
    assert (row["scanned"], row["kept"], row["rate"]) == (6, 4, 4 / 6)
    assert samples.retention(df.limit(0)).first()["rate"] is None


def test_global_index_splits_a_hot_key(spark):
    # One value of the first key holds most rows; the second key still spreads them.
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, 7).otherwise(F.col("id") % 5).alias("k"), (F.col("id") * 7919 % 5003).alias("j"), "id")
    layout = ordering.ordered_layout(df, ["k", "j", "id"]).collect()
    ordered = sorted(layout, key=lambda r: r["position"])
    keys = [(r["k"], r["j"], r["id"]) for r in ordered]
    assert keys == sorted(keys) and [r["position"] for r in ordered] == list(range(5000))


def test_scan_carries_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(600).select((F.col("id") % 3 % 2).alias("g"), "id", (F.col("id") * 37 % 101).alias("v"))
        layout = ordering.ordered_layout(df, ["g", "id"])
        assert layout.select(ordering.PART).distinct().count() > 4
        scanned = ordering.scan(layout, ["g"], ["id"], {"low": ("min", F.col("v")), "sum": ("sum", F.col("v"))}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in (0, 1):
        rows = sorted((r for r in scanned if r["g"] == g), key=lambda r: r["id"])
        for i, r in enumerate(rows):
            before = [x["v"] for x in rows[:i]]
            assert r["low"] == (min(before) if before else None) and r["sum"] == sum(before)


def test_lost_shared_folder_is_an_error(spark, monkeypatch):
    from corpusflow import scratch

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        scratch.scratch_root(Cluster)
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
