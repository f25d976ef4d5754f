"""Texts of very many matches take linear time, with the same answers as short ones."""

import random
import time

from pyspark.sql import functions as F

from corpusflow.llm import pii, secret_scan
from corpusflow.llm.spans import blocks_of, covered, cut_out, find_spans

RUNS = "array<struct<start:int,end:int,found:string>>"


def test_covered_runs_equal_brute_force(spark):
    rng = random.Random(2)
    cases = []
    for i in range(60):
        at, runs = 0, []
        for _ in range(rng.choice([0, 1, 5, 600])):
            at += rng.randint(0, 3)
            end = at + rng.randint(1, 6)
            runs.append((at, end, "x"))
            at = end
        spans = [(a := rng.randint(0, 1500 if len(runs) > 10 else 30), a + rng.randint(1, 20), "s") for _ in range(rng.choice([0, 1, 4, 300]))]
        cases.append((i, runs, spans))
    df = spark.createDataFrame(cases, f"i int, runs {RUNS}, spans {RUNS}")
    for row in df.select("*", covered(F.col("runs"), F.col("spans")).alias("told")).collect():
        want = [(a, b, any(s < b and a < e for s, e, _ in row.spans)) for a, b, _ in row.runs]
        assert [(t.start, t.end, t.covered) for t in row.told] == want


def test_cut_out_equals_slices(spark):
    text = "".join(chr(97 + i % 26) if i % 7 else "\U0001f600\n"[i % 2] for i in range(5000))
    places = [(0, 0), (0, 1), (0, 5000), (1023, 1025), (1024, 2048), (1500, 4999), (4999, 5000), (2048, 2048), (60, 120)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "t string, a int, b int")
    for row in df.select("a", "b", cut_out(blocks_of(F.col("t")), F.col("a"), F.col("b")).alias("x")).collect():
        assert row.x == text[row.a : row.b]


def test_spans_of_many_matches_have_their_places(spark):
    text = "".join(f"é{i} " for i in range(3000))
    df = spark.createDataFrame([(text,)], "t string")
    rows = df.select(find_spans(F.col("t"), "[0-9]+").alias("s")).first().s
    assert [text[r.start : r.end] for r in rows] == [str(i) for i in range(3000)]


def test_twenty_thousand_secrets_in_a_text(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choices("0123456789abcdef", k=24)) for _ in range(20_000)]
    df = spark.createDataFrame([(1, " ".join(hexes)), (2, "an_ordinary_identifier_here and " + hexes[0])], "doc_id bigint, text string")
    began = time.time()
    rows = {r.doc_id: r for r in secret_scan.scan_secrets(df).collect()}
    assert rows[1].n_hex == len(rows[1].base) == 20_000 and rows[2].n_hex == 1
    assert rows[1].base[-1].end == 25 * 20_000 - 1
    assert time.time() - began < 60


def test_personal_data_masked_twenty_thousand_times(spark):
    text = "".join(f"mail: user{i}@example.org " for i in range(20_000))
    df = spark.createDataFrame([(1, text), (2, None), (3, "call +1 212 555 0100 now")], "doc_id bigint, text string")
    began = time.time()
    rows = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert rows == {1: "mail: [EMAIL] " * 20_000, 2: None, 3: "call [PHONE] now"}
    assert time.time() - began < 60
