"""Leaks whose parts stand in another order, and short ones, against the plain version."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from corpusflow.llm import decontamination  # noqa: E402


def test_swapped_parts_and_short_items(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdeilnorst", k=7)) for _ in range(n))
    a, b, c = words(70), words(70), words(60)
    short = [words(9) for _ in range(40)]
    items = list(enumerate([f"{a} {b}", f"{a} {a} {c}", *short]))
    texts = [f"{words(150)} {b} {a} {words(150)}", f"{words(30)} {c} {a} {words(3)} {a} {words(40)}", f"{b} {a}", f"{words(9)} {a} {b}",
             f"{words(90)} {a}", a.rsplit(" ", 1)[0], *[s.rsplit(" ", 1)[0] for s in short]]
    rows = list(enumerate(texts))
    found = decontamination.find_leaks(
        spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    best = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    assert best == {k: pytest.approx(v) for k, v in brute.leaks(rows, items).items()}
    assert {(0, 0), (1, 1), (2, 0), (45, 41)} <= set(best)
