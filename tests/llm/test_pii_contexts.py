"""Identifiers that no fixed pattern knows, found by their contexts."""

from pyspark.sql import functions as F

from corpusflow.llm import pii
from corpusflow.llm.spans import as_text


def learned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.scan_pii(df).select("doc_id", as_text(F.col("all")).alias("spans")).collect()
    return [s for _, s in sorted((r.doc_id, r.spans) for r in found)]


def test_discoveries_make_words_without_seeds_patterns(spark):
    odd = [f"999.1.{i}.7" for i in range(6)]
    # 'node:' finds the odd addresses; these make 'host:', which has no seed, reliable.
    texts = [f"node: 10.1.{i}.7 up" for i in range(24)] + [f"node: {x} up" for x in odd]
    texts += [f"host: {x} up" for x in odd] + ["host: 777.1.1.7 up"]
    texts += [f"year: 666.1.{i}.7 up" for i in range(9)]
    found = learned(spark, texts)
    assert found[24:37] == ["context:6:15"] * 13
    assert all(s == "" for s in found[37:])


def test_contexts_carry_over_to_other_shapes(spark):
    texts = [f"mobile: +1 (269) 555-{1000 + i} thanks" for i in range(16)] + [f"account: a{i}@b.example.com" for i in range(16)]
    unseen = {
        "mobile: 269555 now": "269555", "mobile: (269) 555-3296 now": "(269) 555-3296", "mobile: 269 555 3296, ok": "269 555 3296",
        "mobile: 06 12 34 56 78 now": "06 12 34 56 78", "account: jane (at) example (dot) com now": "jane (at) example (dot) com",
        "account: jane.doe at example dot co dot uk now": "jane.doe at example dot co dot uk", "account: root@localhost now": "root@localhost",
        "account: jane[AT]example.com now": "jane[AT]example.com",
    }
    others = ["the year 20261 and", "the code 48213 here", "call 269 555 3296 now", "see jane (at) example (dot) com", "look at the dot com"]
    found = learned(spark, [*texts, *unseen, *others])
    assert found[32:40] == [f"context:{t.index(x)}:{t.index(x) + len(x)}" for t, x in unseen.items()]
    assert found[40:] == [""] * 5 and not any("context" in s for s in found[:32])
