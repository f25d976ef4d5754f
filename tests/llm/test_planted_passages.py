import random

from corpusflow.llm import queries
from corpusflow.llm.suffix_dedup import LENGTH

WORDS = "the of and river stone light water house music green quiet paper seven window garden winter letter summer simple bridge".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choices(WORDS, k=n))


def test_passages_of_over_50_words_go_from_400_bytes_on(spark, tmp_path):
    """The contract counts bytes: shorter passages stay, however many words they have, and of longer ones no byte is left."""
    passages = {size: prose(size, 120)[:size] for size in (LENGTH - 60, LENGTH - 1, LENGTH, LENGTH + 1, LENGTH + 150)}
    assert all(len(p.split()) > 50 for p in passages.values())
    rows = []
    for size, passage in passages.items():
        for mark in "<[{":  # other characters on both sides of each copy
            rows.append((len(rows), f"{prose(f'{size}{mark}', 30)}{mark}{passage}{mark}{prose(f'{mark}{size}', 40)}", size if size >= LENGTH else 0))
    rows.append((len(rows), prose("alone", 300), 0))
    spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in queries.op7_suffix_dedup(spark, str(tmp_path)).collect()}
    assert found == {i: (len(text), removed, int(removed > 0)) for i, text, removed in rows}
