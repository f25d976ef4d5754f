import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.sequences import CLS, MASK, PAD, SEP
from corpusflow.operators import bpe, encode, examples, vocabulary
from corpusflow.scratch import load_table
from test_bpe import package_tokenizer

TEXTS = [
    "Once upon a time in a land far, far away, there lived a tiny dragon.",
    "This is a [MASK] test.", "x ([MASK])[PAD] y", "", "  a  b \n\n c ", "über straße 夜 😀 \x00\x1f end　",
    "Short text", "I love programming: @#$%^&*()_+ 42 and 3.14159.", "[CLS][SEP]", "aaaa" * 50,
]


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    docs = load_table(spark, "/root/testdata/sf0.001/documents.parquet").select("text")
    texts = [r["text"] for r in docs.collect()]
    theirs, tokens, merges = package_tokenizer(texts, 700, 2, tmp_path_factory.mktemp("package"))
    theirs.post_processor = None
    ids = {t: i for i, t in enumerate(tokens)}
    return theirs, bpe.Tokenizer.base().extended((ids[a], ids[b]) for a, b in merges), texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def encoded(spark, texts, tokenizer):
    return [r["ids"] for r in encode.encode_ids(frame(spark, texts), tokenizer).orderBy("id").collect()]


def test_ids_and_texts_match_the_package(spark, trained):
    theirs, ours, texts = trained
    theirs.add_special_tokens(["[CLS]", "[SEP]", "[MASK]", "[PAD]"])
    sample = TEXTS + texts
    ids = encoded(spark, sample, ours)
    assert ids == [theirs.encode(t, add_special_tokens=False).ids for t in sample]
    rows = spark.createDataFrame(list(enumerate(ids)), "id int, ids array<int>")
    for skip in (True, False):
        decoded = [r["text"] for r in encode.decode_corpus(rows, ours, skip_special=skip).orderBy("id").collect()]
        assert decoded == [theirs.decode(i, skip_special_tokens=skip) for i in ids]


def test_long_words_take_no_quadratic_time(trained):
    _, ours, _ = trained
    word = "theandsaid" * 30_000
    started = time.monotonic()
    ids = bpe.segment(word, ours.ids_of_bytes(), bpe.merge_ranks(ours))
    assert time.monotonic() - started < 20
    assert "".join(ours.tokens[i] for i in ids) == word


def test_cut_characters_decode_like_the_package(spark, trained):
    theirs, ours, _ = trained
    base = bpe.base_ids()
    broken = [[base[b] for b in raw] for raw in ("夜😀".encode()[:2], "😀".encode()[:3] + b"a", b"\xff\xfea", b"\xe5\xa4x\x80", b"\xed\xa0\x80")]
    rows = spark.createDataFrame(list(enumerate(broken)), "id int, ids array<int>")
    got = [r["text"] for r in encode.decode_corpus(rows, ours).orderBy("id").collect()]
    assert got == [theirs.decode(i) for i in broken]


def test_encoding_options(spark):
    base = bpe.Tokenizer.base()
    a, b = (base.tokens.index(c) for c in "ab")
    df = frame(spark, ["ab", ""])
    get = lambda **o: [tuple(list(x) for x in (r["input_ids"], r["token_type_ids"], r["attention_mask"])) for r in encode.encode_corpus(df, base, **o).orderBy("id").collect()]
    assert get() == [([CLS, a, b, SEP], [0] * 4, [1] * 4), ([CLS, SEP], [0] * 2, [1] * 2)]
    assert get(truncation=True, max_length=3)[0] == ([CLS, a, b], [0] * 3, [1] * 3)
    assert get(padding=True, max_length=3) == [([CLS, a, b, SEP], [0] * 4, [1] * 4), ([CLS, SEP, PAD], [0] * 3, [1, 1, 0])]
    assert get(padding=True) == get()
    assert get(special_tokens=False)[1] == ([], [], [])


def test_batches_are_padded_to_their_longest_row(spark):
    base = bpe.Tokenizer.base()
    df = frame(spark, ["a", "abc", "abcdef", "ab"]).withColumn("batch_id", F.floor(F.col("id") / 2))
    rows = encode.encode_batches(df, base, padding=True).orderBy("id").collect()
    assert [len(r["input_ids"]) for r in rows] == [5, 5, 8, 8]
    assert [sum(r["attention_mask"]) for r in rows] == [3, 5, 8, 4]
    rows = encode.encode_batches(df, base, padding=True, truncation=True, max_length=4).orderBy("id").collect()
    assert [len(r["input_ids"]) for r in rows] == [4, 4, 4, 4]
    audit = examples.example_audit(examples.causal_lm_inputs(df, base, max_length=6), 6).first()
    assert tuple(audit) == (4, 0, 4, 4)


def test_labels(spark):
    inputs = spark.createDataFrame([([0, 7, 8, 1],), ([],)], "input_ids array<int>")
    assert [r["labels"] for r in examples.with_causal_labels(inputs).collect()] == [[7, 8, 1, PAD], [PAD]]
    assert examples.with_causal_labels(inputs, -100).first()["labels"] == [7, 8, 1, -100]
    assert examples.alignment_check(examples.with_causal_labels(inputs.limit(1))).first()[0] is True
    shifted = inputs.limit(1).withColumn("labels", F.col("input_ids"))
    assert examples.alignment_check(shifted).first()[0] is False


def test_masking(spark):
    ids = [CLS, *range(4, 204), SEP, PAD, MASK]
    inputs = spark.createDataFrame([(i, ids) for i in range(100)], "id int, input_ids array<int>")
    rows = examples.with_masked_labels(inputs, F.col("id"), 260, seed=1).collect()
    again = examples.with_masked_labels(inputs.repartition(7), F.col("id"), 260, seed=1).collect()
    assert {r["id"]: r["input_ids"] for r in rows} == {r["id"]: r["input_ids"] for r in again}
    assert all(r["labels"] == ids for r in rows)
    assert all(r["input_ids"][0] == CLS and r["input_ids"][201:203] == [SEP, PAD] for r in rows)
    body = [(x, y) for r in rows for x, y in zip(r["input_ids"][1:201], ids[1:201])]
    masked, changed = sum(x == MASK for x, _ in body) / len(body), sum(x != y for x, y in body) / len(body)
    assert abs(masked - 0.12) < 0.01 and abs(changed - 0.135) < 0.01
    none = examples.with_masked_labels(inputs, F.col("id"), 260, mask_prob=0.0).first()
    assert none["input_ids"] == ids
    only = examples.with_masked_labels(inputs, F.col("id"), 260, only_changed=True).first()
    assert all(y == (-100 if x == z else z) for x, y, z in zip(only["input_ids"], only["labels"], ids))
    assert examples.masked_token_count(inputs).first()[0] == 100


def test_round_trip_and_own_tokenizer(spark, trained):
    _, ours, texts = trained
    rows = {r["matches"]: r["n"] for r in encode.roundtrip_audit(frame(spark, texts + TEXTS[:1]), ours).collect()}
    assert rows == {True: len(texts) + 1}

    def lengths(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: [len(t)])

    assert [r["ids"] for r in encode.encode_with(frame(spark, ["ab", None]), lengths).orderBy("id").collect()] == [[2], [0]]
    words = spark.createDataFrame([("the", 3), (" the", 1)], "word string, cnt bigint")
    segmented = {r["word"]: r["ids"] for r in encode.encode_words(words, ours).collect()}
    assert segmented == {w: i for w, i in zip(("the", " the"), encoded(spark, ["the", " the"], ours))}


def test_lookups(spark):
    base = bpe.Tokenizer.base().extended([(4, 5)])
    vocab = vocabulary.vocab_table(spark, base)
    assert vocabulary.vocab_size(vocab).first()[0] == 261
    tokens = spark.createDataFrame([("[MASK]",), ('!"',), ("nope",)], "token string")
    assert {r["token"]: r["id"] for r in vocabulary.token_to_id(tokens, vocab).collect()} == {"[MASK]": 2, '!"': 260, "nope": None}
    ids = spark.createDataFrame([(3,), (260,), (999,)], "id int")
    assert {r["id"]: r["token"] for r in vocabulary.id_to_token(ids, vocab).collect()} == {3: "[PAD]", 260: '!"', 999: None}
    every = spark.createDataFrame([(i,) for i in range(6)], "id int")
    assert [r["id"] for r in vocabulary.drop_special(every).orderBy("id").collect()] == [4, 5]
    assert [r["special"] for r in vocabulary.flag_special(every).orderBy("id").collect()] == [True, True, False, True, False, False]
    assert vocabulary.merges_table(spark, base).first().asDict() == {"rank": 0, "left": "!", "right": '"', "merged_id": 260}
