import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.bytelevel import alphabet, base_ids, byte_ids, words_of
from corpusflow.operators import bpe
from corpusflow.scratch import load_table

tokenizers = pytest.importorskip("tokenizers")


def package_tokenizer(texts, vocab_size, min_frequency, folder):
    path = folder / "corpus.txt"
    path.write_text("".join(t + "\n" for t in texts), encoding="utf-8", newline="")
    trained = tokenizers.ByteLevelBPETokenizer()
    trained.train([str(path)], vocab_size=vocab_size, min_frequency=min_frequency, show_progress=False,
                  special_tokens=["[CLS]", "[SEP]", "[MASK]", "[PAD]"])
    trained.save_model(str(folder))
    vocab = trained.get_vocab()
    lines = (folder / "merges.txt").read_text(encoding="utf-8").split("\n")[1:]
    merges = [tuple(line.split(" ")) for line in lines if line]
    return trained, sorted(vocab, key=vocab.get), merges


def spelled(tokenizer):
    return [(tokenizer.tokens[a], tokenizer.tokens[b]) for a, b, _ in tokenizer.merges]


def check(spark, texts, vocab_size, min_frequency, folder, **options):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ours = bpe.train_bpe_on_words(bpe.pretoken_counts(df), vocab_size, min_frequency, **options)
    _, tokens, merges = package_tokenizer(texts, vocab_size, min_frequency, folder)
    assert spelled(ours) == merges
    assert list(ours.tokens) == tokens


def test_documents_match_the_package(spark, tmp_path):
    docs = load_table(spark, "/root/testdata/sf0.001/documents.parquet").select("text")
    ours = bpe.train_bpe(docs, 420)
    _, tokens, merges = package_tokenizer([r["text"] for r in docs.collect()], 420, 2, tmp_path)
    assert spelled(ours) == merges
    assert list(ours.tokens) == tokens


def test_few_guide_words_change_nothing(spark, tmp_path):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(60)]
    check(spark, texts, 360, 2, tmp_path, guide_words=5)


@pytest.mark.parametrize("top_pairs", [1, 12, 60])
def test_few_pair_counts_in_the_driver_change_nothing(spark, tmp_path, top_pairs):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(40)] + ["aaaa aaa aaaaaa abab ababab"]
    check(spark, texts, 275 if top_pairs == 1 else 330, 2, tmp_path, top_pairs=top_pairs, guide_words=50)


def test_a_vocabulary_of_5000_matches_the_package(spark, tmp_path):
    docs = load_table(spark, "/root/testdata/sf0.001/documents.parquet").select("text")
    ours = bpe.train_bpe_on_words(bpe.pretoken_counts(docs), 5000, top_pairs=1000)
    _, tokens, merges = package_tokenizer([r["text"] for r in docs.collect()], 5000, 2, tmp_path)
    assert spelled(ours) == merges and list(ours.tokens) == tokens


@pytest.mark.parametrize(
    "texts",
    [
        ["aaaa aaaa aaa", "aaaaa baaab", "aa aa"],
        ["ab ba ab ba", "cd dc cd dc"],  # equal counts
        ["abc abc ab bc abc", "abcabc bcab"],
        ["über straße ночь 夜夜夜 😀😀", "  two  spaces\n\nand lines \n x"],
        ["x y z"],
    ],
)
def test_small_corpora_match_the_package(spark, tmp_path, texts):
    check(spark, texts, 280, 2, tmp_path)


def test_min_frequency_and_small_vocabulary(spark, tmp_path):
    check(spark, ["hello hello help", "hell"], 300, 3, tmp_path)
    df = spark.createDataFrame([("hello hello",)], "text string")
    assert bpe.train_bpe(df, 100).tokens == bpe.Tokenizer.base().tokens
    assert len(bpe.Tokenizer.base().tokens) == 260


def test_a_merge_that_spells_a_known_token_reuses_its_id():
    base = bpe.Tokenizer.base()
    a, b, c = (base.tokens.index(x) for x in "abc")
    grown = base.extended([(a, b), (b, c)]).extended([(260, c), (a, 261)])
    assert grown.tokens[260:] == ("ab", "bc", "abc")
    assert grown.merges[-1] == (a, 261, 262)


def joined(ids, pair, merged):
    out = []
    for x in ids:
        if out and (out[-1], x) == pair:
            out[-1] = merged
        else:
            out.append(x)
    return out


def test_symbols_merge_counts_like_a_recount():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lists = [rng.integers(0, 3, rng.integers(1, 9)).tolist() for _ in range(6)]
        counts = rng.integers(1, 5, 6)
        flat = np.array([x for ids in lists for x in ids])
        symbols = bpe._Symbols(flat, np.cumsum([0, *map(len, lists)]), counts)
        pair = tuple(int(x) for x in rng.integers(0, 3, 2))
        left, right, delta = symbols.merge(pair, 9)
        merged = [joined(ids, pair, 9) for ids in lists]
        assert symbols.lists().to_pylist() == merged
        expected = {}
        for sign, words in ((-1, lists), (1, merged)):
            for ids, count in zip(words, counts.tolist()):
                for p in zip(ids, ids[1:]):
                    expected[p] = expected.get(p, 0) + sign * count
        assert dict(zip(zip(left.tolist(), right.tolist()), delta.tolist())) == {p: d for p, d in expected.items() if d}


def test_words_and_pairs(spark):
    df = spark.createDataFrame([("don't stop  now 42!\n",)], "text string")
    assert df.select(words_of(F.col("text"))).first()[0] == ["don", "'t", " stop", " ", " now", " 42", "!", "\n"]
    words = spark.createDataFrame([("aab", 3), ("ab", 2)], "word string, cnt bigint")
    a, b = (base_ids()[ord(x)] for x in "ab")
    rows = {(r["left"], r["right"]): r["cnt"] for r in bpe.pair_counts(words).collect()}
    assert rows == {(a, a): 3, (a, b): 5}
    assert bpe.most_frequent_pairs(bpe.pair_counts(words)).first()["cnt"] == 5


def test_base_alphabet(spark):
    assert alphabet()[0] == "!" and alphabet()[-1] == "Ń"
    df = spark.createDataFrame([("é!\x00",), ("",)], "text string")
    ids = base_ids()
    got = [r[0] for r in df.select(byte_ids(F.col("text"))).collect()]
    assert got == [[ids[0xC3], ids[0xA9], ids[0x21], ids[0]], []]


def test_counts_are_per_line(spark):
    df = spark.createDataFrame([("a \nb",)], "text string")
    rows = {r["word"]: r["cnt"] for r in bpe.pretoken_counts(df).collect()}
    assert rows == {"a": 1, " \n": 1, "b": 1, "\n": 1}
