import json

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import bytelevel
from corpusflow.operators import bpe, encode
from corpusflow.sources import readers, run_catalog, tokenizer_files, writers


def texts(df, column="text"):
    return sorted(r[column] for r in df.collect())


def test_json_lines(spark, tmp_path):
    good = tmp_path / "train.jsonl"
    good.write_text('{"text": "a"}\n{"text": "caf\\u00e9"}\n{"text": ""}\n')
    assert texts(readers.read_jsonl_samples(spark, str(good))) == ["", "a", "café"]
    gaps = tmp_path / "gaps.jsonl"
    gaps.write_text('{"text": "a"}\n{"other": 1}\n{"text": ""}\n{"text": null}\n')
    assert texts(readers.read_jsonl_lenient(spark, str(gaps))) == ["a"]
    with pytest.raises(Exception, match="no text"):
        readers.read_jsonl_samples(spark, str(gaps)).collect()
    broken = tmp_path / "broken.jsonl"
    broken.write_text('{"text": "a"}\nnot json\n')
    for read in (readers.read_jsonl_samples, readers.read_jsonl_lenient):
        with pytest.raises(Exception):
            read(spark, str(broken)).collect()


def test_text_files(spark, tmp_path):
    path = tmp_path / "samples.txt"
    path.write_text("one\nline\n\n  two \n\n\n\n\nthree\n")
    assert texts(readers.read_paragraph_text(spark, str(path))) == ["one\nline", "three", "two"]
    prompts = tmp_path / "prompts.txt"
    prompts.write_text("Once\n\nThe end\n")
    assert texts(readers.read_prompts(spark, str(prompts)), "prompt") == ["Once", "The end"]


def test_splits_round_trip(spark, tmp_path):
    rows = [("train", 0, "a\nb"), ("train", 1, "é"), ("test", 0, "z")]
    samples = spark.createDataFrame(rows, "split string, sample_no bigint, text string")
    writers.write_splits(samples, str(tmp_path / "out"))
    writers.write_small_bundle(samples, str(tmp_path / "out"), sizes={"train": 1, "test": 1})
    read = lambda *p: str(tmp_path.joinpath("out", *p))
    assert texts(readers.read_jsonl_samples(spark, read("jsonl", "split=train"))) == ["a\nb", "é"]
    assert texts(readers.read_paragraph_text(spark, read("text", "split=train"))) == ["a\nb", "é"]
    assert texts(readers.read_jsonl_samples(spark, read("small", "jsonl", "split=train"))) == ["a\nb"]
    corpus = readers.load_corpus(spark, {"train": read("jsonl", "split=train"), "test": read("jsonl", "split=test")}, "json")
    assert sorted((r["split"], r["text"]) for r in corpus.collect()) == [("test", "z"), ("train", "a\nb"), ("train", "é")]
    assert writers.write_tokenizer_corpus(samples, read("corpus")) == 3


def test_training_files(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        readers.read_training_files(spark, folder)
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "x.txt").write_text("p\n\nq")
    kinds = lambda: (lambda f, p: (f, [x.rsplit("/", 1)[1] for x in p]))(*readers.discover_training_files(spark, folder))
    assert kinds() == ("text", ["x.txt"]) and texts(readers.read_training_files(spark, folder)) == ["p", "q"]
    (tmp_path / "processed").mkdir()
    for place, name, expected in (
        ("processed", "other.jsonl", ["other.jsonl"]), ("processed", "train1.jsonl", ["train1.jsonl"]),
        (".", "train_b.jsonl", ["train_b.jsonl"]), (".", "train_a.jsonl", ["train_a.jsonl", "train_b.jsonl"]),
    ):
        (tmp_path / place / name).write_text(json.dumps({"text": name}) + "\n")
        assert kinds() == ("jsonl", expected)
    assert texts(readers.read_training_files(spark, folder)) == ["train_a.jsonl", "train_b.jsonl"]


def test_tokenizer_files(spark, tmp_path):
    base = bpe.Tokenizer.base()
    trained = base.extended([(base.tokens.index("a"), base.tokens.index("b")), (260, base.tokens.index("Ġ"))])
    tokenizer_files.save_tokenizer_tables(spark, trained, str(tmp_path / "saved"))
    assert tokenizer_files.load_tokenizer_tables(spark, str(tmp_path / "saved")) == trained
    config = spark.read.json(str(tmp_path / "saved" / "config")).first()
    assert config["vocab_size"] == 262 and config["special_tokens"]["mask_token"] == "[MASK]"
    (tmp_path / "vocab.json").write_text(json.dumps({t: i for i, t in enumerate(trained.tokens)}))
    (tmp_path / "merges.txt").write_text("#version: 0.2\na b\nab Ġ\n")
    assert tokenizer_files.import_tokenizer_files(spark, str(tmp_path)) == trained
    with pytest.raises(Exception):
        tokenizer_files.load_tokenizer_tables(spark, str(tmp_path / "nowhere"))


def test_a_vocabulary_in_another_layout_keeps_its_ids(spark, tmp_path):
    tokens = [*bytelevel.alphabet(), "ab", "[CLS]", "[SEP]", "[MASK]", "[PAD]"]
    (tmp_path / "vocab.json").write_text(json.dumps({t: i for i, t in enumerate(tokens)}))
    (tmp_path / "merges.txt").write_text("#version: 0.2\na b\n")
    tokenizer = tokenizer_files.import_tokenizer_files(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "ab c"), (2, "[MASK]"), (3, None)], "id int, text string")
    encoded = encode.encode_corpus(df, tokenizer, padding=True, max_length=4)
    ids = {r["id"]: r["input_ids"] for r in encoded.collect()}
    assert ids == {1: [257, 256, 220, 66, 258], 2: [257, 259, 258, 260], 3: [257, 258, 260, 260]}
    back = encode.decode_corpus(encoded.select("id", F.col("input_ids").alias("ids")), tokenizer)
    assert {r["id"]: r["text"] for r in back.collect()} == {1: "ab c", 2: "", 3: ""}
    (tmp_path / "vocab.json").write_text(json.dumps({t: 2 * i for i, t in enumerate(tokens)}))
    with pytest.raises(ValueError, match="gaps"):
        tokenizer_files.import_tokenizer_files(spark, str(tmp_path))


def test_run_catalog(spark, tmp_path):
    path = tmp_path / "meta.json"
    path.write_text(json.dumps({"checkpoints": ["r/checkpoint-2.pt", "r/checkpoint-10.pt"], "best_checkpoint": None,
                                "best_metric": None, "last_checkpoint": "r/checkpoint-latest.pt"}, indent=2))
    catalog = run_catalog.read_run_catalog(spark, str(path))
    assert [(r["path"], r["step"]) for r in run_catalog.catalog_entries(catalog).orderBy("position").collect()] == [("r/checkpoint-2.pt", 2), ("r/checkpoint-10.pt", 10)]
    choose = lambda **o: run_catalog.resolve_from_catalog(catalog, **o).first()["path"]
    assert choose(load_best=True) == choose() == "r/checkpoint-10.pt"
    assert choose(load_latest=True) == "r/checkpoint-latest.pt" and choose(explicit="x") == "x"
    rows = [(1, 10, "a", 2.0), (1, 20, "b", 1.0), (1, 30, "c", 3.0), (2, 5, "d", None)]
    entries = spark.createDataFrame(rows, "run_id int, step bigint, path string, val_loss double")
    writers.write_run_catalog(entries, str(tmp_path / "runs"), max_checkpoints=2)
    read = {r["run_id"]: r for r in run_catalog.read_run_catalog(spark, str(tmp_path / "runs")).collect()}
    assert (read[1]["checkpoints"], read[1]["best_checkpoint"], read[1]["best_metric"], read[1]["last_checkpoint"]) == (["b", "c"], "b", 1.0, "c")
    assert read[2]["best_checkpoint"] is None


def test_results(spark, tmp_path):
    writers.write_eval_results({"diversity": spark.createDataFrame([(1, 0.5)], "id int, d double")}, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "diversity")).first()["d"] == 0.5
