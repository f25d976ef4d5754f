import json

import pytest

from corpusflow.sources import readers


def read(spark, folder, *files):
    folder.mkdir()
    for number, lines in enumerate(files):
        (folder / f"{number}.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return sorted((tuple(r) for r in readers.read_mixed_jsonl(spark, str(folder)).collect()), key=repr)


def test_field_per_line(spark, tmp_path):
    lines = [{"body": "a", "id": 1}, {"id": 2, "body": "b"}, {"story": "c", "body": "x"}, {"story": "x", "text": "d"},
             {"title": "e", "id": 3}, {"text": None, "story": "x"}, {"body": 5}, {"body": ["f", {"g": 1}]}, {}]
    assert read(spark, tmp_path / "a", lines) == sorted(
        [("body", "a"), ("body", "b"), ("story", "c"), ("text", "d"), ("title", "e"), ("text", None), ("body", "5"),
         ("body", '["f",{"g":1}]'), (None, None)], key=repr)


def test_the_first_line_names_the_common_field(spark, tmp_path):
    # The first line has a story, so that others fall back on their own first field.
    assert read(spark, tmp_path / "a", [{"story": "a"}, {"id": "7", "body": "b"}]) == [("id", "7"), ("story", "a")]
    assert read(spark, tmp_path / "b", ["", "  "], [{"body": "a"}], [{"id": "7", "body": "b"}]) == [("body", "a"), ("body", "b")]
    assert read(spark, tmp_path / "c", [{"we.ird \"k'ey": "a"}, {"x": 1, "we.ird \"k'ey": "b"}]) == [('we.ird "k\'ey', "a"), ('we.ird "k\'ey', "b")]


def test_empty_and_broken_files(spark, tmp_path):
    assert read(spark, tmp_path / "a", [""]) == []
    for number, line in enumerate(("{", '"text"', '{"text": "a", "text": "b"}')):
        with pytest.raises(Exception):
            read(spark, tmp_path / f"b{number}", [{"text": "fine"}, line])
