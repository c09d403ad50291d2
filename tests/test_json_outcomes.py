"""JSON of any shape by a VARIANT walk, and extraction that gives every file an outcome."""

import json

import pytest
from pyspark.sql import functions as F

from tekstmill.operators import extraction
from tekstmill.operators.json_walk import walk_json
from tekstmill.plans import jobs


def walked(spark, *docs, keys="text"):
    rows = spark.createDataFrame(list(enumerate(docs)), "id int, j string")
    out = walk_json(rows, F.col("j"), keys.split(","), ["id"]).collect()
    return sorted((r.id, r.outcome, r.detail, tuple(r.position), r.text) for r in out)


def python_walk(data, keys):
    """The walk of the text's own kinds, in plain Python, for comparison."""
    if not keys:
        if isinstance(data, str):
            return [data]
        if isinstance(data, list):
            return [t for item in data for t in python_walk(item, keys)]
        if isinstance(data, dict):
            return [json.dumps(data, sort_keys=True, separators=(",", ":"))]
        return ["None" if data is None else str(data)]
    if isinstance(data, dict) and keys[0] in data:
        return python_walk(data[keys[0]], keys[1:])
    if isinstance(data, list):
        return [t for item in data for t in python_walk(item, keys)]
    return []


def test_shapes_give_one_two_and_n_records(spark):
    got = walked(spark, '{"text": "one"}', '{"text": ["x", "y"]}', '[{"text": "a"}, {"text": "b"}, {"text": "c"}]')
    texts = [(i, t) for i, o, _, _, t in got if o == "text"]
    assert texts == [(0, "one"), (1, "x"), (1, "y"), (2, "a"), (2, "b"), (2, "c")]


def test_misses_broken_and_scalars(spark):
    got = walked(spark, '{"other": 1}', "{broken", None, "", '{"text": [1, true, null, 2.5, {"b": 1, "a": [2]}]}', "7")
    assert (0, "missing", "text", (), None) in got
    assert [r[1] for r in got if r[0] in (1, 2, 3)] == ["broken", "broken", "broken"]
    assert [r[4] for r in got if r[0] == 4] == ["1", "True", "None", "2.5", '{"a":[2],"b":1}']
    assert got[-1] == (5, "missing", "text", (), None)


def test_deep_paths_and_nesting_equal_python(spark):
    docs = [
        {"a": {"b": ["x", ["y", ["z"]]]}},
        [{"a": [{"b": "p"}, {"c": "q"}]}, [[{"a": {"b": "r"}}]]],
        {"a": "no b"},
        {"a": {"b": {"c": "obj"}}},
        [[[[["deep"]]]]],
    ]
    got = walked(spark, *[json.dumps(d) for d in docs], keys="a,b")
    for i, d in enumerate(docs):
        texts = [t for j, o, _, _, t in sorted(got, key=lambda r: (r[0], r[3])) if j == i and o == "text"]
        assert texts == python_walk(d, ["a", "b"])


def test_empty_input(spark):
    assert walked(spark) == []


def test_every_file_has_an_outcome(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"text": ["x", "y"]}')
    (folder / "b.json").write_text('[{"text": "t1"}, {"text": "t2"}, {"text": "t3"}]')
    (folder / "c.json").write_text('{"text": "one"}')
    (folder / "d.json").write_text('{"text": ')
    (folder / "e.json").write_text('{"body": "no text key"}')
    (folder / "f.txt").write_bytes(b"caf\xe9 latin-1")
    (folder / "g.txt").write_text("plain\n\n\ntext")
    (folder / "h.html").write_text("<html><body><script>x()</script></body></html>")
    (folder / "i.html").write_text("<html><body><article><p>Main text here.</p></article></body></html>")
    (folder / "j.pdf").write_bytes(b"%PDF-1.4")
    (folder / "_k.txt").write_text("underscore file")
    counts = jobs.extract_with_outcomes(
        spark, str(folder), str(tmp_path / "out"), str(tmp_path / "quarantine"), "test", now=None
    )
    assert counts["rows"] == 13
    assert (counts["text"], counts["unsupported"], counts["bad_utf8"], counts["empty"], counts["broken"], counts["missing"]) == (
        8, 1, 1, 1, 1, 1,
    )
    quarantine = {(r.path.rsplit("/", 1)[-1], r.outcome) for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()}
    assert quarantine == {("d.json", "broken"), ("e.json", "missing"), ("f.txt", "bad utf-8"), ("h.html", "empty"), ("j.pdf", "unsupported")}
    records = spark.read.json(str(tmp_path / "out" / "test.jsonl.gz")).collect()
    assert sorted(r.text for r in records) == sorted(["x", "y", "t1", "t2", "t3", "one", "plain\ntext", "Main text here."])


def test_outcomes_of_rows(spark):
    files = spark.createDataFrame(
        [("/x/a.md", b"# title"), ("/x/b.HTML", b"<p>x</p>"), ("/x/c.json", b"[]"), ("/x/d.txt", b"")],
        "path string, content binary",
    )
    got = sorted((r.path, r.outcome, r.detail) for r in extraction.extract_file_rows(files).collect())
    assert got == [("/x/a.md", "text", None), ("/x/b.HTML", "unsupported", ".HTML"), ("/x/d.txt", "empty", None)]
