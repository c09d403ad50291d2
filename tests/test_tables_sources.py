import json

import pytest
from pyspark.sql import functions as F

from tekstmill.functions import language
from tekstmill.operators import chain, tables
from tekstmill.plans import jobs, lineage
from tekstmill.sources import readers, schema, writers


def test_unique_names():
    assert tables.unique_names(["a", "a", "b", "a"]) == ["a", "a_1", "b", "a_2"]
    seen = {"New": 1}
    assert tables.unique_names(["Test"], seen) == ["Test"] and seen == {"New": 1, "Test": 0}
    seen = {"Test": 1}
    assert tables.unique_names(["Test"], seen) == ["Test_2"] and seen == {"Test": 2}


def test_near_duplicate_columns(spark):
    rows = [(i, i if i else None, i if i != 9 else -1, str(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d string")
    found = {(r.left_col, r.right_col): r.equal_share for r in tables.near_duplicate_columns(df, 0.9).collect()}
    assert found == {("a", "b"): 0.9, ("a", "c"): 0.9}
    assert tables.near_duplicate_columns(df, 0.91).count() == 0
    assert tables.near_duplicate_columns(df.limit(0)).count() == 0
    assert tables.near_duplicate_columns(df.select("a")).count() == 0


def test_many_pairs_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(tables, "PAIRS_PER_PASS", 4)
    df = spark.range(5).select(*[F.col("id").alias(f"c{i}") for i in range(6)])
    assert tables.near_duplicate_columns(df).count() == 15


def test_clean_table(spark):
    df = spark.createDataFrame([("x\n1", "p", "x\n1"), ("y", None, "y")], "a string, b string, c string").toDF("a", "a", "b")
    out = tables.clean_table(df)
    assert out.columns == ["a", "a_1"] and sorted(map(tuple, out.collect())) == [("x1", "p"), ("y", None)]


def test_nullable_schema(spark):
    df = spark.sql("select 1 a, null n, array() e, named_struct('x', array(null), 'y', map('k', null)) s")
    out = schema.normalise_schema(df)
    assert out.schema.simpleString() == "struct<a:int,n:string,e:array<string>,s:struct<x:array<string>,y:map<string,string>>>"
    assert all(f.nullable for f in out.schema.fields)
    later = schema.normalise_schema(spark.sql("select '2' a"), out.schema)
    assert later.schema == out.schema and later.first().a == 2


def test_metadata_forms(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", '{"k": "v", "n": 1}'), (2, "b", "{bad"), (3, "c", None)], "id int, text string, metadata string")
    df.write.parquet(str(tmp_path / "p"))
    rows = readers.read_documents(spark, str(tmp_path / "p"), default_metadata={"k": "d", "z": "1"}).orderBy("id").collect()
    assert [r.metadata for r in rows] == [{"k": "v", "n": "1", "z": "1"}, {"k": "d", "z": "1"}, {"k": "d", "z": "1"}]
    plain = readers.read_documents(spark, str(tmp_path / "p"), read_metadata=False)
    assert plain.columns == ["text", "id"]
    assert "ReadSchema: struct<id:int,text:string>" in plain._jdf.queryExecution().executedPlan().toString()
    changed = readers.read_documents(spark, str(tmp_path / "p"), adapter=lambda d: d.withColumn("text", F.upper("text")))
    assert sorted(r.text for r in changed.collect()) == ["A", "B", "C"]


def test_skip_limit_and_paths_file(spark, tmp_path):
    spark.range(10).select("id", F.col("id").cast("string").alias("text")).coalesce(1).write.parquet(str(tmp_path / "d" / "one"))
    spark.range(10, 12).select("id", F.col("id").cast("string").alias("text")).coalesce(1).write.parquet(str(tmp_path / "d" / "two"))
    all_rows = readers.read_documents(spark, str(tmp_path / "d"), glob_pattern="**/*.parquet")
    assert all_rows.count() == 12
    some = readers.read_documents(spark, str(tmp_path / "d" / "one"), skip=3, limit=2, order_by=["id"])
    assert [r.id for r in some.collect()] == [3, 4]
    assert readers.read_documents(spark, str(tmp_path / "d" / "one"), limit=4).count() == 4
    (tmp_path / "list.txt").write_text("two\n\n")
    assert readers.read_documents(spark, str(tmp_path / "d"), paths_file=str(tmp_path / "list.txt")).count() == 2


def test_patterns(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.jsonl").write_text('{"text": "a"}\nnot json\n')
    (tmp_path / "sub" / "b.jsonl").write_text('{"text": "b"}\n')
    read = lambda g: sorted(r.text for r in readers.read_jsonl(spark, str(tmp_path), g, "text string").collect())
    assert read(None) == ["a", "b"] and read("*.jsonl") == ["a"] and read("**/*.jsonl") == ["a", "b"] and read("sub/*.jsonl") == ["b"]
    for bad in ("", "**/x/*.jsonl", "**/"):
        with pytest.raises(ValueError):
            readers.read_jsonl(spark, str(tmp_path), bad, "text string")
    with pytest.raises(ValueError):
        readers.read_jsonl(spark, "")


@pytest.mark.parametrize("name", ["snappy", "gzip", "lz4", "zstd", None])
def test_compressions(spark, tmp_path, texts, name):
    writers.write_documents(texts("a", "b"), str(tmp_path / "o"), name, max_records_per_file=1)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_bad_compression(spark, tmp_path, texts):
    with pytest.raises(ValueError):
        writers.write_documents(texts("a"), str(tmp_path / "o"), "zip")
    with pytest.raises(RuntimeError):
        writers.write_documents(texts("a"), str(tmp_path / "o"), "brotli")


def test_expand_metadata_and_schema(spark, tmp_path):
    df = spark.sql("select 1 id, 't' text, named_struct('k', 2) metadata")
    writers.write_documents(df, str(tmp_path / "e"), expand_metadata=True)
    assert spark.read.parquet(str(tmp_path / "e")).columns == ["id", "text", "k"]
    shape = spark.sql("select 1L id, '' text, '' metadata").schema
    writers.write_documents(df, str(tmp_path / "s"), schema=shape)
    assert spark.read.parquet(str(tmp_path / "s")).first().asDict() == {"id": 1, "text": "t", "metadata": '{"k":2}'}


def test_union(spark):
    both = readers.union_datasets({"a": spark.sql("select 1 x"), "b": spark.sql("select 2 y")})
    assert sorted(map(str, both.collect())) == ["Row(x=1, dataset='a', y=None)", "Row(x=None, dataset='b', y=2)"]
    with pytest.raises(ValueError):
        readers.union_datasets({})


def test_shared_folder_follows_the_session(spark, tmp_path):
    folder = lineage.shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder)
    df = lineage.cut_lineage(spark.range(3))
    assert df.count() == 3 and all(folder.split(":")[-1] in f for f in df.inputFiles())


def test_all_jobs_in_a_row(spark, tmp_path):
    from test_filters import LONG

    source = tmp_path / "in"
    source.mkdir()
    other = LONG.replace("mand", "kone").replace("skoven", "havet").replace("guld", "sølv")
    lines = [{"id": f"x{i}", "text": t, "metadata": {"n": str(i)}} for i, t in enumerate([LONG, LONG, other, "this is english and it is short"])]
    (source / "a.jsonl").write_text("\n".join(json.dumps(line) for line in lines))
    with pytest.raises(ValueError):
        jobs.Dataset("a", "", "o", "e")
    with pytest.raises(ValueError):
        jobs.Dataset("a", "i", "o", "e", glob_pattern="")
    data = jobs.Dataset("a", str(source), f"{tmp_path}/out", f"{tmp_path}/excl", "*.jsonl")
    shape = "id string, text string, metadata map<string,string>"
    steps = chain.default_steps(profiles=language.stop_word_profiles(), language_options={"min_score": 0.5})
    stats = jobs.run_filter(spark, [data], steps, shape)
    totals = {(r.dataset, r.outcome): r.documents for r in stats.collect()}
    assert totals[("a", "kept")] == 3 and totals[("a", "non_danish_documents")] == 1 and totals[(None, None)] == 4
    kept = spark.read.parquet(f"{tmp_path}/out/filter_output")
    assert kept.count() == 3 and json.loads(kept.filter("id = 'x2'").first().metadata) == {"n": "2"}
    assert spark.read.parquet(f"{tmp_path}/excl/rejected_by=non_danish_documents").count() == 1

    cut = jobs.run_sentence_dedup(spark, f"{tmp_path}/out", f"{tmp_path}/sent", f"{tmp_path}/excl2", min_doc_words=10)
    assert sum(r.documents for r in cut.collect()) == 3
    assert spark.read.parquet(f"{tmp_path}/excl2/sent_dedup").count() == 1

    done = jobs.run_minhash_dedup(spark, f"{tmp_path}/out", f"{tmp_path}/mini", f"{tmp_path}/excl3")
    assert {r.outcome: r.documents for r in done.collect()} == {"kept": 2, "removed": 1}
    left = spark.read.parquet(f"{tmp_path}/mini/deduplicated_output")
    assert sorted(left.columns) == ["id", "metadata", "text", "token_count", "language", "language_score"] or left.count() == 2
    assert jobs.run_filter(spark, []).count() in (0, 1)
