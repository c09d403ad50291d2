"""Texts that must stay as they are, and those that must not."""

import pytest
from pyspark.sql import functions as F

from tekstmill.functions import extract
from tekstmill.functions.references import decode_text
from tekstmill.functions.repair import fix_misread, repair_text
from tekstmill.operators import chain, crawl, sentence_dedup, tables
from tekstmill.plans import jobs, lineage
from tekstmill.sources import readers, writers

CLEAN = [
    "”SMÅ” og ”PÅ”, sagde hun – Å… så blå.", "FÅ– og Å“ Ä” Ö‘", "„Ä“ und „Ö“ – schön…", "À la carte, déjà vu, «ÂGE»", "café”… é”…",
    "NÃO é bom", "ÆØÅ æøå", "smör­gås", "Å dag", "", "plain ascii",
    "“AMANHÃ”", "A MAÇÃ… E", "IRMÃ—", "LÂ»", "« CHÂTEAU »",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_is_unchanged(text):
    assert fix_misread(text) == text


@pytest.mark.parametrize("text", ["Blåbærgrød – “ål” og €5…", "Žluťoučký kůň", "déjà vu", "日本語 🙂", "Ãå", "ŁÓDŹ źdźbło"])
def test_misread_text_is_repaired(text):
    raw = text.encode()
    assert fix_misread("".join(bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in raw)) == text


def test_references_once():
    text = "&rsquo;&#8217;&euro;&iacute;&#x2014;&nbsp;&#38;amp; &copy &unknown; AT&T"
    assert decode_text(text) == "’’€í— &amp; &copy &unknown; AT&T"


def test_repair_on_a_table(texts):
    rows = repair_text(texts("Café &eacute;&hellip;", "<b>&eacute;</b>", None, "blÃ¥", "SMÅ…")).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["Café é…", "<b>&eacute;</b>", None, "blå", "SMÅ…"]


def test_html_is_evaluated_once(texts):
    from checks import queries

    plan = queries.html_to_text(texts("x").sparkSession, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<noscript") == 1


@pytest.mark.parametrize("by_sentence", [True, False])
def test_pieces_join_to_the_text(texts, by_sentence):
    values = ["...Lead text. Next! tail", "?!", "\n\na\nb\n", "", "a", "no marks"]
    rows = texts(*values).select("text", F.array_join(sentence_dedup.pieces(F.col("text"), by_sentence), "").alias("joined"))
    assert all(r.text == r.joined for r in rows.collect())


def test_link_with_an_empty_target_stays(texts):
    row = texts("<https://x.example/?url=&a=b>").select(extract.clean_mail_body(F.col("text")).alias("t")).first()
    assert row.t == "<https://x.example/?url=&a=b>"


def test_missing_text_is_rejected(texts):
    rows = chain.apply_chain(texts("a", None), []).orderBy("doc_id").collect()
    assert [r.rejected_by for r in rows] == [None, chain.NO_TEXT] and rows[1].reason == "missing_text"


def test_nan_equals_nothing_and_numbers_compare(spark):
    nan = float("nan")
    table = spark.createDataFrame([(1, 1, nan, nan), (2, 2, 1.0, 1.0)], "a int, b bigint, c double, d double")
    shares = {(r.left_col, r.right_col): r.equal_share for r in tables.near_duplicate_columns(table, 0.0).collect()}
    assert shares[("a", "b")] == 1.0 and shares[("c", "d")] == 0.5
    nested = spark.createDataFrame([], "a struct<m:map<string,int>>, b struct<m:map<string,int>>")
    assert tables._comparable(nested) == []


def test_root_is_matched_from_the_start(spark):
    paths = spark.createDataFrame(
        [("/x/precrawled/p/crawled/h/a.html",), ("file:/crawled/h.example/a.html",), ("/crawled/a.html",), ("hdfs://n:1/crawled/i/b",)], "p string"
    )
    assert [r[0] for r in paths.select(crawl.top_folder(F.col("p"), "/crawled/")).collect()] == [None, "h.example", None, "i"]


def test_file_names_are_decoded(spark, tmp_path):
    from tekstmill.operators import extraction

    (tmp_path / "my file å+1%.txt").write_text("hello")
    jobs.process_directory(spark, str(tmp_path), f"{tmp_path}/out", "src")
    row = spark.read.json(f"{tmp_path}/out/src.jsonl.gz").first()
    assert row["metadata"]["filename"] == "my file å+1%.txt" and row["id"] == "src-my-file-å+1%.txt"
    assert extraction.ROUTES[".txt"] == "text"


def test_metadata_keeps_its_types(spark, tmp_path):
    meta = '{"n":1,"o":{"k":[1,2]},"b":true}'
    docs = spark.createDataFrame([("a", "one two three four five six", meta), ("b", "one two three four five six", meta)], "id string, text string, metadata string")
    docs.write.parquet(f"{tmp_path}/in")
    jobs.run_minhash_dedup(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/gone")
    jobs.run_sentence_dedup(spark, f"{tmp_path}/out", f"{tmp_path}/sent", f"{tmp_path}/gone2")
    kept = spark.read.parquet(f"{tmp_path}/sent/sent_dedup_output")
    assert [(r.id, r.metadata) for r in kept.collect()] == [("a", meta)]
    assert [r.metadata for r in spark.read.parquet(f"{tmp_path}/gone/removed").collect()] == [meta]


def test_row_keys_follow_the_files(spark, tmp_path):
    for name, ids in (("p0", ["a", "b"]), ("p1", [f"c{i}" for i in range(500)]), ("p2", ["d"])):
        spark.createDataFrame([(i, "t") for i in ids], "id string, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    rows = jobs.with_row_key(readers.read_documents(spark, str(tmp_path))).orderBy("row_key").collect()
    assert [r.id for r in rows] == ["a", "b", *[f"c{i}" for i in range(500)], "d"]
    assert len({r.row_key for r in rows}) == 503


def test_map_metadata_is_expanded(spark, tmp_path):
    docs = spark.sql("select 'a' id, 't' text, map('x', '1', 'y', '2') metadata union all select 'b', 't', map('x', '3')")
    writers.write_documents(docs, f"{tmp_path}/m", expand_metadata=True, adapter=lambda d: d.filter("id <> 'z'"))
    rows = spark.read.parquet(f"{tmp_path}/m").orderBy("id").collect()
    assert [(r.x, r.y) for r in rows] == [("1", "2"), ("3", None)]


def test_scratch_is_removed(spark):
    with lineage.scratch(spark):
        path = lineage.scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_skip_alone(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) id", "'t' text").repartition(7).write.parquet(f"{tmp_path}/d")
    whole = [r.id for r in readers.read_documents(spark, f"{tmp_path}/d", skip=0, limit=1000).collect()]
    rest = readers.read_documents(spark, f"{tmp_path}/d", skip=300)
    assert [r.id for r in rest.collect()] == whole[300:]
    # One task sees the counts of the ranges, none the rows.
    plan = rest._jdf.queryExecution().analyzed().toString()
    assert "Offset" not in plan and "GlobalLimit" not in plan
    assert readers.read_documents(spark, f"{tmp_path}/d", skip=2000).isEmpty()


def test_broken_lines_are_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": "a", "text": "one"}\n{"id": "b"}\nno json\n')
    data = jobs.Dataset("d", f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/gone", "*.jsonl")
    stats = jobs.run_filter(spark, [data], [], "id string, text string").filter("dataset = 'd'").collect()
    assert {r.outcome: r.documents for r in stats} == {"kept": 1, "no_text": 1, "broken_record": 1, None: 3}
    assert spark.read.parquet(f"{tmp_path}/gone/rejected_by=broken_record").first()["_line"] == "no json"
    assert spark.read.parquet(f"{tmp_path}/out/filter_output").columns == ["id", "text", "token_count"]


def test_skip_and_limit_without_one_task(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id as string) id", "'t' text").repartition(9).write.parquet(f"{tmp_path}/d")
    whole = [r.id for r in readers.read_documents(spark, f"{tmp_path}/d", skip=0, limit=5000).collect()]
    assert len(whole) == 5000
    for skip, limit in [(0, 10), (1234, 1000), (4990, 100), (6000, 5), (0, 0)]:
        got = readers.read_documents(spark, f"{tmp_path}/d", skip=skip, limit=limit)
        assert [r.id for r in got.collect()] == whole[skip : skip + limit]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    by_id = readers.read_documents(spark, f"{tmp_path}/d", skip=100, limit=50, order_by=["id"])
    assert [r.id for r in by_id.collect()] == sorted(whole)[100:150]


def test_repairs_search_a_text_once_for_odd_signs(texts):
    given = texts("a\u0007b", "“q”", "é", "\x1b[31mred\x1b[0m", "﻿x", "“\u0007é”", "plain & <b>", "Ãå”")
    mended = repair_text(given)
    assert [r.text for r in mended.orderBy("doc_id").collect()] == ["ab", '"q"', "é", "red", "x", '"é"', "plain & <b>", 'Ãå"']
    plan = mended._jdf.queryExecution().optimizedPlan().toString()
    # Clean texts pass by the removal of controls and the change of quotes.
    assert "CASE WHEN RLIKE(text" in plan.split("translate(")[0].rsplit("explode(", 1)[1]
