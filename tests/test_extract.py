import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tekstmill.functions import extract
from tekstmill.functions.repair import repair_text
from tekstmill.operators import crawl, extraction
from tekstmill.plans import jobs
from tekstmill.sources import readers

NOW = datetime(2024, 5, 1, 12, 0, 0)


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "link, target",
    [
        ("https://safelink.example.com?foo=bar&url=http%3A%2F%2Fexample.com", "http://example.com"),
        ("https://safelink.example.com", None),
        ("https://safelink.example.com?url=http%3A%2F%2Fexample.com", None),
        ("https://safelink.example.com?invalidparam&url=http%3A%2F%2Fexample.com", None),
        ("https://s.example.com?url=a%20b+c&odd", "a b+c"),
        ("https://s.example.com?a=b=c&url=x", None),
        ("https://s.example.com?url=a=b&c=d", None),
        ("https://s.example.com?a=b&c=d", None),
        ("https://s.example.com?a=b&url=100%&x=y", "100%"),
        ("https://s.example.com?a=b&url=%41%zz&x=y", "A%zz"),
        ("https://s.example.com?x?a=b&url=q", "q"),
    ],
)
def test_unwrap_url(spark, link, target):
    assert one(spark, link, extract.unwrap_url) == target


def test_mail_body(spark):
    body = "Hello\n\n\nWorld\n[test]\nhttp://link?a=b&url=decoded_url"
    assert one(spark, body, extract.clean_mail_body) == "Hello\nWorld\n\ndecoded_url"
    body = "a <http://x.example> b\r\n[open\nend] <https://s.example?a=b&url=y> c"
    assert one(spark, body, extract.clean_mail_body) == "a <http://x.example> b\n[open\nend] <y> c"


def test_html_and_newlines(spark):
    assert one(spark, "<html><body>Test</body></html>", extract.html_to_text) == "Test"
    page = "<head><title>no</title></head><nav>no</nav><p>A &amp;lt; B</p><!-- no --><p>C<br>D</p><script>no</script>"
    assert one(spark, page, extract.html_to_text) == "A &lt; B\nC\nD"
    assert one(spark, "<p> </p>", extract.html_to_text) is None
    assert one(spark, "Line1\n\n\nLine2", extract.collapse_newlines) == "Line1\nLine2"


def test_metadata_and_id(spark):
    row = spark.sql("select '/a/b/file.tar.gz' p, 11L n")
    m = row.select(extract.file_metadata(F.col("p"), F.col("n")).alias("m")).first().m
    assert m.asDict() == {
        "filename": "file.tar.gz", "filetype": ".tar.gz", "filesize": 11, "page_count": 0, "file_path": "/a/b/file.tar.gz"
    }
    stream = row.select(extract.file_metadata(F.col("p"), F.col("n"), stream=True).alias("m")).first().m
    assert stream.filetype == "gz"
    assert one(spark, "test.pdf", lambda v: extract.record_id(F.lit("Test"), v)) == "Test-test.pdf"
    assert one(spark, "my file.pdf", lambda v: extract.record_id(F.lit("A B"), v)) == "A-B-my-file.pdf"
    assert one(spark, "/x/.hidden", lambda v: extract.file_metadata(v, F.lit(1)).filetype) == ""


@pytest.mark.parametrize(
    "value, path, found",
    [
        ({"text": "Hello world"}, "text", ["Hello world"]),
        ({"other": "x"}, "missing", []),
        ({"a": [{"b": "1"}, {"b": "2"}]}, "a,b", ["1", "2"]),
        ({"a": [[{"b": ["1", "2"]}], [{"b": ["3"]}]]}, "a,b", ["1", "2", "3"]),
        ({"a": {"b": {"c": 1}}}, "a,b", ['{"c":1}']),
        ({"a": 5}, "a", ["5"]),
        ({"a": "text"}, "a,b", []),
    ],
)
def test_json_path(spark, value, path, found):
    text = json.dumps(value)
    shape = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    from pyspark.sql.types import StructType

    shape = StructType.fromDDL(shape[len("STRUCT<"):-1])
    assert one(spark, text, lambda v: extract.json_path_texts(v, shape, path)) == found
    assert one(spark, "{broken", lambda v: extract.json_path_texts(v, shape, path)) == []


def test_repair(spark, texts):
    broken = "FÃ¦rgen â€œkÃ¸rerâ€\x9d ikke\x00\x1b[31m, café &amp; bar"
    fixed = repair_text(texts(broken, "<b>&amp;</b>", "plain", None)).orderBy("doc_id").collect()
    assert [r.text for r in fixed] == ['Færgen "kører" ikke, café & bar', "<b>&amp;</b>", "plain", None]
    raw = repair_text(texts("“a”"), quotes=False, unicode_form=None).first().text
    assert raw == "“a”"


def test_crawl(spark):
    log = spark.createDataFrame([("-- some /dummy/data",), ("-- x http://h.example/a",), ("no",), ("-- a b",), ("--",)], "value string")
    assert sorted(r.host for r in crawl.crawl_hosts(log).collect()) == ["data", "h.example"]
    assert one(spark, "file:/root/h/x/f.txt", lambda p: crawl.top_folder(p, "/root")) == "h"
    assert one(spark, "file:/root/f.txt", lambda p: crawl.top_folder(p, "/root")) is None


def make_tree(root):
    (root / "h.example" / "deep").mkdir(parents=True)
    (root / "other").mkdir()
    (root / "h.example" / "a.txt").write_text("A\n\n\nB")
    (root / "h.example" / "deep" / "b.html").write_text("<html><body>Test</body></html>")
    (root / "h.example" / "empty.html").write_text("<html></html>")
    (root / "h.example" / "c.json").write_text(json.dumps([{"text": "one"}, {"text": "two"}]))
    (root / "h.example" / "broken.json").write_text("{")
    (root / "h.example" / "d.unknown").write_text("?")
    (root / "h.example" / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    (root / "other" / "e.md").write_text("other")


def test_process_directory(spark, tmp_path, caplog):
    make_tree(tmp_path / "in")
    written = jobs.process_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), "client x", now=NOW)
    assert written == f"{tmp_path}/out/client x.jsonl.gz"
    rows = spark.read.schema(extract.RECORD_SCHEMA).json(written).collect()
    assert sorted(r.text for r in rows) == ["A\nB", "Test", "one", "other", "two"]
    record = next(r for r in rows if r.text == "Test")
    assert record.id == "client-x-b.html" and record.metadata.filetype == ".html" and record.metadata.filesize > 0
    assert record.created == "2000-01-01 00:00:00, 2024-05-01 12:00:00"
    assert "Unsupported" in caplog.text


def test_process_directory_json_path(spark, tmp_path, caplog):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.json").write_text(json.dumps([{"doc_1": {"text": "<p>Hello World</p>"}}]))
    out = jobs.process_directory(
        spark, str(tmp_path / "in"), str(tmp_path / "o.jsonl.gz"), "s", key_paths="doc_1,text", text_format="html", now=NOW
    )
    assert out.endswith("/o.jsonl.gz")
    assert [r.text for r in spark.read.json(out).collect()] == ["Hello World"]
    files = readers.list_files(spark, str(tmp_path / "in"))
    none = extraction.extract_folders(spark, [str(tmp_path / "in")], files, "s", "now", "missing")
    assert none.count() == 0 and "not found" in caplog.text


def test_empty_directory(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.process_directory(spark, str(tmp_path), str(tmp_path / "out"), "s")


def test_process_web_crawl(spark, tmp_path):
    make_tree(tmp_path / "in")
    log = tmp_path / "crawl.log"
    log.write_text("--2024-- 12:00 http://h.example/x\n--2024-- 12:00 http://gone.example/x\nother\n")
    out = jobs.process_web_crawl(spark, str(log), str(tmp_path / "out"), str(tmp_path / "in"), "s", now=NOW)
    assert sorted(r.text for r in spark.read.json(out).collect()) == ["A\nB", "Test", "one", "two"]
    log.write_text("nothing\n")
    with pytest.raises(ValueError):
        jobs.process_web_crawl(spark, str(log), str(tmp_path / "out2"), str(tmp_path / "in"), "s")
    log.write_text("-- x http://gone.example/x\n")
    with pytest.raises(ValueError):
        jobs.process_web_crawl(spark, str(log), str(tmp_path / "out3"), str(tmp_path / "in"), "s")


def test_main_text_without_landmarks(spark):
    from pyspark.sql import functions as F

    from tekstmill.functions.extract import main_text

    menu = '<div class="menu"><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></div>'
    body = "<div><h1>A title here</h1><div><p>The first paragraph of the story, with words in it.</p>" \
        "<p>A second one, long enough to count as text &amp; more.</p></div></div>"
    related = '<div class="links"><a href="/x">Related one</a> <a href="/y">Related two</a></div>'
    pages = [(1, f"<html><body>{menu}{body}{related}</body></html>"), (2, None), (3, ""), (4, '<a href="/">only links</a>')]
    df = spark.createDataFrame(pages, "id int, html string")
    got = {r.id: r.t for r in main_text(df, "html", "t").collect()}
    assert got[1] == "A title here\nThe first paragraph of the story, with words in it.\nA second one, long enough to count as text & more."
    assert got[2] is None and got[3] is None and got[4] is None


def test_best_run_equals_brute_force(spark):
    import random

    from pyspark.sql import functions as F

    from tekstmill.functions.extract import best_run

    random.seed(3)
    arrays = [[random.randint(-5, 5) for _ in range(random.randint(1, 12))] for _ in range(300)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, a array<int>")
    for r in df.select("id", best_run(F.col("a")).alias("r")).collect():
        a = arrays[r.id]
        pairs = [(sum(a[i:j + 1]), -j, -i) for j in range(len(a)) for i in range(j + 1)]
        total, j, i = max(pairs)
        assert (r.r.best, r.r.first, r.r.last) == (total, -i + 1, -j + 1)
