"""Every operator on NULLs, empty and long texts, repeated rows, ties, empty tables and columns with clashing names."""

import itertools

import pytest

import public_tokenizers
from tekstmill.llm import bpe, edit_prints, forest, mixing, nn_descent, quality, token_files, toxicity, warc, wrapper

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
LONG = " ".join(WORDS[i * i % 10] + str(i % 977) for i in range(30_000))
DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, Score double, predicted string, size int,"
    " copies string, token_ids string, class string, kept string, decoded int, fingerprint int, place int, part string"
)
EXTRAS = (0.5, "p", 1, "c", "t", "k", "x", 7, 8, 9, "q")


def rows_of(*pairs):
    sources = itertools.cycle(["a", "b", None])
    return [(i, t, "en", next(sources), None, *EXTRAS) for i, t in pairs]


@pytest.fixture(scope="module")
def docs(spark):
    near = " ".join(f"word{i}" for i in range(60))
    pairs = [
        (1, ""), (2, None), (3, "a b c"), (3, "a b c"), (None, "no id at all here"), (5, LONG), (6, LONG), (7, near),
        (8, near + " more"), (8, "the same id again"), (9, "!!! ???"), (10, "ÆØÅ \u0000 🙂 é"), (None, None),
    ]
    return spark.createDataFrame(rows_of(*pairs), DOC_SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, 0), (None, 1, 1), (7, 1, 0), (8, 7, 1), (9, 0, 0), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_bpe(docs, nothing):
    coded = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE)
    assert [c for c in coded.columns if c == "token_ids"] == ["token_ids"] and "source" in coded.columns
    rows = coded.collect()
    assert len(rows) == 13 and all(r["token_ids"] == [] and r["decoded"] == "" for r in rows if not r["text"])
    assert {len(r["token_ids"]) for r in rows if r["text"] == LONG} == {len(bpe.load(WORD_BPE).encode(LONG))}
    assert bpe.encode_documents(nothing, WORD_BPE).count() == 0


def test_toxicity(docs, nothing, labels):
    lexicon = toxicity.learn_lexicon(docs, labels)
    scored = toxicity.score_toxicity(docs, lexicon)
    rows = scored.collect()
    assert len(rows) == 13 and all(0 <= r["score"] <= 1 for r in rows)
    assert [c.lower() for c in scored.columns].count("score") == 1
    assert toxicity.score_toxicity(nothing, toxicity.learn_lexicon(nothing, labels)).count() == 0
    assert toxicity.learn_lexicon(docs, labels.limit(0)).weights == {}


def test_quality(docs, nothing, labels):
    model = quality.learn_classifier(docs, labels)
    rows = quality.score_quality(docs, model, "source", "lang").collect()
    assert len(rows) == 13 and all(0 <= r["quality_score"] <= 1 and isinstance(r["kept"], bool) for r in rows)
    assert quality.score_quality(nothing, model, "source", "lang").count() == 0
    assert quality.learn_classifier(nothing, labels).weights.any() == False  # noqa: E712


def test_mixing(docs, nothing):
    rows = mixing.plan_mix(docs).collect()
    assert len(rows) == 13 and all(r["size"] == 0 for r in rows if not r["text"])
    assert all(0 <= r["copies"] <= 3 for r in rows)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.plan_mix(nothing).count() == 0 and mixing.mix_sources(nothing).count() == 0
    silent = docs.filter("text is null or text = ''")
    assert {(r["target"], r["copies"]) for r in mixing.plan_mix(silent).collect()} == {(0.0, 0)}


def test_forest(docs, nothing):
    rows = forest.join_near_duplicates(docs).collect()
    assert len(rows) == 13
    classes = {(r["doc_id"], r["class_id"]) for r in rows}
    assert {(3, 3), (5, 5), (6, 5), (7, 7), (8, 7), (8, 8), (2, 1), (1, 1), (None, 1), (None, None)} <= classes
    assert sorted(r["n_links"] for r in rows if r["doc_id"] == 3) == [1, 1]
    kept = forest.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (i is None, i or 0) for i in [1, 3, None, 5, 7, 8, 9, 10]
    )
    assert forest.join_near_duplicates(nothing).count() == 0 and forest.drop_near_duplicates(nothing).count() == 0


def test_token_files(docs, nothing, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    read = lambda d: token_files.read_tokens(token_files.write_tokens(d, folder, BYTE_BPE), folder, [("ids_crc32", "bigint")], token_files._crc)
    rows = sorted(read(docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 3, 5, 6, 7, 8, 8, 9, 10]
    starts = list(itertools.accumulate((r["n_tokens"] for r in rows), initial=0))
    assert [r["start"] for r in rows] == starts[:-1]
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert read(nothing).count() == 0


def test_edit_prints(docs, nothing):
    rows = edit_prints.fingerprint_documents(docs).collect()
    assert len(rows) == 13
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"0:"}
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (5, 6)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    classes = {r["fingerprint"]: r["class_id"] for r in edit_prints.near_classes(edit_prints.fingerprint_documents(docs)).collect()}
    assert classes[edit_prints.fingerprint(LONG)] == 5
    assert edit_prints.fingerprint_documents(nothing).count() == 0
    one = edit_prints.fingerprint_documents(docs.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def pages_of(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "k", "t") for r in rows], "page_id bigint, url string, html string, size int, key string, text string"
    )


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://h.example/a", "<p>one</p>"), (2, "http://h.example/a", "<p>one</p>"), (3, None, None), (4, "nonsense", ""),
        (None, "http://h.example/b c", "<p>two</p>"), (5, "http://h.example/a", "<p>one</p>"), (5, "http://h.example/a", "<p>one</p>"),
        (6, "http://h.example/long", "<article>" + "<p>x &amp; y" * 20_000), (7, "http://H.example:80/?q=1", "ÆØÅ"),
    ]
    return pages_of(spark, rows)


def test_wrapper(pages, spark):
    rows = {r["page_id"]: r for r in wrapper.extract_pages(pages).collect()}
    assert wrapper.extract_pages(pages).count() == 9
    assert rows[1]["text"] == "one" and rows[3]["text"] == rows[4]["text"] == "" and rows[7]["text"] == "ÆØÅ"
    assert rows[6]["text"] == " ".join(["x & y"] * 20_000) and rows[6]["n_chars"] == len(rows[6]["text"])
    assert wrapper.extract_pages(pages_of(spark, [])).count() == 0


def test_warc(pages, spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    read = lambda p: warc.read_captures(warc.merge_runs(warc.write_archives(p, folder), range_entries=3), folder)
    rows = read(pages).collect()
    found = sorted(((r["page_id"] is None, r["page_id"] or 0), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows)
    long = len(pages.filter("page_id = 6").first()["html"])
    assert found == [
        ((False, 1), "response", None, 10), ((False, 2), "revisit", 1, 10), ((False, 3), "response", None, 0),
        ((False, 4), "revisit", 3, 0), ((False, 5), "revisit", 1, 10), ((False, 5), "revisit", 1, 10),
        ((False, 6), "response", None, long), ((False, 7), "response", None, 6), ((True, 0), "response", None, 10),
    ]
    assert sorted(r["position"] for r in rows) == list(range(9))
    assert [r["url_key"] for r in sorted(rows, key=lambda r: r["position"])] == sorted(r["url_key"] for r in rows)
    assert read(pages_of(spark, [])).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []),
        (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [None, 1.0]), (None, [0.0, 2.0]), (12, [-1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, 0, "k") for r in rows], "vec_id bigint, embedding array<float>, node int, kept string")
    found = nn_descent.near_duplicate_vectors(table).collect()
    answers = sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["n_links"], r["component_id"], r["kept"]) for r in found)
    assert answers == [
        ((False, 1), 3, 1, True), ((False, 2), 3, 1, False), ((False, 3), 1, 3, True), ((False, 4), 0, 4, True),
        ((False, 5), 0, 5, True), ((False, 6), 0, 6, True), ((False, 7), 0, 7, True), ((False, 8), 0, 8, True),
        ((False, 9), 3, 1, False), ((False, 9), 3, 1, False), ((False, 10), 0, 10, True), ((False, 11), 0, 11, True),
        ((False, 12), 0, 12, True), ((True, 0), 1, 3, False),
    ]
    assert nn_descent.near_duplicate_vectors(table.limit(0)).count() == 0


def test_warc_dates_and_huge_ids(spark, tmp_path):
    import datetime
    import random

    from pyspark.sql import functions as F

    random.seed(2)
    for seconds in [0, 1_704_067_200, *[random.randint(-30610224000, 253402300799) for _ in range(2000)]]:
        expected = datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        assert warc.warc_date(seconds) == expected
    assert warc.warc_date(2**63 - 1).endswith("Z") and warc.warc_date(-(2**63)).endswith("Z")
    pages = spark.createDataFrame(
        [(2**63 - 1, "http://a.example/x", "<p>same</p>"), (300_000_000_000, "http://b.example/y", "<p>same</p>"),
         (10**15, "http://c.example/z", None)],
        "page_id bigint, url string, html string",
    )
    offset = F.pmod(F.col("page_id"), F.lit(warc.CENTURY_SECONDS))
    folder = str(tmp_path / "warc")
    index = warc.merge_runs(warc.write_archives(pages, folder, time=F.timestamp_seconds(F.lit(1_704_067_200) + offset)))
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_captures(index, folder).collect()}
    assert got == {300_000_000_000: ("response", None), 2**63 - 1: ("revisit", 300_000_000_000), 10**15: ("response", None)}


def test_vectors_at_extremes_link(spark):
    rows = [(1, [1e200, 0.0]), (2, [2e200, 0.0]), (3, [1e-200, 0.0]), (4, [2e-200, 0.0]), (5, [0.0, 1e-300]), (6, [0.0, 3e-300])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicate_vectors(vectors, vector="vector").collect()}
    assert got[1] == got[2] == (3, 1) and got[3] == got[4] == (3, 1)
    assert got[5] == got[6] == (1, 5)


def test_wrapper_deep_and_broken_pages():
    import time

    pages = {
        "<html><body>" + "<div>" * 100_000 + "deep text" + "</div>" * 100_000 + "<article><p>Main text.</p></article></body></html>": "Main text.",
        "<html><body><article><p>Start</p>" + "<a b " * 200_000 + "</article></body></html>": "Start",
        "<p>x</p>" + "<a b " * 200_000: None,
        "<p>kept</p><!-- never closed <p>gone</p>": "kept",
    }
    for page, expected in pages.items():
        began = time.perf_counter()
        text = wrapper.main_text(wrapper.parse(page))
        assert time.perf_counter() - began < 10
        if expected is not None:
            assert text == expected
        else:
            assert text.startswith("x <a b <a b") and len(text) > 900_000


def test_toxicity_contexts_take_whole_words(spark):
    long_word = "scum" + "x" * 1000
    train = spark.createDataFrame([(f"you {long_word} {'y' * 500} again", 1), ("plain words here", 0)], "text string, y int")
    rows = toxicity._contexts(train, ["scum"]).collect()
    assert [(r.word, r.next) for r in rows] == [(long_word, "y" * 500)]
