from collections import Counter

import pytest
from pyspark.sql import functions as F

from tekstmill.functions import language
from tekstmill.functions.text import stop_words, words
from tekstmill.operators import chain, filters

LONG = """Der var engang en fattig mand, som boede i et lille hus ved skoven.
Om morgenen gik han ud for at hente brænde til ovnen.
Hans kone blev hjemme og passede deres to små børn.
Men en dag kom der en fremmed forbi, og alt blev anderledes.
Han ville købe huset og betale dem med guld fra bjergene.
De talte længe om tilbuddet, fordi ingen af dem havde set så mange penge før.
Til sidst sagde de nej tak, for hvor skulle de ellers bo?"""


def reasons(df):
    return [r.reason for r in df.orderBy("doc_id").collect()]


def vary(n, size=4):
    """n different words of one length."""
    letters = "abcdefghijklmnopqrst"
    return [letters[i // 8000 % 20] + letters[i // 400 % 20] + letters[i // 20 % 20] + letters[i % 20] + "x" * (size - 4) for i in range(n)]


def test_quality_thresholds(texts):
    kw = {"stop_word_list": ["den", "det"]}
    stops = ["den", "det"]
    def text(n, size=4, extra=""):
        return " ".join(vary(n, size) + stops) + extra
    cases = [
        (text(48), None),
        (text(47), "too_few_words"),
        (text(100), None),
        (" ".join(["ab"] * 60 + stops), "short_words"),
        (text(100, 10), None),
        (text(100, 11), "long_words"),
        (text(98, extra=" #" * 10), None),
        (text(98, extra=" #" * 11), "too_many_hashes"),
        (text(98, extra=" ..." * 11), "too_many_ellipses"),
        ("\n".join("- " + w for w in vary(58) + stops), "too_many_bullets"),
        ("\n".join([" ".join(vary(60)) + "...", "den det.", "x."]), "too_many_ellipsis_lines"),
        (" ".join(vary(58) + stops + ["1234"] * 15), None),
        (" ".join(vary(58) + stops + ["1234"] * 16), "too_few_alpha_words"),
        (" ".join(vary(60) + ["den", "den"]), "too_few_stop_words"),
        ("", "too_few_words"),
        (None, None),
    ]
    assert reasons(filters.quality_filter(texts(*[c[0] for c in cases]), **kw)) == [c[1] for c in cases]
    assert reasons(filters.quality_filter(texts(text(100)), max_words=101, **kw)) == ["too_many_words"]


def test_line_clean(texts):
    five = "\n".join(f"This is line {w}." for w in "abcde")
    cases = [
        (five, None, five),
        (five[:-1], "too_few_sentences", None),
        (five + "\nToo short.", None, five),
        (five + "\nPlease enable javascript now.", None, five),
        (five + "\nRead our Privacy Policy now.", None, five),
        (five + "\nThis goes on...", None, five),
        (five + "\nNo closing mark here", None, five),
        (five + "\nSee this note[12] here.", None, five + "\nSee this note here."),
        (five + "\nA " + "x" * 1001 + " is here.", None, five),
        (five + " {", "curly_bracket", None),
        (five + "\nLorem Ipsum dolor.", "lorem_ipsum", None),
    ]
    out = filters.line_clean_filter(texts(*[c[0] for c in cases])).orderBy("doc_id").collect()
    assert [r.reason for r in out] == [c[1] for c in cases]
    assert all(r.text == c[2] for r, c in zip(out, cases) if c[2])


def test_line_structure(texts):
    def rows(ended, open_, length=40):
        return "\n".join([f"{i:02d}" + "a" * (length - 3) + "." for i in range(ended)] + [f"{i:02d}" + "b" * (length - 2) for i in range(open_)])
    cases = [
        (rows(12, 88), "few_line_ends"),
        (rows(13, 87), None),
        (rows(33, 0, 40) + "\n" + "\n".join(f"s{i}." for i in range(67)), "short_lines"),
        (rows(34, 0, 40) + "\n" + "\n".join(f"s{i}." for i in range(66)), None),
        ("\n".join(["c" * 39 + "."] * 2 + [f"{i}" + "d" * 38 + "." for i in range(7)]), "dup_line_chars"),
        ("", "no_lines"),
        (None, None),
    ]
    assert reasons(filters.line_structure_filter(texts(*[c[0] for c in cases]))) == [c[1] for c in cases]


def test_repetition_lines(texts):
    distinct = [f"w{i} line" for i in range(10)]
    cases = [
        ("\n\n".join(["same", "same", "b", "c"]), None, "dup_paragraph_char_share"),
        ("\n".join(["x"] * 5 + distinct[:7]), None, "dup_line_share"),
    ]
    out = filters.repetition_filter(texts(*[c[0] for c in cases]))
    assert reasons(out) == [c[2] for c in cases]


def brute_ngrams(tokens, n):
    grams = [tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)]
    counts = Counter(grams)
    top = max(((c, len(" ".join(g))) for g, c in counts.items()), default=(0, 0))
    covered = set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update(range(i, i + n))
    return top[0] * top[1], sum(len(tokens[i]) for i in covered)


def test_ngrams_against_brute_force(spark, texts):
    import random

    draw = random.Random(3)
    rows = [" ".join(draw.choice(["a", "bb", "ccc", "øøøø"]) for _ in range(draw.randrange(0, 60))) for _ in range(60)]
    rows += ["", None, "one", "a b c d e f " * 20]
    from tekstmill.functions.ngrams import repeated_ngram_chars

    counted = texts(*rows).select("doc_id", repeated_ngram_chars(words(F.col("text")), [2, 3, 4], [5, 6, 7, 8, 9, 10]).alias("g"))
    for row in counted.collect():
        tokens = (rows[row.doc_id] or "").split()
        for n in range(2, 11):
            top, dup = brute_ngrams(tokens, n)
            assert row.g[f"top_{n}" if n < 5 else f"dup_{n}"] == (top if n < 5 else dup), (row.doc_id, n)


def test_language(spark, texts):
    danish = "det er ikke noget som helst men vi har ikke været her før og det skal være godt for alle"
    english = "this is not what they have been doing with their own things because of the other ones"
    with pytest.raises(ValueError, match="profiles"):
        filters.language_filter(texts(danish), ["da"])
    profiles = language.stop_word_profiles()
    docs = filters.language_filter(texts(danish, english, "12 34", None), ["da"], profiles, min_score=0.5)
    rows = docs.orderBy("doc_id").collect()
    assert rows[0].language == "da" and rows[1].language == "en" and rows[2].language is None
    assert [r.reason for r in rows] == [None, "other_language", "other_language", None]
    labels = filters.language_filter(texts(danish, english), ["da"], profiles, label_only=True)
    assert reasons(labels) == [None, None]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = language.learn_profiles(docs.filter("doc_id % 2 = 0"))
    profiles = language.load_profiles(learned, ["en", "de", "fr", "es"])
    scored = language.score_language(docs.filter("doc_id % 2 = 1"), profiles)
    right = scored.agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97


def run_chain(docs, **options):
    options = {"profiles": language.stop_word_profiles(), "language_options": {"min_score": 0.5}} | options
    return chain.apply_chain(docs, chain.default_steps(**options))


def test_chain_order_and_texts(texts):
    english = "this is not what they have been doing with their own things because of the other ones. " * 3
    docs = texts(LONG, english, "\n".join(LONG.split("\n")[:3]), LONG.replace(".", "").replace("?", ""))
    out = run_chain(docs).orderBy("doc_id").collect()
    assert [r.rejected_by for r in out] == [None, "non_danish_documents", "gopher_quality", "c4_quality"]
    assert out[0].token_count > 0 and out[1].token_count is None
    assert out[0].text == LONG


def test_chain_does_not_shuffle_or_repeat_work(texts):
    out = run_chain(texts(LONG)).filter(F.col("rejected_by").isNull())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # References, misread runs, normal form, language, n-grams.
    assert plan.count("ArrowEvalPython") == 5
    assert plan.count(r"regexp_extract_all(lower(") == 1


def test_chain_keeps_every_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    out = run_chain(docs, languages=["en"], stop_word_list=stop_words("en"))
    assert out.count() == docs.count()
    assert out.select("doc_id").distinct().count() == docs.count()


def test_statistics(texts):
    docs = run_chain(texts(LONG, "hello there")).withColumn("dataset", F.lit("a"))
    rows = {(r.dataset, r.outcome): r.documents for r in chain.outcome_stats(docs).collect()}
    assert rows[(None, None)] == 2 and rows[("a", None)] == 2 and rows[("a", "kept")] == 1


@pytest.mark.parametrize("pattern, n", [(r"\S+", 3), (None, 5)])
def test_token_count(texts, pattern, n):
    kw = {"pattern": pattern} if pattern else {}
    assert filters.token_count(texts("Hej, du der."), **kw).first().token_count == n


def test_batch_parts_are_whole_and_bounded():
    import pyarrow as pa

    from tekstmill.functions.batches import parts

    lists = [["a"] * n for n in (0, 3, 1, 9, 2, 2, 0)] + [None, ["a"]]
    batch = pa.array(lists, pa.list_(pa.string()))
    cut = list(parts(batch, 4))
    assert [x for part in cut for x in part.to_pylist()] == lists and len(cut) > 2
    assert [len(p) for p in parts(batch[:0], 4)] == [0]
