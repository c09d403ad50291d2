"""Sentence cuts with abbreviations learned from the corpus."""

import pytest

from tekstmill.operators import sentences

ABBREVIATED = " Prisen er 3.5 kr. kl. 12 i dag, bl.a. det nye."


@pytest.fixture(scope="module")
def corpus(spark):
    base = [
        "Det var en god dag. Solen skinnede! Var det varmt? Ja.",
        "Han kom hjem sent. Hun sov allerede.",
        "Mødet starter nu. Alle er her.",
    ]
    rows = [(i, base[i % 3] + ABBREVIATED) for i in range(60)] + [(100, None), (101, ""), (102, "...")]
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_learned_types(corpus):
    found = {r.type for r in sentences.learn_abbreviations(corpus).collect()}
    assert {"kr", "kl", "bl.a"} <= found
    # Words that only end sentences are followed by capitals, and are no abbreviations.
    assert not {"dag", "hjem", "nu", "varmt", "sent", "nye"} & found


def test_numbers_and_abbreviations_are_not_cut(corpus):
    table = sentences.learn_abbreviations(corpus)
    rows = {r.doc_id: r.sentences for r in sentences.learned_sentences(corpus, table).collect()}
    assert rows[0] == ["Det var en god dag. ", "Solen skinnede! ", "Var det varmt? ", "Ja. ", "Prisen er 3.5 kr. kl. 12 i dag, bl.a. det nye."]
    assert rows[100] == [] and rows[101] == [] and rows[102] == ["..."]


def test_join_path_equals_literal_path(corpus):
    table = sentences.learn_abbreviations(corpus)
    literal = {r.doc_id: r.sentences for r in sentences.learned_sentences(corpus, table).collect()}
    joined = {r.doc_id: r.sentences for r in sentences.learned_sentences(corpus, table, literal_rows=0).collect()}
    assert literal == joined


def test_pieces_join_to_the_text(corpus):
    table = sentences.learn_abbreviations(corpus)
    for r in sentences.learned_sentences(corpus, table).collect():
        assert "".join(r.sentences) == (r.text or "")


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert sentences.learn_abbreviations(empty).count() == 0
    assert sentences.learned_sentences(empty, sentences.learn_abbreviations(empty)).count() == 0


def test_exploded_sentences_are_cut_once(spark, corpus):
    cut = sentences.learned_sentences(corpus, sentences.learn_abbreviations(corpus)).selectExpr("doc_id", "explode(sentences) as s")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    # Tokens and sentences: one search each.
    assert plan.count("regexp_extract_all(") == 2
