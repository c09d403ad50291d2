"""The n-gram language model: posteriors, the background class and held-out accuracy."""

import hashlib
import math

import pytest

from tekstmill.functions import language_model

TRAIN = {
    "da": "jeg er glad for at være her og det er en god dag i dag hvor solen skinner over byen og havet",
    "no": "jeg er glad for å være her og det er en god dag i dag hvor solen skinner over byen og havet ikke",
    "en": "the quick brown fox jumps over the lazy dog while the sun is shining over the city and the sea",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text, lang) for i, (lang, text) in enumerate(TRAIN.items())] * 200 + [(99, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    return language_model.LanguageModel(language_model.learn_counts(docs, buckets=1 << 12), buckets=1 << 12)


def test_posteriors_sum_to_one_and_pick_the_language(spark, model):
    docs = spark.createDataFrame(
        [(1, "the dog is lazy and the fox is quick"), (2, "det er en god dag"), (3, None), (4, "123 !!")],
        "doc_id int, text string",
    )
    rows = {r.doc_id: r for r in language_model.score_languages(docs, model).collect()}
    assert rows[1].language == "en" and rows[1].language_prob > 0.9
    assert rows[2].language in ("da", "no")
    assert rows[3].language is None and rows[3].language_prob is None
    assert rows[4].language is None


def test_log_probabilities_are_normalised(model):
    for row in model.log_probs:
        assert math.isclose(sum(math.exp(x) for x in row), 1.0, rel_tol=1e-9)
    assert model.labels[-1] == language_model.BACKGROUND


def test_buckets_agree_with_spark(spark):
    from pyspark.sql import functions as F

    grams = [" ab", "abc", "bc ", "é ø"]
    got = spark.createDataFrame([(g,) for g in grams], "g string").select(language_model.bucket_of(F.col("g"), 1 << 12).alias("b"))
    expected = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % (1 << 12) for g in grams]
    assert [r.b for r in got.collect()] == expected
    assert language_model.gram_buckets("ab", 1 << 12) == [expected[0], int(hashlib.md5(b"ab ").hexdigest()[:8], 16) % (1 << 12)]


def test_model_size_is_checked(spark):
    docs = spark.createDataFrame([(1, "abc", "x")], "doc_id int, text string, lang string")
    with pytest.raises(ValueError):
        language_model.LanguageModel(language_model.learn_counts(docs, buckets=1 << 12), buckets=1 << 12, max_model_bytes=100)
