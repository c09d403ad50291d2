"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from checks import compare
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    from checks.oracles import ORACLES

    if name not in ORACLES:
        assert QUERIES[name](spark, SMALL).count() > 0
        return
    assert compare.difference(spark, db, QUERIES[name], ORACLES[name], SMALL) is None


def test_stop_words_of_the_oracle(spark):
    from checks.oracles import english_stop_words
    from tekstmill.functions.text import stop_words

    assert sorted(english_stop_words()) == sorted(stop_words("en"))


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
