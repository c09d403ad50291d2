"""Joins on keys of which a few may hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rows of one key that go to one place; a key with more is dealt into as many pieces as it needs.
HOT_ROWS = 100_000


def join_facts(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    weight: str,
    spread_by: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of many rows with one fact row per key, safe against any number of hot keys.

    ``weight`` is a column of ``facts`` with the number of rows a key has. Facts of a key with more than ``hot_rows``
    are repeated, once per ``hot_rows``, and the rows of the key are dealt over the copies. How many copies a key has
    is looked up in the heavy keys alone: each stands for ``hot_rows`` rows at least, so they are few against the rows,
    and the lookup is left to Spark, which broadcasts them below its limit and otherwise splits what is skewed. No
    place holds much more than ``hot_rows`` rows of a key. The weight is not part of the result.
    """
    values = [c for c in facts.columns if c not in (key, weight)]
    pieces = F.greatest(F.ceil(F.col(weight) / hot_rows), F.lit(1)).cast("int")
    heavy = facts.filter(F.col(weight) > hot_rows).select(F.col(key).alias("_heavy"), pieces.alias("_pieces"))
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_pieces")), F.lit(0)).cast("int")
    dealt = rows.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn("_salt", salt).drop("_heavy", "_pieces")
    copies = facts.select(key, *values, F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_salt"))
    return dealt.join(copies, [key, "_salt"]).select(*rows.columns, *values)
