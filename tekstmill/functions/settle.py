"""Columns that are computed once, whatever is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def settle(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column whose expression is not to be repeated.

    The optimizer copies the expression of a column into every filter that it pushes
    below a projection, and into the one projection it makes of all those between two
    Arrow functions. A verdict built on a whole text would so be computed twice, and a
    chain of verdicts many times. Neither happens across a generator, so the value
    passes through one that makes one row out of one.
    """
    columns = df.columns if name in df.columns else [*df.columns, name]
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).select(*columns)
