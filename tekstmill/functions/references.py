"""HTML character references, named and numeric."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

REFERENCE = re.compile(r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


def decode_text(text: str) -> str:
    """Every reference that ends with its semicolon, in one pass: what a reference stands for is not decoded again.
    A no-break space becomes a blank."""
    if "&" not in text:
        return text
    return REFERENCE.sub(lambda m: html.unescape(m[0]).replace("\xa0", " "), text)


def decode_references(text: Column) -> Column:
    """The same for a column, in Arrow batches: the names are a table of over two thousand."""

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else decode_text(t) for t in batch.to_pylist()], pa.string())

    return decode(text)
