"""Cleaning of wide tables: near-duplicate columns, column names, line breaks."""

from __future__ import annotations

from itertools import combinations
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Aggregates per pass over the table; more pairs take more passes.
PAIRS_PER_PASS = 300


def _positional(table: DataFrame) -> DataFrame:
    """The same table under the column names ``c0, c1, …``: names may repeat, positions not."""
    return table.toDF(*[f"c{i}" for i in range(len(table.columns))])


def _comparable(table: DataFrame) -> list[tuple[int, int]]:
    """Position pairs of columns of one type that knows equality, or of two numeric types."""
    types = [f.dataType for f in table.schema.fields]

    def numeric(kind: T.DataType) -> bool:
        return isinstance(kind, T.NumericType)

    return [
        (i, j)
        for i, j in combinations(range(len(types)), 2)
        if (types[i] == types[j] and _knows_equality(types[i])) or (numeric(types[i]) and numeric(types[j]))
    ]


def _knows_equality(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _knows_equality(kind.elementType)
    return not isinstance(kind, T.StructType) or all(_knows_equality(f.dataType) for f in kind.fields)


def _equal(table: DataFrame, i: int, j: int) -> Column:
    """Equality of two columns; NaN equals nothing."""
    same = F.col(f"c{i}") == F.col(f"c{j}")
    floating = isinstance(table.schema.fields[i].dataType, (T.FloatType, T.DoubleType))
    return same & ~F.isnan(f"c{i}") if floating else same


def column_pair_shares(table: DataFrame, pairs: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(left_pos, right_pos, equal_rows, total_rows) per column pair, all pairs in one pass.

    NULL equals nothing but counts as a row.
    """
    chosen = _comparable(table) if pairs is None else list(pairs)
    plain = _positional(table)
    parts = []
    for low in range(0, max(len(chosen), 1), PAIRS_PER_PASS):
        block = chosen[low : low + PAIRS_PER_PASS]
        counts = plain.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(_equal(plain, i, j)).alias(f"p{i}_{j}") for i, j in block],
        )
        entries = [
            F.struct(
                F.lit(i).alias("left_pos"),
                F.lit(j).alias("right_pos"),
                F.col(f"p{i}_{j}").alias("equal_rows"),
                F.col("total_rows"),
            )
            for i, j in block
        ]
        shape = "array<struct<left_pos:int,right_pos:int,equal_rows:bigint,total_rows:bigint>>"
        parts.append(counts.select(F.inline(F.array(*entries).cast(shape))))
    shares = parts[0]
    for part in parts[1:]:
        shares = shares.unionByName(part)
    return shares


def near_duplicate_columns(table: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Column pairs whose share of equal rows reaches ``threshold``:
    (left_pos, right_pos, left_col, right_col, equal_share). An empty table has none."""
    names = F.array(*[F.lit(c) for c in table.columns])
    equal = F.col("equal_rows").cast("double") / F.col("total_rows").cast("double")
    shares = column_pair_shares(table).filter(F.col("total_rows") > 0).withColumn("equal_share", equal)
    return shares.filter(F.col("equal_share") >= threshold).select(
        "left_pos",
        "right_pos",
        F.get(names, F.col("left_pos")).alias("left_col"),
        F.get(names, F.col("right_pos")).alias("right_col"),
        "equal_share",
    )


def unique_names(names: Iterable[str], seen: dict[str, int] | None = None) -> list[str]:
    """A repeated name gets a running number: ``a, a, a`` becomes ``a, a_1, a_2``.
    ``seen`` holds how often a name has been repeated so far, and is brought up to date."""
    repeats = {} if seen is None else seen
    out = []
    for name in names:
        repeats[name] = repeats.get(name, -1) + 1
        out.append(f"{name}_{repeats[name]}" if repeats[name] else name)
    return out


def drop_near_duplicate_columns(table: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Drop the second column of every near-duplicate pair. Which columns a result has
    must be known to plan it, so the pairs, one row each, come to the driver."""
    found = near_duplicate_columns(table, threshold).select("right_pos").distinct().collect()
    gone = {row["right_pos"] for row in found}
    stays = [i for i in range(len(table.columns)) if i not in gone]
    names = [table.columns[i] for i in stays]
    return _positional(table).select(*[f"c{i}" for i in stays]).toDF(*names)


def strip_newlines(table: DataFrame) -> DataFrame:
    """Remove line feeds from all string columns; NULL stays NULL."""
    strings = {f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)}
    quoted = {c: F.col(f"`{c}`") for c in table.columns}
    return table.select(
        *[F.translate(quoted[c], "\n", "").alias(c) if c in strings else quoted[c] for c in table.columns]
    )


def clean_table(table: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Unique column names, no near-duplicate columns, no line feeds."""
    named = table.toDF(*unique_names(table.columns))
    return strip_newlines(drop_near_duplicate_columns(named, threshold))
