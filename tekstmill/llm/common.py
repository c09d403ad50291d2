"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tekstmill.plans.lineage import cut_lineage, scratch_path

__all__ = [
    "append_columns", "cut_lineage", "map_texts", "open_store", "read_table", "scratch_path", "text_or_empty", "token",
]

# Bytes of text that a Python worker handles at a time.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def token() -> str:
    """A part of a file name that no other attempt of a task uses."""
    return uuid.uuid4().hex[:12]


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def slices(batch: pa.RecordBatch, column: str | int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Whole rows of a batch, about ``most`` bytes of one column at a time."""
    if batch.num_rows == 0:
        return
    if batch.nbytes <= most:
        yield batch
        return
    size, low = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        size += n or 0
        if size >= most:
            yield batch.slice(low, i + 1 - low)
            size, low = 0, i + 1
    if low < batch.num_rows:
        yield batch.slice(low)


def _mapped(
    passed: DataFrame, kept: int, at: int, make: Callable[[], Callable[[list[str]], list[pa.Array]]],
    fields: list[tuple[str, str]], most: int,
) -> DataFrame:
    """The first ``kept`` columns of ``passed``, and the new ones from the texts of its column number ``at``."""
    added = [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields]
    schema = T.StructType([*passed.schema.fields[:kept], *added])
    names = [f.name for f in schema.fields]
    types = [to_arrow_type(f.dataType) for f in added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole in batches:
            for batch in slices(whole, at, most):
                arrays = function([t or "" for t in batch.column(at).to_pylist()])
                out = [*batch.columns[:kept], *[a if a.type == t else a.cast(t) for a, t in zip(arrays, types)]]
                yield pa.RecordBatch.from_arrays(out, names=names)
            # Workers outlive their tasks; what a batch has held goes back to the system.
            del whole
            pa.default_memory_pool().release_unused()

    return passed.mapInArrow(work, schema)


def append_columns(
    df: DataFrame, column: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]],
    fields: list[tuple[str, str]], most: int = BATCH_BYTES,
) -> DataFrame:
    """All columns of ``df`` and new ones that Arrow batches of the texts in ``column`` give.

    ``make`` runs once in each task and returns the function from texts (NULL as the empty text) to arrays. A
    column that ``df`` has already under one of the new names, in any case, is replaced. The function gets about
    ``most`` bytes of text at a time.
    """
    new = {name.lower() for name, _ in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    columns = [F.col(f"`{c}`") for c in kept]
    # A text that is passed on goes to the worker once.
    if column in kept and "." not in column and type(df.schema[column].dataType) is T.StringType:
        return _mapped(df.select(*columns), len(kept), kept.index(column), make, fields, most)
    # Else it has a name of its own, so that it may be among the replaced.
    passed = df.select(*columns, text_or_empty(column).alias("__text_in"))
    return _mapped(passed, len(kept), len(kept), make, fields, most)


def map_texts(
    df: DataFrame, keys: list[str], column: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]],
    fields: list[tuple[str, str]], most: int = BATCH_BYTES,
) -> DataFrame:
    """The same with ``keys`` alone passed on: the other columns are not read at all, and the text goes to the worker
    once and does not come back."""
    new = {name.lower() for name, _ in fields}
    keyed = df.select(*keys, text_or_empty(column).alias("__text_in"))
    kept = [c for c in keyed.columns[:-1] if c.lower() not in new]
    passed = keyed.select(*[F.col(f"`{c}`") for c in kept], "__text_in")
    return _mapped(passed, len(kept), len(kept), make, fields, most)
