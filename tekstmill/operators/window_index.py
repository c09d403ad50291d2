"""A lasting index of sentence windows that later batches are deduplicated against.

Each batch's distinct window hashes are appended to a table in the warehouse, bucketed and sorted by hash, so that
the index is never shuffled again: a new batch deals only its own windows into the index's buckets to meet it. A
window of a batch is a duplicate if an earlier batch had it (a semi join with the index) or if it repeats inside the
batch (``duplicate_windows``). Fed batches in key order, the duplicates equal those of one batch over all of them.
Where the index side is small enough, Spark's runtime Bloom filter prunes the batch's windows before the join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sentence_dedup import duplicate_windows

BUCKETS = 64


class WindowIndex:
    """A bucketed table of (h) in the warehouse; ``name`` defaults to a new one."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.name = name or f"window_index_{uuid.uuid4().hex}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def add(self, windows: DataFrame) -> None:
        """Append the distinct hashes of a batch's windows."""
        hashes = windows.select("h").distinct()
        writer = hashes.write.bucketBy(self.buckets, "h").sortBy("h").format("parquet")
        writer.mode("append" if self.exists() else "errorifexists").saveAsTable(self.name)

    def known(self, windows: DataFrame) -> DataFrame:
        """Windows whose hash an earlier batch had."""
        if not self.exists():
            return windows.limit(0)
        return windows.join(self.spark.table(self.name), "h", "left_semi")

    def duplicates(self, windows: DataFrame, key: str = "doc_id") -> DataFrame:
        """(key, pos, h) of every window of a batch that is no first occurrence, counting earlier batches."""
        inside = duplicate_windows(windows, key)
        earlier = self.known(windows).select(key, "pos", "h")
        return inside.unionByName(earlier).distinct()

    def drop(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
