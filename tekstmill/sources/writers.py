"""Writers of documents, exclusions and records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Accepted compression names.
COMPRESSIONS = ("snappy", "gzip", "brotli", "lz4", "zstd", None)
BROTLI_CODEC = "org.apache.hadoop.io.compress.BrotliCodec"


def check_compression(spark: SparkSession, compression: str | None) -> str:
    """Spark's name of a compression. Brotli needs a codec that Spark does not ship."""
    if compression not in COMPRESSIONS:
        allowed = ", ".join(repr(c) for c in COMPRESSIONS)
        raise ValueError(f"Invalid compression {compression!r}; one of {allowed}.")
    if compression == "brotli":
        loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        try:
            loader.loadClass(BROTLI_CODEC)
        except Exception as error:
            raise RuntimeError("Brotli needs a Hadoop Brotli codec on the class path.") from error
    return compression or "none"


def write_documents(
    docs: DataFrame,
    output_folder: str,
    compression: str | None = None,
    expand_metadata: bool = False,
    schema: T.StructType | None = None,
    max_records_per_file: int = 0,
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (),
    adapter: Callable[[DataFrame], DataFrame] | None = None,
    max_metadata_keys: int = 1000,
) -> None:
    """Documents to parquet, metadata as JSON text.

    ``expand_metadata`` writes each field of a metadata struct, or each key of a map (an error beyond
    ``max_metadata_keys`` of them), as a column instead. Files roll by number of records. ``adapter`` is a function of
    the DataFrame, applied before anything else.
    """
    codec = check_compression(docs.sparkSession, compression)
    docs = docs if adapter is None else docs.transform(adapter)
    if "metadata" in docs.columns:
        kind = docs.schema["metadata"].dataType
        if expand_metadata and isinstance(kind, T.MapType):
            # The columns must be known to plan the write: distinct keys, not rows, come to the driver.
            keys = docs.select(F.explode(F.map_keys("metadata")).alias("k")).distinct().orderBy("k").limit(max_metadata_keys + 1)
            names = [r["k"] for r in keys.collect()]
            if len(names) > max_metadata_keys:
                raise ValueError(f"Metadata has more than {max_metadata_keys} keys.")
            others = [c for c in docs.columns if c != "metadata"]
            docs = docs.select(*others, *[F.try_element_at("metadata", F.lit(n)).alias(n) for n in names])
        elif expand_metadata and isinstance(kind, T.StructType):
            docs = docs.select(*[c for c in docs.columns if c != "metadata"], "metadata.*")
        elif isinstance(kind, (T.StructType, T.MapType)):
            docs = docs.withColumn("metadata", F.to_json("metadata"))
    if schema is not None:
        docs = docs.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    writer = docs.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(output_folder)


def write_jsonl(
    records: DataFrame,
    output_path: str,
    source: str,
    output_suffix: str = ".jsonl.gz",
    mode: str = "errorifexists",
) -> str:
    """Records to gzipped JSON lines, one line each, and the path written.

    The target is ``<output_path>/<source><suffix>`` unless the path already ends in
    ``.jsonl.gz``. It is a folder of part files: one file would take one task.
    """
    target = output_path if output_path.endswith(".jsonl.gz") else f"{output_path.rstrip('/')}/{source}{output_suffix}"
    records.write.mode(mode).option("compression", "gzip").json(target)
    return target
