"""Readers of documents, files and crawl logs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..plans.lineage import cut_lineage

logger = logging.getLogger(__name__)

METADATA = "map<string,string>"


def require_paths(*paths: str | None) -> None:
    if any(path == "" for path in paths):
        raise ValueError("A path must not be empty.")


def require_glob(pattern: str | None) -> None:
    if pattern == "":
        raise ValueError("A glob pattern must not be empty.")


def _selection(folder: str, glob_pattern: str | None, recursive: bool = True) -> tuple[str, dict]:
    """Path and options of a scan. A pattern is relative to the folder: ``*.parquet``
    matches its own files only, ``**/*.parquet`` those at any depth below it."""
    require_paths(folder)
    require_glob(glob_pattern)
    base = folder.rstrip("/") or "/"
    if glob_pattern is None:
        return base, {"recursiveFileLookup": recursive}
    if "**" not in glob_pattern:
        return f"{base}/{glob_pattern}", {}
    above, _, name = glob_pattern.rpartition("**/")
    if "**" in above or "/" in name or not name or not recursive:
        raise ValueError(f"Glob pattern {glob_pattern!r}: '**/' may only stand before the file name.")
    path = f"{base}/{above.rstrip('/')}" if above else base
    return path, {"recursiveFileLookup": True, "pathGlobFilter": name}


def read_jsonl(
    spark: SparkSession,
    input_dir: str,
    glob_pattern: str | None = None,
    schema: T.StructType | str | None = None,
    partitions: int | None = None,
    broken: str | None = None,
) -> DataFrame:
    """Documents from JSON lines, plain or compressed. Broken lines are dropped, or kept
    as they are in a column named by ``broken``, where they can be counted.

    Give a ``schema`` on large input: without one Spark reads the data once more to
    infer it. A gzip file cannot be split; ``partitions`` spreads few large ones.
    """
    path, options = _selection(input_dir, glob_pattern)
    reader = spark.read.options(mode="PERMISSIVE" if broken else "DROPMALFORMED", **options)
    if broken:
        reader = reader.option("columnNameOfCorruptRecord", broken)
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(broken, T.StringType())]) if broken else schema)
    docs = reader.json(path)
    if broken and broken not in docs.columns:
        docs = docs.withColumn(broken, F.lit(None).cast("string"))
    return docs if partitions is None else docs.repartition(partitions)


def decode_metadata(metadata: str) -> Column:
    """A JSON text column as a map; NULL and broken JSON give an empty one."""
    empty = F.create_map().cast(METADATA)
    return F.coalesce(F.from_json(F.col(metadata), METADATA), empty)


def read_documents(
    spark: SparkSession,
    data_folder: str,
    paths_file: str | None = None,
    limit: int = -1,
    skip: int = 0,
    read_metadata: bool = True,
    adapter: Callable[[DataFrame], DataFrame] | None = None,
    text_key: str = "text",
    id_key: str = "id",
    default_metadata: Mapping[str, str] | None = None,
    recursive: bool = True,
    glob_pattern: str | None = None,
    order_by: Sequence[str] = (),
    raw_metadata: bool = False,
) -> DataFrame:
    """Documents from parquet as ``text``, ``id`` and, on demand, ``metadata``.

    Metadata held as JSON text becomes a map, or stays as it is with ``raw_metadata``: numbers and nested values keep
    their types only there. Without ``read_metadata`` the scan reads
    the two key columns only. ``skip`` and ``limit`` count rows in the order of
    ``order_by``, by default file and row position; ``adapter`` is a function of the
    DataFrame. ``paths_file`` lists one path per line, relative to the folder; a
    ``glob_pattern`` beside it is not used.
    """
    if paths_file is None:
        path, options = _selection(data_folder, glob_pattern, recursive)
        reader, paths = spark.read.options(**options), [path]
    else:
        require_paths(data_folder)
        reader = spark.read
        listed = spark.read.text(paths_file).filter(F.trim("value") != "")
        # A scan is planned from its paths: the list is input to the plan, not data.
        paths = [f"{data_folder.rstrip('/')}/{row['value'].strip()}" for row in listed.toLocalIterator()]
    docs = reader.parquet(*paths)
    if limit >= 0 or skip > 0:
        if order_by:
            docs = rows_between(docs, list(order_by), skip, limit)
        else:
            docs = file_rows_between(docs, skip, limit)
    if adapter is not None:
        docs = docs.transform(adapter)
    renamed = {old: new for old, new in ((text_key, "text"), (id_key, "id")) if old != new}
    docs = docs.drop(*renamed.values()).withColumnsRenamed(renamed)
    if not read_metadata:
        return docs.select("text", "id")
    if not raw_metadata and "metadata" in docs.columns and isinstance(docs.schema["metadata"].dataType, T.StringType):
        docs = docs.withColumn("metadata", decode_metadata("metadata"))
    if default_metadata:
        given = F.create_map(*[F.lit(x) for pair in default_metadata.items() for x in pair])
        own = F.col("metadata") if "metadata" in docs.columns else F.create_map().cast(METADATA)
        # A document's own entries win over the defaults.
        rest = F.map_filter(given, lambda k, _: ~F.map_contains_key(own, k))
        docs = docs.withColumn("metadata", F.map_concat(rest, own))
    return docs


def _in_window(position: Column, skip: int, limit: int) -> Column:
    inside = position >= skip
    return inside & (position < skip + limit) if limit >= 0 else inside


def rows_between(docs: DataFrame, order: Sequence[str], skip: int, limit: int = -1) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` (all from ``skip`` where ``limit`` < 0) in an order, without a task that sees
    them all.

    Rows are sorted by ranges, and of each range one count tells where its rows stand in the whole.
    """
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut_lineage(placed, "ordered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per range.
    kept = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return kept.filter(_in_window(F.col("_before") + place, skip, limit)).orderBy("_at").select(*docs.columns)


def drop_first(docs: DataFrame, order: Sequence[str], skip: int) -> DataFrame:
    """All rows but the first ``skip`` in an order."""
    return rows_between(docs, order, skip)


def file_rows_between(docs: DataFrame, skip: int, limit: int = -1) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` in the order of file and row position, from per-file row counts.

    A first pass counts the rows of each file, reading no column; the counts, one row per file, are summed up in file
    order and written, so that the join with them is planned by their true size. Each row's place in the whole is then
    its file's offset plus its row position: rows are neither sorted nor moved before the cut, and files outside the
    window drop out by the join. Only the rows kept are put in order at the end.
    """
    located = docs.withColumn("_file", F.col("_metadata.file_path")).withColumn("_row", F.col("_metadata.row_index"))
    counts = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    wanted = F.col("_before") + F.col("_n") > skip
    if limit >= 0:
        wanted = wanted & (F.col("_before") < skip + limit)
    offsets = cut_lineage(offsets.filter(wanted).select("_file", "_before"), "file-offsets")
    kept = located.join(offsets, "_file").filter(_in_window(F.col("_before") + F.col("_row"), skip, limit))
    return kept.orderBy("_file", "_row").select(*docs.columns)


def union_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """All datasets under each other with a ``dataset`` column; missing columns are NULL."""
    if not datasets:
        raise ValueError("No dataset given.")
    named = [docs.withColumn("dataset", F.lit(name)) for name, docs in datasets.items()]
    combined = named[0]
    for docs in named[1:]:
        combined = combined.unionByName(docs, allowMissingColumns=True)
    return combined


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, length) of all files below a directory that have a suffix. Only names and
    sizes are used, so no content is read."""
    require_paths(directory)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.*")
    return files.load(directory).select("path", "length")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines that start with ``--``; an error where there are none."""
    require_paths(path)
    entries = spark.read.text(path).filter(F.col("value").startswith("--"))
    return require_rows(entries, f"No crawl entries in {path}.")
