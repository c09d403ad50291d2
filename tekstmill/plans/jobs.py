"""The jobs: extraction of files, filtering, sentence and document deduplication."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.extract import percent_decode
from ..functions.minhash import MinHashPlan
from ..operators import chain, crawl, extraction, minhash_dedup, sentence_dedup
from ..sources import readers, writers
from .lineage import cut_lineage, scratch

logger = logging.getLogger(__name__)

# Rows of a file that a row key can tell apart, as a power of two.
ROW_BITS = 36
STATS_SCHEMA = "dataset string, outcome string, documents bigint, chars bigint, tokens bigint"


@dataclass(frozen=True)
class Dataset:
    """Where a dataset is read and where its survivors and rejections are written."""

    name: str
    input_dir: str
    output_dir: str
    exclusion_dir: str
    glob_pattern: str | None = None

    def __post_init__(self) -> None:
        readers.require_paths(self.input_dir, self.output_dir, self.exclusion_dir)
        readers.require_glob(self.glob_pattern)


def _write_split(
    results: DataFrame,
    kept: Column,
    kept_dir: str,
    removed_dir: str,
    drop: Sequence[str],
    removed_drop: Sequence[str] = (),
    removed_by: tuple[str, ...] = (),
    compression: str | None = None,
    mode: str = "errorifexists",
    then: Callable[[DataFrame], None] | None = None,
) -> None:
    """Write survivors and rejections of one computation, which is staged in the shared folder in between: a lost
    executor repeats nothing of it."""
    spark = results.sparkSession
    staged = cut_lineage(results.withColumn("_kept", kept), "staged")
    is_kept = F.col("_kept")
    writers.write_documents(staged.filter(is_kept).drop(*drop, "_kept"), kept_dir, compression, mode=mode)
    removed = staged.filter(~is_kept).drop(*removed_drop, "_kept")
    writers.write_documents(removed, removed_dir, compression, mode=mode, partition_by=removed_by)
    if then is not None:
        then(staged.drop("_kept"))


def run_filter(
    spark: SparkSession,
    datasets: Sequence[Dataset],
    steps: Sequence[chain.Step] | None = None,
    schema: T.StructType | str | None = None,
    partitions: int | None = None,
    compression: str | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Filter JSON-lines datasets and return their merged statistics.

    Survivors go to ``<output_dir>/filter_output``, rejections to the exclusion folder,
    in one sub-folder ``rejected_by=<filter>`` each; lines that are no JSON and documents without
    text have their own there, and are counted like any other rejection.
    """
    steps = chain.default_steps() if steps is None else steps
    collected: list[tuple] = []
    for dataset in datasets:
        docs = readers.read_jsonl(spark, dataset.input_dir, dataset.glob_pattern, schema, partitions, broken="_line")
        results = chain.apply_chain(docs, steps, broken="_line").withColumn("dataset", F.lit(dataset.name))

        def note(rows: DataFrame) -> None:
            # One row per filter at the most.
            stats = chain.outcome_stats(rows).filter(F.col("dataset").isNotNull() & F.col("outcome").isNotNull())
            collected.extend(tuple(r) for r in stats.collect())

        with scratch(spark):
            _write_split(
                results,
                F.col("rejected_by").isNull(),
                f"{dataset.output_dir}/filter_output",
                dataset.exclusion_dir,
                drop=("rejected_by", "reason", "dataset", "_line"),
                removed_drop=("dataset",),
                removed_by=("rejected_by",),
                compression=compression,
                mode=mode,
                then=note,
            )
    if not collected:
        logger.info("Nothing to do.")
    return merge_stats(spark.createDataFrame(collected, STATS_SCHEMA))


def merge_stats(stats: DataFrame) -> DataFrame:
    """Sums over the datasets beside each dataset's own rows; a NULL name marks a sum."""
    return stats.rollup("dataset", "outcome").agg(
        *[F.sum(c).alias(c) for c in ("documents", "chars", "tokens")]
    )


def with_row_key(docs: DataFrame, key: str = "row_key") -> DataFrame:
    """Give every row of a file scan a unique number that follows the order of the files and of the rows in them.

    The number is the place of the row's file in the sorted list of files, then that of the row, so it is the same
    whenever it is computed and nothing is written for it.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = docs.select(path.alias("_file")).distinct()
    # One row per file, of which planning the scan has held a list anyway.
    numbered = files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("bigint").alias("_number"))
    placed = docs.select("*", path.alias("_file"), row.alias("_row")).join(F.broadcast(numbered), "_file")
    return placed.withColumn(key, F.shiftleft("_number", ROW_BITS) + F.col("_row")).drop("_file", "_row", "_number")


def _keyed(docs: DataFrame, key: str | None) -> tuple[DataFrame, str, tuple[str, ...]]:
    """Documents with a key, its name, and the columns to drop before writing."""
    if key is not None:
        return docs, key, ()
    return with_row_key(docs), "row_key", ("row_key",)


def run_sentence_dedup(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    exclusion_dir: str,
    key: str | None = None,
    glob_pattern: str | None = "**/*.parquet",
    partitions: int | None = None,
    compression: str | None = None,
    mode: str = "errorifexists",
    **options,
) -> DataFrame:
    """Cut repeated sentence windows; returns documents by outcome.

    ``key`` names a unique column that fixes the corpus order. Without one the rows are
    numbered by file and position.
    """
    readers.require_paths(input_dir, output_dir, exclusion_dir)
    sentence_dedup.check_parallelism(partitions)
    with scratch(spark):
        docs = readers.read_documents(spark, input_dir, glob_pattern=glob_pattern, raw_metadata=True)
        docs, key, extra = _keyed(docs, key)
        results = sentence_dedup.deduplicate_sentences(docs, key, partitions=partitions, **options)
        collected: list[tuple] = []

        def note(rows: DataFrame) -> None:
            outcome = F.when(F.col("kept"), F.lit("kept")).otherwise(F.lit("sent_dedup"))
            stats = rows.groupBy(outcome.alias("outcome")).agg(
                F.count(F.lit(1)).alias("documents"),
                F.sum(F.length("text")).alias("chars"),
                F.sum("removed_sentences").alias("removed_sentences"),
            )
            collected.extend(tuple(r) for r in stats.collect())

        _write_split(
            results,
            F.col("kept"),
            f"{output_dir}/sent_dedup_output",
            f"{exclusion_dir}/sent_dedup",
            drop=("kept", "removed_sentences", *extra),
            removed_drop=("kept", *extra),
            compression=compression,
            mode=mode,
            then=note,
        )
    return spark.createDataFrame(
        collected, "outcome string, documents bigint, chars bigint, removed_sentences bigint"
    )


def run_minhash_dedup(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    exclusion_dir: str,
    key: str | None = None,
    glob_pattern: str | None = "**/*.parquet",
    plan: MinHashPlan = MinHashPlan(),
    compression: str | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Keep one document per near-duplicate cluster; returns documents by outcome."""
    readers.require_paths(input_dir, output_dir, exclusion_dir)
    kept_dir, removed_dir = f"{output_dir}/deduplicated_output", f"{exclusion_dir}/removed"
    with scratch(spark):
        docs = readers.read_documents(spark, input_dir, glob_pattern=glob_pattern, raw_metadata=True)
        docs, key, extra = _keyed(docs, key)
        results = minhash_dedup.mark_duplicates(docs, key, plan=plan)
        _write_split(
            results, F.col("cluster").isNull(), kept_dir, removed_dir, drop=("cluster", *extra), removed_drop=extra,
            compression=compression, mode=mode,
        )
    # Row counts of parquet come from its footers.
    counts = [("kept", spark.read.parquet(kept_dir).count()), ("removed", spark.read.parquet(removed_dir).count())]
    return spark.createDataFrame([c for c in counts if c[1]], "outcome string, documents bigint")


def process_directory(
    spark: SparkSession,
    top_level_path: str,
    output_path: str,
    source: str,
    output_suffix: str = ".jsonl.gz",
    key_paths: str = "text",
    text_format: str = "txt",
    now: datetime | None = None,
    mode: str = "errorifexists",
) -> str:
    """Extract all supported files below a directory; returns the path written."""
    files = readers.require_rows(readers.list_files(spark, top_level_path), "No files to process.")
    stamp = str(now or datetime.now())
    records = extraction.extract_folders(spark, [top_level_path], files, source, stamp, key_paths, text_format)
    return writers.write_jsonl(records, output_path, source, output_suffix, mode)


def process_web_crawl(
    spark: SparkSession,
    path_to_crawl_log: str,
    output_path: str,
    data_path: str,
    source: str,
    output_suffix: str = ".jsonl.gz",
    now: datetime | None = None,
    mode: str = "errorifexists",
) -> str:
    """Extract the files of all hosts named in a crawl log; returns the path written."""
    hosts = crawl.crawl_hosts(readers.read_crawl_log(spark, path_to_crawl_log))
    listed = readers.list_files(spark, data_path)
    files = crawl.select_hosts(listed, hosts, crawl.top_folder(F.col("path"), data_path))
    files = readers.require_rows(files, "No files to process.")
    # Scans are planned from folders, of which there are fewer than files in the listing
    # that planning holds anyway; so folders of other hosts are never opened.
    found = files.select("host").distinct().toLocalIterator()
    folders = sorted(f"{data_path.rstrip('/')}/{row['host']}" for row in found)
    stamp = str(now or datetime.now())
    records = extraction.extract_folders(spark, folders, files, source, stamp)
    return writers.write_jsonl(records, output_path, source, output_suffix, mode)


def extract_with_outcomes(
    spark: SparkSession,
    top_level_path: str,
    output_path: str,
    quarantine_path: str,
    source: str,
    key_paths: str = "text",
    text_format: str = "txt",
    now: datetime | None = None,
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Extract every file below a directory, JSON of any shape included; returns the counts of each outcome.

    Files are read once (``binaryFile``). Their outcome rows are written in one pass, during which an ``Observation``
    counts them; records go to ``output_path`` as JSON lines, and every file or value that gave no text, with its
    rule and reason (unsupported suffix, bad UTF-8, empty page, broken JSON, missing key), to ``quarantine_path`` as
    parquet. Files named ``_…`` or ``.…`` are left out, as Spark's scans leave them out.
    """
    from pyspark.sql import Observation

    readers.require_paths(top_level_path, output_path, quarantine_path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(top_level_path)
    files = files.select(percent_decode(F.col("path")).alias("path"), "length", "content")
    observation = Observation("extraction outcomes")
    stamp = str(now or datetime.now())
    with scratch(spark):
        outcomes = extraction.extract_file_rows(files, key_paths, text_format)
        staged = cut_lineage(extraction.observe_outcomes(outcomes, observation), "outcomes")
        counts = {k: int(v) for k, v in observation.get.items()}
        quarantine = staged.filter(F.col("outcome") != "text").select("path", "rule", "outcome", "detail", "position")
        quarantine.write.mode(mode).parquet(quarantine_path)
        writers.write_jsonl(extraction.outcome_records(staged, source, stamp), output_path, source, mode=mode)
    logger.info("Extraction outcomes of %s: %s", top_level_path, counts)
    return counts
