"""Files of several formats to one table of records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.extract import (
    RECORD_SCHEMA,
    choose_format,
    clean_mail_body,
    collapse_newlines,
    document_record,
    file_metadata,
    file_suffix,
    html_to_text,
    path_texts,
    percent_decode,
)
from ..functions.settle import settle
from ..plans.lineage import cut_lineage
from ..sources.readers import logger

# Suffixes and the rule that reads them.
ROUTES = {".txt": "text", ".md": "text", ".html": "html", ".json": "json"}
UNSUPPORTED = "unsupported"


def route(path: Column) -> Column:
    """Name of the rule for a path, by its last suffix and in exact case."""
    pairs = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, file_suffix(path)), F.lit(UNSUPPORTED))


def _records(rows: DataFrame, source: str, now: str) -> DataFrame:
    """Records from rows with ``text``, ``path`` and ``size``; rows without text drop out."""
    metadata = file_metadata(F.col("path"), F.col("size"))
    return rows.filter(F.col("text").isNotNull()).select(*document_record(F.col("text"), F.lit(source), metadata, now))


def _located(rows: DataFrame, text: Column) -> DataFrame:
    return rows.select(
        text.alias("text"), percent_decode(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size")
    )


def _whole_files(spark: SparkSession, folders: list[str], glob: str) -> DataFrame:
    """One row per file. Bytes that are not UTF-8 give NULL."""
    files = spark.read.format("text").options(wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return _located(files.load(folders), F.try_validate_utf8("value"))


def text_records(rows: DataFrame, source: str, now: str) -> DataFrame:
    return _records(rows.withColumn("text", collapse_newlines(F.col("text"))), source, now)


def html_records(rows: DataFrame, source: str, now: str) -> DataFrame:
    """Pages without any body text give no record."""
    return _records(settle(rows, "text", collapse_newlines(html_to_text(F.col("text")))), source, now)


def mail_records(rows: DataFrame, source: str, now: str) -> DataFrame:
    """Records from mail bodies that are already text."""
    return _records(rows.withColumn("text", clean_mail_body(F.col("text"))), source, now)


def json_records(
    values: DataFrame, source: str, now: str, text_path: str = "text", text_format: str = "txt"
) -> DataFrame:
    """Records from a column ``value`` of parsed JSON beside ``path`` and ``size``: one
    for every text that the comma-separated key path reaches."""
    if text_format not in ("txt", "html"):
        logger.warning("Text format %r is not supported; taking plain text.", text_format)
    keys = text_path.split(",")
    kind = values.schema["value"].dataType
    if isinstance(kind, T.StructType) and keys[0] not in kind.fieldNames():
        logger.warning("Key %r not found in JSON documents.", keys[0])
    found = values.select("path", "size", F.explode(path_texts(F.col("value"), kind, keys)).alias("text"))
    return _records(settle(found, "text", choose_format(F.col("text"), text_format)), source, now)


def _json_values(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Parsed JSON files. Spark infers one schema for all of them; a list at the top
    gives a row per element, a broken file none."""
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    rows = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folders)
    fields = [F.col(f"`{c}`") for c in rows.columns if c != "_corrupt_record"]
    if "_corrupt_record" in rows.columns and fields:
        rows = rows.filter(F.col("_corrupt_record").isNull())
    if not fields:
        return _located(rows.limit(0), F.lit(None).cast("string")).withColumnRenamed("text", "value")
    return _located(rows, F.struct(*fields)).withColumnRenamed("text", "value")


def extract_folders(
    spark: SparkSession,
    folders: list[str],
    files: DataFrame,
    source: str,
    now: str,
    text_path: str = "text",
    text_format: str = "txt",
) -> DataFrame:
    """Records of all supported files below ``folders``, of which ``files`` is the
    listing. Formats that do not occur are not read; unsupported files are reported."""
    counts = files.select(route(F.col("path")).alias("route")).agg(
        *[F.count_if(F.col("route") == r).alias(r) for r in sorted({*ROUTES.values(), UNSUPPORTED})]
    )
    present = counts.first()
    if present[UNSUPPORTED]:
        logger.warning("Unsupported file type: %d files skipped.", present[UNSUPPORTED])
    parts = []
    for suffix, rule in ROUTES.items():
        if present[rule] == 0:
            continue
        if rule == "json":
            parts.append(json_records(_json_values(spark, folders), source, now, text_path, text_format))
        else:
            make = html_records if rule == "html" else text_records
            parts.append(make(_whole_files(spark, folders, f"*{suffix}"), source, now))
    return _union(spark, parts)


def _union(spark: SparkSession, parts: Iterable[DataFrame]) -> DataFrame:
    combined = None
    for part in parts:
        combined = part if combined is None else combined.unionByName(part)
    return spark.createDataFrame([], RECORD_SCHEMA) if combined is None else combined


# Outcomes of a file or of a value inside it; every input file ends in at least one.
OUTCOMES = ("text", "unsupported", "bad utf-8", "empty", "broken", "missing")


def extract_file_rows(files: DataFrame, text_path: str = "text", text_format: str = "txt") -> DataFrame:
    """Outcome rows of files given as ``path`` and ``content`` (bytes), as ``spark.read.format("binaryFile")`` gives
    them (``length`` is taken where present).

    Columns: path, size, rule, outcome, detail, position, text. ``outcome`` is one of ``OUTCOMES``: ``text`` for each
    extracted text, ``unsupported`` (detail: the suffix), ``bad utf-8``, ``empty`` (a page or file with no text left),
    ``broken`` (JSON that doesn't parse) or ``missing`` (detail: the key that a JSON value lacks). JSON of any shape is
    walked by ``walk_json``; ``position`` orders the texts of one file. Nothing is left out without a row.
    """
    from .json_walk import walk_json

    size = F.col("length") if "length" in files.columns else F.length("content")
    routed = files.select(
        "path", size.cast("bigint").alias("size"), route(F.col("path")).alias("rule"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("body"),
    )
    routed = cut_lineage(routed, "extract-routed")
    no_position = F.array().cast("array<int>")

    def failed(df: DataFrame, outcome: str, detail: Column) -> DataFrame:
        return df.select(
            "path", "size", "rule", F.lit(outcome).alias("outcome"), detail.cast("string").alias("detail"),
            no_position.alias("position"), F.lit(None).cast("string").alias("text"),
        )

    unsupported = failed(routed.filter(F.col("rule") == UNSUPPORTED), "unsupported", file_suffix(F.col("path")))
    readable = routed.filter(F.col("rule") != UNSUPPORTED)
    bad = failed(readable.filter(F.col("body").isNull()), "bad utf-8", F.lit(None))
    readable = readable.filter(F.col("body").isNotNull())

    plain = readable.filter(F.col("rule") == "text").withColumn("text", collapse_newlines(F.col("body")))
    pages = settle(readable.filter(F.col("rule") == "html"), "text", collapse_newlines(html_to_text(F.col("body"))))
    texts = plain.unionByName(pages)
    has_text = F.col("text").isNotNull() & (F.col("text") != "")
    kept = texts.filter(has_text).select(
        "path", "size", "rule", F.lit("text").alias("outcome"), F.lit(None).cast("string").alias("detail"),
        no_position.alias("position"), "text",
    )
    empty = failed(texts.filter(~has_text), "empty", F.lit(None))

    walked = walk_json(readable.filter(F.col("rule") == "json"), F.col("body"), text_path.split(","), ["path", "size", "rule"])
    walked = settle(walked, "text", F.when(F.col("outcome") == "text", choose_format(F.col("text"), text_format)))
    walked = walked.select("path", "size", "rule", "outcome", "detail", "position", "text")
    return unsupported.unionByName(bad).unionByName(kept).unionByName(empty).unionByName(walked)


def observe_outcomes(outcomes: DataFrame, observation) -> DataFrame:
    """The same rows, counting all rows and the rows of each outcome into ``observation`` as they pass."""
    counts = [F.count_if(F.col("outcome") == o).alias(o.replace(" ", "_").replace("-", "")) for o in OUTCOMES]
    return outcomes.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


def outcome_records(outcomes: DataFrame, source: str, now: str) -> DataFrame:
    """Records of the ``text`` outcomes, in the schema of all extraction."""
    return _records(outcomes.filter(F.col("outcome") == "text").select("text", "path", "size"), source, now)
