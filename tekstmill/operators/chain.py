"""The ordered filter chain and its statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.language import Profiles
from ..functions.repair import repair_text
from . import filters

# Sub-folder of the exclusion directory per filter, in chain order.
LANGUAGE, REPETITION, QUALITY, LINE_CLEAN, LINE_STRUCTURE = FILTER_NAMES = (
    "non_danish_documents",
    "gopher_repetition",
    "gopher_quality",
    "c4_quality",
    "fineweb_quality",
)

# Rows without a text, which no filter looks at.
NO_TEXT = "no_text"
# Lines that are no JSON.
BROKEN = "broken_record"

Step = tuple[str, Callable[[DataFrame, str], DataFrame]]


def default_steps(
    languages: Iterable[str] = ("da",),
    profiles: Profiles | None = None,
    stop_word_list: Iterable[str] | None = None,
    language_options: dict | None = None,
    repetition_options: dict | None = None,
    quality_options: dict | None = None,
    line_clean_options: dict | None = None,
    line_structure_options: dict | None = None,
) -> list[Step]:
    """The five filters in order, each as (name, function of a DataFrame and its text column)."""

    def with_options(fn: Callable, options: dict | None, **fixed) -> Callable[[DataFrame, str], DataFrame]:
        return lambda docs, text_col: fn(docs, text_col=text_col, **(fixed | (options or {})))

    return [
        (LANGUAGE, with_options(filters.language_filter, language_options, languages=languages, profiles=profiles)),
        (REPETITION, with_options(filters.repetition_filter, repetition_options)),
        (QUALITY, with_options(filters.quality_filter, quality_options, stop_word_list=stop_word_list)),
        (LINE_CLEAN, with_options(filters.line_clean_filter, line_clean_options)),
        (LINE_STRUCTURE, with_options(filters.line_structure_filter, line_structure_options)),
    ]


def apply_chain(
    docs: DataFrame, steps: Sequence[Step], text_col: str = "text", repair: bool = True, broken: str | None = None
) -> DataFrame:
    """Run the steps in order over whole rows and note the first rejection.

    Adds ``rejected_by`` (name of the filter) and ``reason`` (its rule), both NULL for
    survivors, and ``token_count``, NULL for rejected rows. A rejected row keeps the text it had when its filter
    saw it, and later filters are given NULL for it, so they do no work there. Nothing
    is shuffled. A row whose text is NULL is rejected before the first step, by ``no_text``, or by ``broken_record``
    where the column ``broken`` holds the line that could not be read.
    """
    if repair:
        docs = repair_text(docs, text_col)
    unread = F.lit(False) if broken is None else F.col(broken).isNotNull()
    missing = F.col(text_col).isNull()
    docs = docs.withColumns(
        {
            "rejected_by": F.when(unread, F.lit(BROKEN)).when(missing, F.lit(NO_TEXT)),
            "_why": F.when(unread, F.lit("unreadable")).when(missing, F.lit("missing_text")),
        }
    )
    for name, step in steps:
        live = F.when(F.col("rejected_by").isNull(), F.col(text_col))
        docs = step(docs.withColumn("_live", live), "_live")
        rejects_here = F.col("rejected_by").isNull() & F.col("reason").isNotNull()
        docs = docs.withColumns(
            {
                text_col: F.when(F.col("rejected_by").isNull() & F.col("reason").isNull(), F.col("_live")).otherwise(
                    F.col(text_col)
                ),
                "rejected_by": F.when(rejects_here, F.lit(name)).otherwise(F.col("rejected_by")),
                "_why": F.coalesce(F.col("_why"), F.col("reason")),
            }
        ).drop("_live", "reason")
    docs = docs.withColumn("_live", F.when(F.col("rejected_by").isNull(), F.col(text_col)))
    return filters.token_count(docs.withColumnRenamed("_why", "reason"), text_col="_live").drop("_live")


def outcome_stats(results: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents, characters and tokens per dataset and outcome, with subtotals: a NULL
    outcome sums a dataset, a NULL dataset sums all."""
    kept = F.coalesce(F.col("rejected_by"), F.lit("kept"))
    return (
        results.select("dataset", kept.alias("outcome"), F.length(text_col).alias("chars"), "token_count")
        .rollup("dataset", "outcome")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.sum("chars").alias("chars"),
            F.sum("token_count").alias("tokens"),
        )
    )
