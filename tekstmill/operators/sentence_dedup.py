"""Removal of repeated sentence runs across a corpus.

Only keys, positions and hashes of windows are shuffled to find the repeats; texts move
once, when the positions to cut are brought to their documents. ``key`` must identify a
row and fixes the order of the corpus: the first occurrence of a window, by key and then
position, stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import bind, run_fields, runs, words
from ..plans.lineage import cut_lineage
from .skew import HOT_ROWS, join_facts


def check_parallelism(partitions: int | None) -> None:
    if partitions is not None and partitions <= 0:
        raise ValueError("The number of partitions must be positive.")


def pieces(text: Column, split_sentences: bool) -> Column:
    """Sentences, or lines with their line ends. The pieces join to the text: marks or line ends that it opens with
    are a piece of their own."""
    pattern = r"^[.!?]+|[^.!?]+[.!?]*" if split_sentences else r"^\n+|[^\n]+\n*"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def window_hashes(text: Column, n_sentences: int, split_sentences: bool = True, hex_form: bool = False) -> Column:
    """MD5 of every run of ``n_sentences`` sentences, case and blanks evened out.

    Blanks hold no closing mark, so evening them out before the cut leaves the
    sentences where they are.
    """
    blanks = r"\s+" if split_sentences else r"[^\S\n]+"
    even = F.lower(F.regexp_replace(text, blanks, " "))
    parts = F.transform(pieces(even, split_sentences), lambda s: F.btrim(s, F.lit(" \n")))

    def digest(run: Column) -> Column:
        hexed = F.md5(F.concat_ws(" ", *run_fields(run, n_sentences)))
        return hexed if hex_form else F.unhex(hexed)

    return bind(parts, lambda p: F.transform(runs(p, n_sentences), digest))


def sentence_windows(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    n_sentences: int = 3,
    split_sentences: bool = True,
    hex_form: bool = False,
) -> DataFrame:
    """One row per window: ``key, pos`` (of its first sentence), ``h`` and ``again``, set
    where the same document had the window before. Sorting the hashes of one document
    finds these without leaving the row."""

    def mark(ordered: Column) -> Column:
        def entry(w: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)
            again = F.coalesce(before["h"] == w["h"], F.lit(False))
            return F.struct(w["pos"].alias("pos"), w["h"].alias("h"), again.alias("again"))

        return F.transform(ordered, entry)

    hashes = window_hashes(F.col(text_col), n_sentences, split_sentences, hex_form)
    with_position = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("pos")))
    return docs.select(key, F.inline(bind(F.array_sort(with_position), mark)))


def duplicate_windows(
    windows: DataFrame,
    key: str = "doc_id",
    index: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every window but its first occurrence. With an ``index`` of hashes (column ``h``) of text that is known
    already, every window found there is a duplicate, and no other.

    The first document of a hash comes from an aggregation that combines before it
    shuffles; the windows then look up that document in a join that is safe against a
    window repeated all over the corpus.
    """
    firsts = (
        windows.groupBy("h")
        .agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .withColumn("_known", F.lit(index is not None))
    )
    if index is None:
        firsts = firsts.filter(F.col("_times") > 1)
    else:
        # On both sides a hash is one row here, however often the corpus repeats it.
        firsts = firsts.join(index.select("h").distinct(), "h", "left_semi")
    # Hashes that occur once are gone by now, and with them most of the table.
    firsts = cut_lineage(firsts, "repeated-windows")
    found = join_facts(windows, firsts, "h", "_times", F.struct(key, "pos"), hot_rows)
    return found.filter(F.col("_known") | F.col("again") | (F.col(key) > F.col("_first"))).select(key, "pos", "h")


def cut_windows(
    docs: DataFrame,
    duplicates: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    n_sentences: int = 3,
    split_sentences: bool = True,
    min_doc_words: int = 50,
    min_num_sentences: int = 1,
) -> DataFrame:
    """Cut the sentences of duplicate windows out of their documents.

    Adds ``removed_sentences`` and ``kept``. A document that was cut is kept while it has
    at least ``min_doc_words`` words and ``min_num_sentences`` sentences; one that was
    not cut is always kept.
    """
    # One row per document that has anything to cut; a list is bounded by its text.
    cuts = duplicates.groupBy(key).agg(F.collect_list("pos").alias("_cuts"))
    joined = docs.join(cuts, key, "left")
    covered = F.array_distinct(
        F.flatten(F.transform("_cuts", lambda p: F.sequence(p, p + (n_sentences - 1))))
    )

    def rest(parts: Column) -> Column:
        places = F.transform(parts, lambda _, i: i)
        return bind(F.array_except(places, covered), lambda left: F.transform(left, lambda i: F.get(parts, i)))

    touched = F.col("_cuts").isNotNull()
    joined = joined.withColumn("_rest", F.when(touched, bind(pieces(F.col(text_col), split_sentences), rest)))
    joined = joined.withColumn(
        "removed_sentences",
        F.when(touched, F.array_size(covered)).otherwise(F.lit(0)),
    )
    shortened = F.array_join("_rest", "")
    joined = joined.withColumn(text_col, F.when(touched, shortened).otherwise(F.col(text_col)))
    long_enough = (F.array_size(words(F.col(text_col))) >= min_doc_words) & (
        F.array_size("_rest") >= min_num_sentences
    )
    return joined.withColumn("kept", F.when(touched, long_enough).otherwise(F.lit(True))).select(
        *docs.columns, "removed_sentences", "kept"
    )


def deduplicate_sentences(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    n_sentences: int = 3,
    split_sentences: bool = True,
    min_doc_words: int = 50,
    min_num_sentences: int = 1,
    index: DataFrame | None = None,
    partitions: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Find and cut duplicate windows; see :func:`cut_windows` for the result.

    ``partitions`` spreads the documents by key before their windows are built. It is
    for input that arrives in too few pieces; by default the scan's own splits stay.
    """
    check_parallelism(partitions)
    if partitions is not None:
        docs = docs.repartition(partitions, key)
    # Written once: they are looked at twice, and cost a pass over all texts.
    windows = cut_lineage(sentence_windows(docs, key, text_col, n_sentences, split_sentences), "windows")
    duplicates = duplicate_windows(windows, key, index, hot_rows)
    return cut_windows(
        docs, duplicates, key, text_col, n_sentences, split_sentences, min_doc_words, min_num_sentences
    )
