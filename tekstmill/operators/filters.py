"""Document filters. Each adds a ``reason`` column: NULL keeps the row, otherwise it names
the first rule that the text breaks. Thresholds are those of the published papers and all
of them are arguments.

Every filter works row by row: none shuffles. A NULL text gives a NULL reason, which the
filter chain uses to skip rows that an earlier filter has rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.language import Profiles, score_language
from ..functions.ngrams import repeated_ngram_chars
from ..functions.settle import settle
from ..functions.text import (
    PRE_TOKEN,
    any_match,
    count_matches,
    lines,
    paragraphs,
    sentences,
    share,
    stop_words,
    text_length,
    words,
)

# Rae et al. 2021, table A1: largest share of characters in the most frequent n-gram,
# and in n-grams that occur more than once.
TOP_NGRAM_SHARES = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}

# Wording of policy lines (Raffel et al. 2020).
POLICY_PHRASES = [
    "terms of use",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "use of cookies",
    "use cookies",
]
LINE_END = r"""[.!?"”]$"""
SENTENCE_PUNCTUATION = r"[.!?]$"
ELLIPSIS_END = r"(\.\.\.|…)$"
CITATION = r"\[[0-9]*\]"


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])


def language_filter(
    docs: DataFrame,
    languages: Iterable[str] = ("da",),
    profiles: Profiles | None = None,
    min_score: float = 0.65,
    label_only: bool = False,
    text_col: str = "text",
) -> DataFrame:
    """Keep texts whose language is one of ``languages``; adds ``language`` and
    ``language_score``. ``label_only`` adds the columns and rejects nothing.

    ``profiles`` come from :func:`learn_profiles`. Those of Spark's stop words
    (:func:`stop_word_profiles`) must be asked for: they tell related languages apart badly.
    """
    if not profiles:
        raise ValueError("The language filter needs profiles, learned from labelled texts of the languages in question.")
    scored = score_language(docs, profiles, text_col)
    if label_only:
        return scored.withColumn("reason", F.lit(None).cast("string"))
    known = F.col("language").isin(list(languages)) & (F.col("language_score") >= min_score)
    rejected = F.col(text_col).isNotNull() & ~F.coalesce(known, F.lit(False))
    return scored.withColumn("reason", F.when(rejected, F.lit("other_language")))


def line_repetition(text: Column, cut: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Shares of repeated lines and paragraphs, by number and by characters. ``cut`` holds the paragraphs and the lines
    where they are columns already."""
    size = F.length(text)
    out = {}
    for name, parts in (cut or {"paragraph": paragraphs(text), "line": lines(text)}).items():
        once = F.array_distinct(parts)
        out[f"dup_{name}_share"] = share(F.array_size(parts) - F.array_size(once), F.array_size(parts))
        out[f"dup_{name}_char_share"] = share(text_length(parts) - text_length(once), size)
    return out


def ngram_repetition(
    docs: DataFrame,
    text_col: str = "text",
    top_sizes: Sequence[int] = tuple(TOP_NGRAM_SHARES),
    dup_sizes: Sequence[int] = tuple(DUP_NGRAM_SHARES),
) -> DataFrame:
    """Adds ``top_n_char_share`` and ``dup_n_char_share`` columns."""
    counted = settle(docs, "_grams", repeated_ngram_chars(words(F.col(text_col)), top_sizes, dup_sizes))
    size = F.length(F.col(text_col))
    names = [f"top_{n}" for n in top_sizes] + [f"dup_{n}" for n in dup_sizes]
    return counted.withColumns({f"{n}_char_share": share(F.col(f"_grams.{n}"), size) for n in names}).drop("_grams")


def repetition_filter(
    docs: DataFrame,
    max_dup_line_share: float = 0.30,
    max_dup_paragraph_share: float = 0.30,
    max_dup_line_char_share: float = 0.20,
    max_dup_paragraph_char_share: float = 0.20,
    top_ngram_shares: Mapping[int, float] = TOP_NGRAM_SHARES,
    dup_ngram_shares: Mapping[int, float] = DUP_NGRAM_SHARES,
    text_col: str = "text",
) -> DataFrame:
    """Reject texts that repeat lines, paragraphs or word n-grams (Rae et al. 2021)."""
    keep = docs.columns
    # Each rule names them several times.
    checked = settle(docs, "_cut", F.struct(paragraphs(F.col(text_col)).alias("paragraph"), lines(F.col(text_col)).alias("line")))
    cut = {"paragraph": F.col("_cut.paragraph"), "line": F.col("_cut.line")}
    checked = checked.withColumns({f"_{k}": v for k, v in line_repetition(F.col(text_col), cut).items()})
    line_rules = [
        ("dup_paragraph_share", F.col("_dup_paragraph_share") > max_dup_paragraph_share),
        ("dup_paragraph_char_share", F.col("_dup_paragraph_char_share") > max_dup_paragraph_char_share),
        ("dup_line_share", F.col("_dup_line_share") > max_dup_line_share),
        ("dup_line_char_share", F.col("_dup_line_char_share") > max_dup_line_char_share),
    ]
    checked = settle(checked, "_lines", first_reason(line_rules)).drop("_cut", *[f"_{k}" for k in line_repetition(F.col(text_col))])
    # N-grams are counted only for texts that pass the line rules.
    checked = checked.withColumn("_live", F.when(F.col("_lines").isNull(), F.col(text_col)))
    checked = ngram_repetition(checked, "_live", tuple(top_ngram_shares), tuple(dup_ngram_shares))
    gram_rules = [
        (f"{kind}_{n}_gram", F.col(f"{kind}_{n}_char_share") > limit)
        for kind, shares in (("top", top_ngram_shares), ("dup", dup_ngram_shares))
        for n, limit in shares.items()
    ]
    return settle(checked, "reason", F.coalesce(F.col("_lines"), first_reason(gram_rules))).select(*keep, "reason")


def quality_filter(
    docs: DataFrame,
    stop_word_list: Iterable[str] | None = None,
    min_words: int = 50,
    max_words: int = 100_000,
    min_mean_word_length: float = 3.0,
    max_mean_word_length: float = 10.0,
    max_symbol_ratio: float = 0.1,
    max_bullet_line_share: float = 0.9,
    max_ellipsis_line_share: float = 0.3,
    min_alpha_word_share: float = 0.8,
    min_stop_words: int = 2,
    text_col: str = "text",
) -> DataFrame:
    """Reject texts by word counts, symbols, line shapes and stop words (Rae et al. 2021).
    Stop words default to the Danish list."""
    keep = docs.columns
    text = F.col(text_col)
    known = stop_words("da") if stop_word_list is None else list(stop_word_list)
    # One literal, split when the query is planned, instead of one per word.
    stop_array = F.split(F.lit("\t".join(known)), "\t")
    checked = docs.withColumns({"_words": words(text), "_lines": lines(text)})
    w, rows = F.col("_words"), F.col("_lines")
    checked = checked.withColumns(
        {
            "_n": F.array_size(w),
            "_chars": text_length(w),
            "_alpha": F.array_size(F.filter(w, lambda x: x.rlike(r"\p{L}"))),
            "_stops": F.array_size(F.array_intersect(F.transform(w, F.lower), stop_array)),
            "_hashes": count_matches(text, "#"),
            "_ellipses": count_matches(text, r"\.\.\.|…"),
            "_rows": F.array_size(rows),
            "_bullets": F.array_size(F.filter(rows, lambda x: x.rlike(r"^\s*[•‣●▪*-]"))),
            "_trailing": F.array_size(F.filter(rows, lambda x: x.rlike(ELLIPSIS_END))),
        }
    )
    c = F.col
    mean_length = share(c("_chars"), c("_n"))
    rules = [
        ("too_few_words", c("_n") < min_words),
        ("too_many_words", c("_n") > max_words),
        ("short_words", mean_length < min_mean_word_length),
        ("long_words", mean_length > max_mean_word_length),
        ("too_many_hashes", share(c("_hashes"), c("_n")) > max_symbol_ratio),
        ("too_many_ellipses", share(c("_ellipses"), c("_n")) > max_symbol_ratio),
        ("too_many_bullets", share(c("_bullets"), c("_rows")) > max_bullet_line_share),
        ("too_many_ellipsis_lines", share(c("_trailing"), c("_rows")) > max_ellipsis_line_share),
        ("too_few_alpha_words", share(c("_alpha"), c("_n")) < min_alpha_word_share),
        ("too_few_stop_words", c("_stops") < min_stop_words),
    ]
    return settle(checked, "reason", first_reason(rules)).select(*keep, "reason")


def line_clean_filter(
    docs: DataFrame,
    min_sentences: int = 5,
    min_words_per_line: int = 3,
    max_word_length: int = 1000,
    remove_citations: bool = True,
    require_line_end: bool = True,
    drop_ellipsis_lines: bool = True,
    drop_javascript: bool = True,
    drop_policy: bool = True,
    reject_curly_bracket: bool = True,
    reject_lorem_ipsum: bool = True,
    text_col: str = "text",
) -> DataFrame:
    """Remove page furniture line by line, then reject what is left of bad pages
    (Raffel et al. 2020). Replaces the text; a rejected row keeps its cleaned text."""
    keep = docs.columns
    text = F.col(text_col)

    def stays(line: Column) -> Column:
        lowered = F.lower(line)
        ok = count_matches(line, r"\S+") >= min_words_per_line
        ok &= ~line.rlike(rf"\S{{{max_word_length + 1}}}")
        if require_line_end:
            ok &= line.rlike(LINE_END)
        if drop_ellipsis_lines:
            ok &= ~line.rlike(ELLIPSIS_END)
        if drop_javascript:
            ok &= ~lowered.contains("javascript")
        if drop_policy:
            ok &= ~any_match(lowered, POLICY_PHRASES)
        return ok

    def tidy(line: Column) -> Column:
        return F.trim(F.regexp_replace(line, CITATION, "") if remove_citations else line)

    cleaned = F.array_join(F.filter(F.transform(F.split(text, "\n"), tidy), stays), "\n")
    checked = docs.withColumns({"_cleaned": cleaned, "_lower": F.lower(text)})
    rules = []
    if reject_lorem_ipsum:
        rules.append(("lorem_ipsum", F.col("_lower").contains("lorem ipsum")))
    if reject_curly_bracket:
        rules.append(("curly_bracket", F.col("_lower").contains("{")))
    rules.append(("too_few_sentences", F.array_size(sentences(F.col("_cleaned"))) < min_sentences))
    out = {name: F.col(name) for name in keep} | {text_col: F.col("_cleaned")}
    judged = settle(checked, "reason", first_reason(rules))
    return judged.select(*[value.alias(name) for name, value in out.items()], "reason")


def line_structure_filter(
    docs: DataFrame,
    min_line_end_share: float = 0.12,
    max_dup_line_char_share: float = 0.10,
    short_line_length: int = 30,
    max_short_line_share: float = 0.67,
    text_col: str = "text",
) -> DataFrame:
    """Reject texts by closing punctuation, repeated and short lines (Penedo et al. 2024).
    The limits themselves are rejected."""
    keep = docs.columns
    text = F.col(text_col)
    checked = docs.withColumn("_lines", lines(text))
    rows = F.col("_lines")
    checked = checked.withColumns(
        {
            "_rows": F.array_size(rows),
            "_ended": F.array_size(F.filter(rows, lambda x: x.rlike(LINE_END))),
            "_short": F.array_size(F.filter(rows, lambda x: F.length(x) < short_line_length)),
            "_repeated": text_length(rows) - text_length(F.array_distinct(rows)),
        }
    )
    c = F.col
    rules = [
        ("no_lines", c("_rows") == 0),
        ("few_line_ends", share(c("_ended"), c("_rows")) <= min_line_end_share),
        ("short_lines", share(c("_short"), c("_rows")) >= max_short_line_share),
        ("dup_line_chars", share(c("_repeated"), F.length(text)) >= max_dup_line_char_share),
    ]
    return settle(checked, "reason", first_reason(rules)).select(*keep, "reason")


def token_count(docs: DataFrame, pattern: str = PRE_TOKEN, text_col: str = "text") -> DataFrame:
    """Adds ``token_count``: pre-tokens matching ``pattern``, not sub-word units."""
    return docs.withColumn("token_count", count_matches(F.col(text_col), pattern))
