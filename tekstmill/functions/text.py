"""Tokenizers and array helpers shared by the filters and the deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

# Patterns use neither look-around nor back-references, so RE2 engines read them too.
WORD = r"[\p{L}\p{N}]+"
SENTENCE = r"[^.!?]+[.!?]*"
PRE_TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"

# The language codes for which Spark ships stop words.
STOP_WORD_LANGUAGES = {
    "da": "danish",
    "de": "german",
    "en": "english",
    "es": "spanish",
    "fi": "finnish",
    "fr": "french",
    "hu": "hungarian",
    "it": "italian",
    "nl": "dutch",
    "no": "norwegian",
    "pt": "portuguese",
    "ru": "russian",
    "sv": "swedish",
    "tr": "turkish",
}


def stop_words(language: str) -> list[str]:
    """Stop words of a language code, as shipped with Spark ML."""
    return list(StopWordsRemover.loadDefaultStopWords(STOP_WORD_LANGUAGES[language]))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Sentences with their closing marks; joined back together they give the text again,
    unless it opens with a mark."""
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def lines(text: Column) -> Column:
    """Lines that are not empty."""
    return F.array_remove(F.split(text, "\n"), "")


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines."""
    return F.array_remove(F.split(text, "\n\n+"), "")


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double: 0 where the whole is 0, NULL where it is NULL."""
    ratio = part.cast("double") / whole.cast("double")
    return F.when(whole > 0, ratio).when(whole.isNotNull(), F.lit(0.0))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is named.

    A higher-order function re-evaluates outer expressions for every element, so an
    expensive array has to enter it as a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(items: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring items, as structs with the fields ``0`` to ``n-1``.

    Zipping ``n`` shifted slices is linear in the items, and no run exists where there
    are fewer than ``n`` of them.
    """
    count = F.greatest(F.array_size(items) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(items, F.lit(i + 1), count).alias(str(i)) for i in range(n)])


def run_fields(run: Column, n: int) -> list[Column]:
    return [run[str(i)] for i in range(n)]


def joined_runs(items: Column, n: int, separator: str = " ") -> Column:
    return F.transform(runs(items, n), lambda r: F.concat_ws(separator, *run_fields(r, n)))


def text_length(items: Column) -> Column:
    """Characters held by all items of a string array."""
    return F.length(F.array_join(items, ""))


def any_match(text: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the literal phrases occurs."""
    found = F.lit(False)
    for phrase in patterns:
        found = found | text.contains(phrase)
    return found
