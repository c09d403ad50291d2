"""Language of a text from character trigrams (Cavnar & Trenkle 1994)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import list_lengths, parts
from .settle import settle
from .text import STOP_WORD_LANGUAGES, stop_words

LETTERS = r"\p{L}+"
PROFILE_SIZE = 300
STOP_WORD_PROFILE_SIZE = 150

Profiles = Mapping[str, Iterable[str]]


def trigrams(text: Column) -> Column:
    """Trigrams of every word padded by one blank on each side.

    Cutting inside words keeps the work linear: a character offset into a long UTF-8
    text would have to be searched from its start.
    """
    padded = F.transform(
        F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0)),
        lambda w: F.concat(F.lit(" "), w, F.lit(" ")),
    )
    cut = F.transform(
        padded,
        lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))),
    )
    return F.flatten(cut)


def learn_profiles(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE_SIZE
) -> DataFrame:
    """The ``size`` most frequent trigrams per language: (lang, gram, n, rank).

    Words are counted first, so that each distinct one is cut into trigrams once. The
    ranking then sees one row per distinct trigram, and Spark
    cuts each task's share to ``size`` rows per language before it shuffles them.
    """
    cut = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(LETTERS), F.lit(0))
    # Settled, or the texts are cut twice: once for the number of their words.
    words = settle(docs.select(F.col(lang_col).alias("lang"), F.col(text_col)), "_cut", cut)
    words = words.select("lang", F.explode("_cut").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("times"))
    counts = (
        words.select("lang", "times", F.explode(trigrams(F.col("word"))).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def load_profiles(profiles: DataFrame, languages: Iterable[str], size: int = PROFILE_SIZE) -> dict[str, list[str]]:
    """Profiles in memory for :func:`score_language`. At most ``size`` rows per named
    language reach the driver."""
    wanted = list(languages)
    rows = profiles.filter(F.col("lang").isin(wanted) & (F.col("rank") <= size)).select("lang", "gram").collect()
    loaded: dict[str, list[str]] = {lang: [] for lang in wanted}
    for row in rows:
        loaded[row["lang"]].append(row["gram"])
    return loaded


def stop_word_profiles(
    languages: Iterable[str] = tuple(STOP_WORD_LANGUAGES), size: int = STOP_WORD_PROFILE_SIZE
) -> dict[str, list[str]]:
    """Profiles of the most frequent trigrams in Spark's stop words. They need no
    training text and cover Danish, but close relatives such as Danish and Norwegian
    score nearly alike; learned profiles tell them apart better. One size for all keeps
    languages with longer lists from winning by that alone."""
    profiles = {}
    for lang in languages:
        padded = [f" {w} " for w in stop_words(lang) if w.isalpha()]
        counts = Counter(p[i : i + 3] for p in padded for i in range(len(p) - 2))
        profiles[lang] = sorted(counts, key=lambda gram: (-counts[gram], gram))[:size]
    return profiles


def _profile_lead(words: Column, profiles: Profiles) -> Column:
    """Struct ``label, score`` of lower-case words, see :func:`score_language`.

    A batch holds far fewer distinct words than words, and what a word adds to each
    language depends on the word alone: trigrams are cut and looked up once per distinct
    word, and the rest is array sums, for two languages or for fifty.
    """
    labels = list(profiles)
    index: dict[str, int] = {}
    for members in profiles.values():
        for gram in members:
            index.setdefault(gram, len(index))
    # One row per known trigram and a last one, of zeros, for all others.
    member = np.zeros((len(labels), len(index) + 1), np.int32)
    for row, members in enumerate(profiles.values()):
        member[row, [index[gram] for gram in members]] = 1

    def lead_of(batch: pa.ListArray) -> pa.StructArray:
        lengths = list_lengths(batch)
        lettered = lengths > 0
        label, score = np.full(len(batch), None, object), np.zeros(len(batch))
        if lettered.any():
            encoded = batch.flatten().dictionary_encode()
            known, first = [], []
            for word in encoded.dictionary.to_pylist():
                padded = f" {word} "
                first.append(len(known))
                known.extend(index.get(padded[i : i + 3], -1) for i in range(len(word)))
            known = np.array(known)
            ids = encoded.indices.to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths[lettered]) - lengths[lettered]
            # Language by language, so that no array grows with their number.
            hits = np.stack(
                [np.add.reduceat(np.add.reduceat(row[known], first)[ids], starts) for row in member], axis=1
            )
            best = hits.argmax(axis=1)
            ordered = np.sort(np.pad(hits, ((0, 0), (1, 0))), axis=1)
            top, both = ordered[:, -1], ordered[:, -1] + ordered[:, -2]
            label[lettered] = np.array(labels, object)[best]
            score[lettered] = np.divide(top, both, out=np.zeros(len(top)), where=both > 0)
        return pa.StructArray.from_arrays(
            [pa.array(label, pa.string()), pa.array(score, pa.float64(), mask=~lettered)], names=["label", "score"]
        )

    @F.arrow_udf("label string, score double")
    def lead(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([lead_of(part) for part in parts(batch)])

    return lead(words)


def score_language(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """Adds ``language`` and ``language_score``, NULL for a text without letters.

    A language's hits are the text's trigrams found in its profile. The label is the
    language with the most hits (ties: first in the mapping), and the score is its lead
    over the runner-up, ``best / (best + second)``: 0.5 says undecided, 1.0 undisputed.
    A row is scored where it lies, without a join.
    """
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(LETTERS), F.lit(0))
    return settle(docs, "_lang", _profile_lead(words, profiles)).select(
        *docs.columns, F.col("_lang.label").alias("language"), F.col("_lang.score").alias("language_score")
    )
