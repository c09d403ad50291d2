"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton after folding disguises.

Texts are folded (lower case, look-alike letters and digit substitutions replaced, anything else a blank), then
searched for stems at the starts of words; a word with accents that matches nothing is searched once more without
them, for stems without any. Stems and weights are learned from labelled documents: log-odds of occurrences in toxic
and in clean ones, counted in one text of each group of near copies (texts of nearly the same words) and kept only where
they occur in several contexts, so that a group of near copies teaches no more than one of them. A
match that begins an exception phrase (given, or learned: contexts known from clean
documents only) counts nothing. The matched weight and its density per word give the score by logistic regression.

Inputs: NULL and the empty text score like texts without a match. A NULL id counts as the empty text where rows are
held out. Copies score alike. Labels that are NULL or neither 0 nor 1 are not used; without any usable label the
lexicon is empty and every score is the smoothed rate of toxic labels. Extra columns pass through ``score_toxicity``;
those with the name of an output are replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import append_columns, cut_lineage, map_texts, read_table
from .forest import ForestPlan, class_of, near_duplicate_classes
from .training import fit_logistic, held_out, sigmoid, training_rows

# Letters and digits that stand for a Latin letter.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ӏ": "l", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ø": "o", "ł": "l", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
}
TABLE = str.maketrans(LOOKALIKES)
MARKS = re.compile("[\u0300-\u036f]+")
HIDDEN = re.compile("[\u0300-\u036f\u200b-\u200d\u2060\ufeff\xad]+")
GAPS = re.compile(r"[\W_]+")
STEM_LENGTHS = range(4, 9)
# Documents learned from, at most. Bounds the training jobs whatever the size of the corpus, and with them the stems
# and exception phrases that reach the driver: those come from the training documents alone.
TRAIN_ROWS = 10_000
# Near copies: most of their words are the same, so that short texts are some as well.
COPIES = ForestPlan(words=1)


def fold(text: str) -> str:
    """Words in their plain form, one blank before each and one at the end."""
    text = text.lower()
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    return f" {GAPS.sub(' ', text.translate(TABLE)).strip()} "


def without_accents(folded: str) -> str:
    return MARKS.sub("", unicodedata.normalize("NFD", folded))


@dataclass
class Lexicon:
    """Folded stems with weights, exception phrases (folded, from a stem on), and the logistic curve of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float] = (1.0, 1.0)
    intercept: float = 0.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for stem in self.weights:
            found.add_word(f" {stem}", stem)
        found.make_automaton()
        return found


def _found(folded: str, lexicon: Lexicon, automaton) -> dict[int, str]:
    best: dict[int, str] = {}
    for end, stem in automaton.iter(folded):
        start = end - len(stem) + 1
        if start not in best or lexicon.weights[stem] > lexicon.weights[best[start]]:
            best[start] = stem
    if lexicon.exceptions and best:
        longest = max(p.count(" ") for p in lexicon.exceptions) + 1
        for start in list(best):
            words = folded[start : start + 400].split(" ", longest)
            if any(" ".join(words[:k]) in lexicon.exceptions for k in range(1, longest + 1)):
                del best[start]
    return best


def matches(folded: str, lexicon: Lexicon, automaton) -> list[str]:
    """The heaviest stem of each word that has one, exceptions taken out."""
    if automaton is None:
        return []
    best = _found(folded, lexicon, automaton)
    stems = list(best.values())
    if not folded.isascii():
        plain = without_accents(folded)
        hidden = {at: s for at, s in _found(plain, lexicon, automaton).items() if s.isascii()}
        if hidden:
            # Words have the same number in both forms.
            seen = {folded.count(" ", 0, at) for at in best}
            accented = folded.split(" ")
            for at, stem in hidden.items():
                number = plain.count(" ", 0, at)
                if number not in seen and not accented[number].isascii():
                    stems.append(stem)
    return stems


def features(texts: list[str], lexicon: Lexicon, automaton) -> np.ndarray:
    """Matched weight, and matched weight per hundred words, both as log(1 + x)."""
    rows = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        folded = fold(text)
        weight = sum(lexicon.weights[s] for s in matches(folded, lexicon, automaton))
        rows[i] = weight, 100 * weight / max(1, folded.count(" ") - 1)
    return np.log1p(rows)


def without_copies(train: DataFrame) -> DataFrame:
    """(text, y) of one text of each group of near copies under each label."""
    named = cut_lineage(train.select(F.monotonically_increasing_id().alias("doc_id"), "text", "y"), "toxicity-named")
    groups = near_duplicate_classes(named, COPIES).select("class", "class_id")
    joined = named.withColumn("class", class_of(F.col("text"))).join(groups, "class")
    one = joined.groupBy("class_id", "y").agg(F.min("text").alias("text"))
    return cut_lineage(one.select("text", "y"), "toxicity-distinct")


def _stem_counts(train: DataFrame) -> DataFrame:
    """Toxic documents with a stem, and its occurrences under each label (of one document, five at most), summed in
    the task before they are shuffled."""
    names = ["clean", "toxic", "toxic_docs"]

    def count(batches):
        totals = tuple(Counter() for _ in names)

        def flush():
            stems = sorted(set(totals[0]) | set(totals[1]))
            columns = [pa.array(stems, pa.string()), *[pa.array([c[s] for s in stems], pa.int64()) for c in totals]]
            for c in totals:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["stem", *names])

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = Counter(fold(text).split())
                own: Counter = Counter()
                for word, n in words.items():
                    for k in STEM_LENGTHS:
                        if k <= len(word):
                            own[word[:k]] += n
                totals[y].update({stem: min(n, 5) for stem, n in own.items()})
                if y:
                    totals[2].update(own.keys())
                if len(totals[0]) + len(totals[1]) > 200_000:
                    yield flush()
        yield flush()

    counted = train.mapInArrow(count, "stem string, clean bigint, toxic bigint, toxic_docs bigint")
    return counted.groupBy("stem").agg(*[F.sum(n).alias(n) for n in names])


def _contexts(train: DataFrame, stems: list[str]) -> DataFrame:
    """(stem, word, next word, y) of every candidate stem in the training texts."""
    rough = Lexicon(dict.fromkeys(stems, 1.0))

    def find(batches):
        automaton = rough.automaton()
        for batch in batches:
            rows = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                folded = fold(text)
                for end, stem in automaton.iter(folded):
                    # The whole word that the stem begins, and the whole word after it, however long.
                    start = end - len(stem) + 1
                    gap = folded.find(" ", start)
                    after = folded.find(" ", gap + 1) if gap >= 0 else -1
                    word = folded[start:gap] if gap >= 0 else folded[start:]
                    rows.append((stem, word, folded[gap + 1 : after] if after >= 0 else "", y))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["stem", "word", "next", "y"])

    found = train.mapInArrow(find, "stem string, word string, next string, y int")
    return found.groupBy("stem", "word", "next").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")
    )


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, exceptions: tuple[str, ...] = (),
    least_count: int = 3, least_share: float = 0.005, least_odds: float = 3.0, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
) -> Lexicon:
    """Stems that ``least_share`` of the toxic documents without near copies, ``least_count`` at least, and as many
    contexts have, with log-odds of ``least_odds`` or more."""
    train = cut_lineage(training_rows(docs, labels, label, rows, doc_id, text), "toxicity-train")
    counted = without_copies(train)
    sizes = dict(counted.groupBy("y").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    least_count = max(least_count, math.ceil(least_share * n_toxic))
    lexicon = Lexicon(exceptions={fold(e).strip() for e in exceptions})
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    candidates = (
        _stem_counts(counted).withColumn("odds", odds)
        .filter((F.col("toxic_docs") >= least_count) & (F.col("odds") >= least_odds))
        .orderBy(F.desc("toxic_docs"), F.desc("odds"), "stem").collect()
    )
    if candidates:
        by_context = cut_lineage(_contexts(counted, [c["stem"] for c in candidates]), "toxicity-contexts")
        varied = by_context.groupBy("stem").agg(F.count_if(F.col("toxic") > 0).alias("n"))
        contexts = dict(varied.collect())
        known = {c["stem"]: c for c in candidates if contexts.get(c["stem"], 0) >= least_count}
        kept = _without_nested(known)
        lexicon.weights = {s: float(known[s]["odds"]) for s in kept}
        benign = by_context.filter((F.col("clean") >= least_count) & (F.col("toxic") == 0) & F.col("stem").isin(kept))
        rows_ = benign.select(F.concat_ws(" ", "word", "next").alias("phrase")).distinct().orderBy("phrase").collect()
        lexicon.exceptions |= {r["phrase"].strip() for r in rows_}

    def measure():
        automaton = lexicon.automaton()

        def run(texts):
            x = features(texts, lexicon, automaton)
            return [pa.array(x[:, 0]), pa.array(x[:, 1])]

        return run

    sample = map_texts(train, ["y"], "text", measure, [("a", "double"), ("b", "double")]).toPandas()
    weights, lexicon.intercept = fit_logistic(sample[["a", "b"]].to_numpy(float), sample["y"].to_numpy(float))
    lexicon.curve = (float(weights[0]), float(weights[1]))
    return lexicon


def _without_nested(known: dict) -> list[str]:
    """Of stems that begin with one another, the longest that loses next to nothing, and none below it."""
    kept: list[str] = []
    by_length = sorted(known, key=lambda s: (len(s), s))
    best_longer: dict[str, int] = {}
    for stem in reversed(by_length):
        for k in STEM_LENGTHS:
            if k < len(stem):
                best_longer[stem[:k]] = max(best_longer.get(stem[:k], 0), known[stem]["toxic_docs"])
    for stem in by_length:
        if best_longer.get(stem, 0) >= 0.95 * known[stem]["toxic_docs"]:
            continue
        if not any(stem[:k] in kept for k in STEM_LENGTHS if k < len(stem)):
            kept.append(stem)
    return kept


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""

    def make():
        automaton = lexicon.automaton()

        def run(texts):
            score = sigmoid(features(texts, lexicon, automaton) @ np.array(lexicon.curve) + lexicon.intercept)
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

        return run

    return append_columns(docs, text, make, [("score", "double"), ("predicted", "int")])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn_lexicon(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, lexicon).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
