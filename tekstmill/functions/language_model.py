"""Language by a hashed character n-gram model with a posterior (multinomial naive Bayes, add-k smoothing).

Each word (run of letters, lower-cased) padded by a blank on each side is cut into trigrams, which are hashed into
``buckets`` (md5, first 8 hex digits, modulo the number of buckets, so that other engines can compute the same). The
model counts buckets per language by aggregation over labelled texts, words counted first so that each distinct one is
cut once. log P(bucket | language) = log((count + k) / (total + k * buckets)). A background class of all languages
pooled stands for text that fits none of them better. A text's score is its posterior under equal priors:
softmax over classes of the summed log-likelihoods of its trigrams. ``language`` is the best class (``und`` where the
background wins, NULL where the text has no letters), ``language_prob`` its posterior.

The model reaches the scoring tasks as one array of classes x buckets 64-bit floats, whose size is checked against
``max_model_bytes``; languages beyond it are an error, not a truncation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import list_lengths, parts
from .language import LETTERS, trigrams
from .settle import settle

BUCKETS = 1 << 16
SMOOTHING = 0.5
BACKGROUND = "und"
MAX_MODEL_BYTES = 256 << 20


def bucket_of(gram: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def learn_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n): trigram counts per language of labelled texts; rows without a label are not read."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(LETTERS), F.lit(0)))
    labelled = docs.filter(F.col(lang_col).isNotNull())
    counted = labelled.select(F.col(lang_col).alias("lang"), words.alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("times")
    )
    grams = counted.select("lang", "times", F.explode(trigrams(F.col("word"))).alias("gram"))
    return grams.groupBy("lang", bucket_of(F.col("gram"), buckets).alias("bucket")).agg(F.sum("times").alias("n"))


class LanguageModel:
    """Log-probabilities of classes (languages, then the background) over buckets."""

    def __init__(self, counts: DataFrame, buckets: int = BUCKETS, k: float = SMOOTHING, max_model_bytes: int = MAX_MODEL_BYTES):
        languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        size = (len(languages) + 1) * buckets * 8
        if size > max_model_bytes:
            raise ValueError(f"A model of {len(languages)} languages x {buckets} buckets takes {size} bytes, above {max_model_bytes}.")
        table = np.zeros((len(languages) + 1, buckets), np.float64)
        place = {lang: i for i, lang in enumerate(languages)}
        # At most languages x buckets rows, the size checked above.
        for row in counts.toLocalIterator():
            table[place[row["lang"]], row["bucket"]] += row["n"]
        table[-1] = table[:-1].sum(axis=0)
        totals = table.sum(axis=1, keepdims=True)
        self.labels = [*languages, BACKGROUND]
        self.log_probs = np.log((table + k) / (totals + k * buckets))
        self.buckets = buckets


def gram_buckets(word: str, buckets: int) -> list[int]:
    padded = f" {word} "
    return [int(hashlib.md5(padded[i : i + 3].encode()).hexdigest()[:8], 16) % buckets for i in range(len(word))]


def _posterior(words: Column, model: LanguageModel) -> Column:
    labels, log_probs, buckets = model.labels, model.log_probs, model.buckets

    def score(batch: pa.ListArray) -> pa.StructArray:
        lengths = list_lengths(batch)
        lettered = lengths > 0
        label, prob = np.full(len(batch), None, object), np.zeros(len(batch))
        if lettered.any():
            encoded = batch.flatten().dictionary_encode()
            # Log-likelihood of every distinct word in every class, from its trigrams.
            per_word = np.array(
                [log_probs[:, gram_buckets(w, buckets)].sum(axis=1) for w in encoded.dictionary.to_pylist()], np.float64
            ).reshape(-1, len(labels))
            ids = encoded.indices.to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths[lettered]) - lengths[lettered]
            totals = np.add.reduceat(per_word[ids], starts, axis=0)
            shifted = totals - totals.max(axis=1, keepdims=True)
            posterior = np.exp(shifted) / np.exp(shifted).sum(axis=1, keepdims=True)
            best = totals.argmax(axis=1)
            label[lettered] = np.array(labels, object)[best]
            prob[lettered] = posterior[np.arange(len(best)), best]
        return pa.StructArray.from_arrays(
            [pa.array(label, pa.string()), pa.array(prob, pa.float64(), mask=~lettered)], names=["label", "prob"]
        )

    @F.arrow_udf("label string, prob double")
    def posterior(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([score(part) for part in parts(batch)])

    return posterior(words)


def score_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``language`` and ``language_prob``; NULL for a text without letters."""
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(LETTERS), F.lit(0))
    return settle(docs, "_lm", _posterior(words, model)).select(
        *docs.columns, F.col("_lm.label").alias("language"), F.col("_lm.prob").alias("language_prob")
    )
