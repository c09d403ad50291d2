"""Repeated word n-grams of a text.

Counting n-grams with joins or windows would shuffle every word of the corpus once per
size. A text lies in one row, so its n-grams are counted there: one Arrow batch at a
time, with array operations over all texts of the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from .batches import list_lengths, parts


def _batch_counts(batch: pa.ListArray, top_sizes: Sequence[int], dup_sizes: Sequence[int]) -> dict[str, np.ndarray]:
    docs = len(batch)
    lengths = list_lengths(batch)
    values = batch.flatten()
    total = len(values)
    out = {f"top_{n}": np.zeros(docs, np.int64) for n in top_sizes}
    out |= {f"dup_{n}": np.zeros(docs, np.int64) for n in dup_sizes}
    if total == 0:
        return out
    encoded = values.dictionary_encode()
    word = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = np.int64(len(encoded.dictionary))
    chars = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    chars_before = np.concatenate(([0], np.cumsum(chars)))
    doc = np.repeat(np.arange(docs), lengths)
    words_left = np.repeat(np.cumsum(lengths), lengths) - np.arange(total)

    # An n-gram is numbered by the number of its (n-1)-gram and its last word. The
    # document takes part in the first number, so equal numbers mean the same text too.
    start = np.arange(total)
    gram = np.unique(doc * vocabulary + word, return_inverse=True)[1]
    first_dup = min(dup_sizes, default=0)
    last_top = max(top_sizes, default=0)
    for n in range(2, max([*top_sizes, *dup_sizes]) + 1):
        fits = words_left[start] >= n
        start, gram = start[fits], gram[fits]
        if len(start) == 0:
            break
        _, gram, count = np.unique(gram * vocabulary + word[start + n - 1], return_inverse=True, return_counts=True)
        times = count[gram]
        if n in top_sizes:
            length = chars_before[start + n] - chars_before[start] + (n - 1)
            edges = np.flatnonzero(np.diff(doc[start], prepend=-1))
            # Highest count first, then the longest n-gram.
            best = np.maximum.reduceat((times << 32) + length, edges)
            out[f"top_{n}"][doc[start[edges]]] = (best >> 32) * (best & 0xFFFFFFFF)
        repeated = times > 1
        if n in dup_sizes:
            opens = np.bincount(start[repeated], minlength=total + 1)
            closes = np.bincount(start[repeated] + n, minlength=total + 1)
            covered = np.cumsum(opens - closes)[:total] > 0
            out[f"dup_{n}"] = np.bincount(doc, weights=chars * covered, minlength=docs).astype(np.int64)
        if n >= last_top and n + 1 >= first_dup:
            # Longer repeats can only begin where this n-gram is repeated.
            start, gram = start[repeated], gram[repeated]
    return out


def repeated_ngram_chars(words: Column, top_sizes: Sequence[int], dup_sizes: Sequence[int]) -> Column:
    """Struct of character counts per text: ``top_n`` for the most frequent n-gram
    (occurrences times its length, blanks included), ``dup_n`` for all words that lie in
    an n-gram occurring more than once, each word counted once. NULL words give zeros."""
    fields = [f"top_{n}" for n in top_sizes] + [f"dup_{n}" for n in dup_sizes]

    @F.arrow_udf(", ".join(f"{name} bigint" for name in fields))
    def count(batch: pa.Array) -> pa.Array:
        found = [_batch_counts(part, top_sizes, dup_sizes) for part in parts(batch)]
        columns = [np.concatenate([counts[name] for counts in found]) for name in fields]
        return pa.StructArray.from_arrays([pa.array(column, pa.int64()) for column in columns], names=fields)

    return count(words)
