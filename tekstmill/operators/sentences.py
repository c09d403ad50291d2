"""Sentence cuts that know the corpus's abbreviations.

A cut follows a run of ``.``, ``!`` or ``?`` that stands before white space or at the end of the text, so a period
inside a token (``3.5``, ``bl.a``) never cuts. A single period that ends a token whose type is an abbreviation does not
cut either (``kl. 12``, ``bl.a. det``).

Abbreviations are learned from the corpus itself, after Kiss and Strunk (2006), by aggregates: a type is a token (run
of non-blanks) lower-cased, without one final period, made of letters and inner periods and beginning with a letter.
For each type, C(w.) counts its tokens with a final period and C(w) all its tokens; N counts all tokens and N. those
with a final period. The log-likelihood ratio of the collocation of type and period, -2 log(L(H0) / L(H1)) with
P(.|w) = N./N under H0 and 0.99 under H1, is scaled by exp(-letters), by the number of inner periods plus one and by
letters^-(C(w) - C(w.)); a type scoring at least ``threshold`` (0.3) whose tokens end in a period at least once is an
abbreviation if it also has inner periods or one of its period-final tokens is followed by a token that begins with
a lower-case letter or a digit (the orthographic evidence of the paper; words that only end sentences are followed by
capitals). The table (type, with_period, tokens, lower_next, score) is written to the shared folder.

Applying it: up to ``literal_rows`` abbreviations, the table becomes one hashed set of literals in the plan (Spark
turns a long ``isin`` into a hash set), checked by its size; above that, candidate tokens are joined with the table,
and only the positions of protected periods travel back to their documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.settle import settle
from ..plans.lineage import cut_lineage

# White space as a class of its own, so that Java's and RE2's patterns agree.
BLANK = r"[ \t\n\x0B\f\r]"
TYPE = r"^\p{L}[\p{L}.]*$"
PIECE = rf"(?s).+?(?:[.!?]+(?:{BLANK}|\z)|\z)"
TOKENS = rf"[^ \t\n\x0B\f\r]+|{BLANK}+"
# Stands in for a protected period while a text is cut; a character of the private use area.
KEEP = "\ue000"
LITERAL_ROWS = 20_000


def learn_abbreviations(docs: DataFrame, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(type, with_period, tokens, lower_next, score) of every abbreviation of the texts, written and read back."""
    split = settle(docs.select(text), "ts", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANK + "+"), ""))
    # The last token has NULL after it.
    pairs = F.arrays_zip(F.col("ts").alias("t"), F.slice("ts", F.lit(2), F.array_size("ts")).alias("next"))
    tokens = split.select(F.inline(pairs))
    final = F.col("t").endswith(".") & ~F.col("t").endswith("..")
    lower_next = final & F.coalesce(F.col("next").rlike(r"^[\p{Ll}\p{N}]"), F.lit(False))
    # The texts are read once: tokens are counted as they stand, and what follows sees each distinct one once.
    counted = tokens.select("t", lower_next.alias("lower_next")).groupBy("t", "lower_next").agg(F.count(F.lit(1)).alias("times"))
    counted = cut_lineage(counted, "tokens")
    typed = counted.select(
        F.lower(F.when(final, F.expr("substring(t, 1, length(t) - 1)")).otherwise(F.col("t"))).alias("type"),
        F.when(final, F.col("times")).otherwise(0).alias("final"),
        F.when(F.col("lower_next"), F.col("times")).otherwise(0).alias("lower_next"),
        "times",
    )
    # Totals and per-type counts in one aggregation each; the totals are two numbers.
    totals = typed.agg(F.sum("times").alias("n"), F.sum("final").alias("n_final")).first()
    n, n_final = totals["n"] or 0, totals["n_final"] or 0
    counts = typed.filter(F.col("type").rlike(TYPE)).groupBy("type").agg(
        F.sum("final").alias("with_period"), F.sum("times").alias("tokens"), F.sum("lower_next").alias("lower_next")
    )
    if n == 0 or n_final == 0:
        return cut_lineage(counts.withColumn("score", F.lit(0.0)).limit(0), "abbreviations")
    p0 = min(max(n_final / n, 1e-12), 1 - 1e-12)
    k, m = F.col("with_period"), F.col("tokens")
    null = k * math.log(p0) + (m - k) * math.log(1 - p0)
    alternative = k * math.log(0.99) + (m - k) * math.log(0.01)
    letters = F.length(F.regexp_replace("type", r"\.", ""))
    inner = F.length("type") - letters + 1
    score = -2 * (null - alternative) * F.exp(-letters) * inner * F.pow(letters, -(m - k))
    found = counts.filter(k > 0).withColumn("score", score)
    found = found.filter((F.col("score") >= threshold) & ((inner > 1) | (F.col("lower_next") > 0)))
    return cut_lineage(found, "abbreviations")


def _protect_tokens(tokens: Column, is_abbreviation) -> Column:
    """Tokens with the final period of every abbreviation replaced by ``KEEP``."""

    def protect(t: Column) -> Column:
        single = t.endswith(".") & ~t.endswith("..")
        kind = F.lower(F.substring(t, F.lit(1), F.length(t) - 1))
        return F.when(single & is_abbreviation(kind), F.concat(F.substring(t, F.lit(1), F.length(t) - 1), F.lit(KEEP))).otherwise(t)

    return F.transform(tokens, protect)


def cut_sentences(protected: Column) -> Column:
    """Sentences of a text whose protected periods are ``KEEP``; they join to the text."""
    return F.transform(F.regexp_extract_all(protected, F.lit(PIECE), F.lit(0)), lambda s: F.replace(s, F.lit(KEEP), F.lit(".")))


def learned_sentences(docs: DataFrame, abbreviations: DataFrame, key: str = "doc_id", text: str = "text", literal_rows: int = LITERAL_ROWS) -> DataFrame:
    """``docs`` with ``sentences``: the texts cut at sentence ends, abbreviations of the table kept whole. A NULL text
    has no sentences."""
    size = abbreviations.count()
    tokens = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKENS), F.lit(0))
    if size <= literal_rows:
        known = [r["type"] for r in abbreviations.select("type").collect()]
        protected = F.array_join(_protect_tokens(tokens, lambda kind: kind.isin(known) if known else F.lit(False)), "")
        # Settled, or whoever explodes the sentences has them cut twice: once for their number.
        return settle(docs, "sentences", F.when(F.col(text).isNotNull(), cut_sentences(protected)).otherwise(F.array()))
    # Beyond the bound: join the candidates, bring back the places of protected periods.
    spread = docs.select(key, F.posexplode(tokens).alias("__i", "__t")).filter(F.col("__t").endswith("."))
    spread = spread.withColumn("type", F.lower(F.substring("__t", F.lit(1), F.length("__t") - 1)))
    places = spread.join(abbreviations.select("type"), "type", "left_semi").groupBy(key).agg(F.collect_list("__i").alias("__places"))
    joined = docs.join(places, key, "left")
    indexed = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    marked = F.transform(
        indexed,
        lambda x: F.when(
            F.coalesce(F.array_contains("__places", x["i"]), F.lit(False)) & ~x["t"].endswith(".."),
            F.concat(F.substring(x["t"], F.lit(1), F.length(x["t"]) - 1), F.lit(KEEP)),
        ).otherwise(x["t"]),
    )
    out = joined.withColumn("sentences", F.when(F.col(text).isNotNull(), cut_sentences(F.array_join(marked, ""))).otherwise(F.array()))
    return out.drop("__places")
