"""URL filter: rules by host and path, else multinomial naive Bayes over words of the host and tokens of the path.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path: from there up to ``?``,
``#`` or the end. A NULL url or one without ``://`` has both empty. A rule fits a host equal to its own or ending in
``.`` and its own, if the path starts with the rule's path; of the rules that fit, the longest (host and path) wins,
and of equally long ones the first in text order.

Where no rule fits, naive Bayes decides. Its words: every label of the host is cut into runs of letters and of digits,
and each run of letters is segmented into words by a unigram Viterbi search whose counts are the lower-case letter
words of the whole corpus (every document; a run that no split explains is taken as unknown words, each priced by its
length). Path tokens are the runs of letters and of digits of the lower-cased path. The classes are the rules'
verdicts: every url that a rule fits is a training example of its rule's verdict, so the method carries the rules
over to the hosts and paths they don't name. Multinomial, add-one smoothing, tokens unseen in training ignored; a tie
or an empty training set gives ``allow``.

Everything is computed on distinct hosts, distinct (host, path) pairs and distinct tokens, and joined back to the
urls by ``join_facts``, so a host or a token that a third of all urls share is dealt over many tasks. Segmentation
candidates are substrings of host runs joined with the word counts; nothing is broadcast but the four fixed rules,
which are a column expression. Extra columns are not read; repeated urls give repeated, equal rows; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tekstmill.operators.skew import join_facts

from .common import cut_lineage, read_table

# Fixed values of the task: (host, path, verdict) of the rules, in text order.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# An unknown run of k letters costs log(UNKNOWN / (words * 10^k)), after the usual unigram segmenter.
UNKNOWN = 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, both empty where it is NULL or has no ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.coalesce(url, F.lit("")).substr(at + 3, F.lit(1 << 30))
    rest = F.when(at > 0, rest).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULLs where none does."""
    ordered = sorted(enumerate(rules), key=lambda r: (-len(r[1][0]) - len(r[1][1]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, (h, p, v) in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) of lower-case letter words of all texts."""
    words = F.explode(F.split(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z]+", " "), " "))
    return docs.select(words.alias("word")).filter("word != ''").groupBy("word").agg(F.count("*").alias("count"))


def viterbi(run: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest split of ``run`` into words; ``known`` maps (start, end) of corpus words to their counts."""
    n = len(run)
    total = max(total, 1)
    best = [0.0] + [-math.inf] * n
    back = [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(end):
            count = known.get((start, end))
            if count:
                score = math.log(count / total)
            else:
                score = math.log(UNKNOWN / total) - (end - start) * math.log(10.0)
            if best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    words, end = [], n
    while end > 0:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def segment_runs(runs: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(run, words) for every distinct run of letters, from the corpus counts of its substrings."""
    longest = counts.agg(F.max(F.length("word"))).first()[0] or 0
    spans = runs.select(
        "run",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(0), F.length("run") - 1),
                    lambda s: F.transform(
                        F.sequence(F.lit(1), F.least(F.length("run") - s, F.lit(max(longest, 1)))),
                        lambda k: F.struct(s.alias("start"), (s + k).alias("end")),
                    ),
                )
            )
        ).alias("span"),
    ).select("run", "span.start", "span.end", F.substring("run", F.col("start") + 1, F.col("end") - F.col("start")).alias("word"))
    found = spans.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("start", "end", "count")).alias("found"))
    found = runs.join(found, "run", "left")

    @F.pandas_udf("array<string>")
    def split(run: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for r, f in zip(run, found):
            known = {} if f is None else {(int(x["start"]), int(x["end"])): int(x["count"]) for x in f}
            out.append(viterbi(r, known, total))
        return pd.Series(out)

    return found.select("run", split("run", "found").alias("words"))


def url_tokens(pairs: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(host, path, token) with ``h:`` words of the host and ``p:`` tokens of the path, repeats kept."""
    parts = pairs.select("host", "path", F.explode(F.regexp_extract_all("host", F.lit("([a-z]+|[0-9]+)"), 1)).alias("run"))
    letters = parts.filter(F.col("run").rlike("^[a-z]"))
    segmented = segment_runs(letters.select("run").distinct(), counts, total)
    host_words = letters.join(segmented, "run").select("host", "path", F.explode("words").alias("t"))
    digits = parts.filter(~F.col("run").rlike("^[a-z]")).select("host", "path", F.col("run").alias("t"))
    path_words = pairs.select(
        "host", "path", F.explode(F.regexp_extract_all(F.translate("path", UPPER, LOWER), F.lit("([a-z]+|[0-9]+)"), 1)).alias("t")
    )
    host_part = host_words.unionByName(digits).select("host", "path", F.concat(F.lit("h:"), "t").alias("token"))
    return host_part.unionByName(path_words.select("host", "path", F.concat(F.lit("p:"), "t").alias("token")))


def naive_bayes(tokens: DataFrame, labelled: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(token, allow, block) log-likelihoods learned from the tokens of ``labelled`` (host, path, label, rows), and the
    log priors of the classes."""
    examples = labelled.groupBy("label").agg(F.sum("rows").alias("rows")).collect()
    rows = {r["label"]: r["rows"] for r in examples}
    taught = tokens.join(labelled, ["host", "path"]).groupBy("token").pivot("label", ["allow", "block"]).agg(F.sum("rows"))
    taught = taught.na.fill(0, ["allow", "block"])
    sums = taught.agg(F.count("*"), F.sum("allow"), F.sum("block")).first()
    vocabulary, totals = sums[0] or 0, {"allow": sums[1] or 0, "block": sums[2] or 0}
    all_rows = sum(rows.values())
    priors = {c: math.log((rows.get(c, 0) + 1) / (all_rows + 2)) for c in ("allow", "block")}
    model = taught.select(
        "token",
        *[F.log((F.col(c) + 1) / F.lit(totals[c] + vocabulary)).alias(c) for c in ("allow", "block")],
    )
    return model, priors


def judge_urls(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """id, host, path, rule, verdict (and the method's ``nb_verdict``, ``nb_margin``) of every url."""
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    pairs = urls.groupBy("host", "path").agg(F.count("*").alias("rows")).select("*", rule.alias("rule"), verdict.alias("label"))
    # Counted once and written: the length of the longest word, the sum and the join all read the written table.
    counts = cut_lineage(word_counts(docs), "url-words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    tokens = url_tokens(pairs.select("host", "path"), counts, total)
    model, priors = naive_bayes(tokens, pairs.filter("label is not null").select("host", "path", "label", "rows"))
    # Tokens are joined with the model by frequency, so that a token of every url is dealt over many tasks.
    weights = tokens.groupBy("token").agg(F.count("*").alias("__weight"))
    facts = model.join(weights, "token")
    scored = join_facts(tokens, facts, "token", "__weight", F.concat_ws("/", "host", "path"))
    sums = scored.groupBy("host", "path").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    margin = F.coalesce(F.col("block"), F.lit(0.0)) + priors["block"] - F.coalesce(F.col("allow"), F.lit(0.0)) - priors["allow"]
    judged = pairs.join(sums, ["host", "path"], "left").select(
        "host", "path", "rows", "rule",
        F.when(margin > 0, "block").otherwise("allow").alias("nb_verdict"), margin.alias("nb_margin"),
        F.coalesce("label", F.when(margin > 0, "block").otherwise("allow")).alias("verdict"),
    )
    facts = judged.select(F.concat_ws("\u0000", "host", "path").alias("__pair"), "rule", "verdict", "nb_verdict", "nb_margin", "rows")
    keyed = urls.select("*", F.concat_ws("\u0000", "host", "path").alias("__pair"))
    out = join_facts(keyed, facts, "__pair", "rows", F.col("__id"))
    return out.select(F.col("__id").alias(id_col), "host", "path", "rule", "verdict", "nb_verdict", "nb_margin")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` judged by the rules, else by naive Bayes over segmented hosts, with corpus word counts."""
    return judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))
