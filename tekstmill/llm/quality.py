"""Quality by a document classifier and hierarchical empirical Bayes over sites.

The classifier is a logistic regression on the frequencies of byte class pairs, on how well a text compresses and on
its length. Its probabilities, summed over all documents by host and by path below it, give site rates: each path is
shrunk toward its host and each host toward the global rate, by prior strengths estimated from the spread between
sites (method of moments). A document's score is its own evidence with the global prior exchanged for that of its
path. Only the grouped sums leave the documents; a host of any size is a few rows.

Inputs: NULL and the empty text are scored on zero frequencies. NULL hosts and paths form sites of their own. Copies
score alike. Labels that are NULL or neither 0 nor 1 are not used; without usable labels every document has one
probability. An empty table gives an empty result. Extra columns pass through; those with the name of an output are
replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import append_columns, cut_lineage, map_texts, read_table
from .training import fit_logistic, held_out, training_rows

# Documents learned from, at most.
TRAIN_ROWS = 6_000


def _byte_classes() -> tuple[np.ndarray, int]:
    own = [b" ", b"\n", b".", b",", b"!", b"?", b"#", b"$", b"%", b"&", b"*", b"|", b"-", b"@", b"/", b":", b"'\""]
    classes = np.full(256, len(own), np.int32)
    for k, letters in enumerate(own):
        classes[list(letters)] = k
    for k, (low, high) in enumerate([(ord("a"), ord("z")), (ord("A"), ord("Z")), (ord("0"), ord("9")), (128, 191), (192, 255)], 1):
        classes[low : high + 1] = len(own) + k
    classes[list(b"aeiou")] = len(own) + 6
    return classes, len(own) + 7


CLASSES, N_CLASSES = _byte_classes()
N_FEATURES = N_CLASSES * N_CLASSES + 2


def document_features(texts: list[str]) -> np.ndarray:
    """Square roots of class pair frequencies, compressed share, log length."""
    out = np.zeros((len(texts), N_FEATURES))
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        if not raw:
            continue
        codes = CLASSES[np.frombuffer(raw, np.uint8)]
        pairs = np.bincount(codes[:-1] * N_CLASSES + codes[1:], minlength=N_CLASSES * N_CLASSES)
        out[i, :-2] = np.sqrt(pairs / max(1, len(raw) - 1))
        out[i, -2] = min(1.5, len(zlib.compress(raw, 1)) / len(raw))
        out[i, -1] = np.log1p(len(raw))
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float

    def logits(self, texts: list[str]) -> np.ndarray:
        return document_features(texts) @ self.weights + self.intercept


def learn_classifier(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label: str = "quality", doc_id: str = "doc_id", text: str = "text"
) -> QualityModel:
    """Logistic regression on at most ``rows`` labelled documents that are not held out."""
    train = training_rows(docs, labels, label, rows, doc_id, text)

    def make():
        def run(texts):
            x = document_features(texts)
            return [pa.array([row.tobytes() for row in x.astype(np.float32)], pa.binary())]

        return run

    sample = map_texts(train, ["y"], "text", make, [("x", "binary")]).toPandas()
    x = np.frombuffer(b"".join(bytes(v) for v in sample["x"]), np.float32).reshape(len(sample), N_FEATURES)
    weights, intercept = fit_logistic(x.astype(float), sample["y"].to_numpy(float), l2=2.0)
    return QualityModel(weights, intercept)


def document_logits(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``doc_logit``."""
    return append_columns(docs, text, lambda: lambda texts: [pa.array(model.logits(texts))], [("doc_logit", "double")])


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def _shrink(sites: DataFrame, above: Column, limits: tuple[float, float]) -> Column:
    """Prior strength by the method of moments: with weighted spread v of site rates about the rates above, and
    sampling variance m(1-m) of one document, strength is m(1-m)/(excess of v over sampling) - 1, within limits."""
    rate = F.col("p_sum") / F.col("n")
    sampling = F.sum(above * (1 - above)) / F.sum("n")
    spread = F.sum(F.col("n") * (rate - above) * (rate - above)) / F.sum("n")
    excess = spread - sampling
    mean = F.sum(F.col("n") * above * (1 - above)) / F.sum("n")
    strength = F.when(excess > 1e-6, mean / excess - 1).otherwise(F.lit(limits[1]))
    return F.least(F.greatest(strength, F.lit(limits[0])), F.lit(limits[1]))


def site_rates(
    logits: DataFrame, host: str = "host", path: str = "path", limits: tuple[float, float] = (2.0, 1000.0)
) -> DataFrame:
    """(host, path, n, host_rate, path_rate, global_rate) from ``doc_logit`` of all documents.

    A group of any size is pre-aggregated to one row per task before it is shuffled.
    """
    p = _probability(F.col("doc_logit"))
    keyed = logits.select(F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), p.alias("p"))
    paths = cut_lineage(keyed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("p_sum")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("p_sum").alias("p_sum"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("p_sum").alias("p_sum")).select(
        ((F.col("p_sum") + 0.5) / (F.col("n") + 1)).alias("g")
    )
    top = whole.first()["g"] or 0.5  # one number
    above = F.lit(float(top))
    host_strength = hosts.agg(_shrink(hosts, above, limits).alias("k")).first()["k"] or limits[1]
    hosts = hosts.select("host", ((F.col("p_sum") + host_strength * above) / (F.col("n") + host_strength)).alias("host_rate"))
    with_host = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    path_strength = with_host.agg(_shrink(with_host, F.col("host_rate"), limits).alias("k")).first()["k"] or limits[1]
    path_rate = (F.col("p_sum") + path_strength * F.col("host_rate")) / (F.col("n") + path_strength)
    return with_host.select("host", "path", "n", "host_rate", path_rate.alias("path_rate"), above.alias("global_rate"))


def score_quality(
    docs: DataFrame, model: QualityModel, host: str, path: str, text: str = "text", threshold: float = 0.5,
    limits: tuple[float, float] = (2.0, 1000.0),
) -> DataFrame:
    """``docs`` with ``doc_score``, ``site_rate``, ``quality_score`` and ``kept`` (a score of ``threshold`` or more).

    Documents are read twice, once for the sums and once for the scores, so that no text is shuffled: the site table
    is written first, and Spark broadcasts it where its true size allows.
    """
    sums = document_logits(docs.select(host, path, text), model, text)
    sites = site_rates(sums, host, path, limits).select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("path_rate").alias("site_rate"), "global_rate"
    )
    sites = cut_lineage(sites, "sites")
    scored = document_logits(docs.drop("site_rate", "global_rate", "doc_score", "quality_score", "kept"), model, text)
    on = scored[host].cast("string").eqNullSafe(F.col("__host")) & scored[path].cast("string").eqNullSafe(F.col("__path"))
    joined = scored.join(sites, on, "left").drop("__host", "__path")
    score = _probability(F.col("doc_logit") + _logit(F.col("site_rate")) - _logit(F.col("global_rate")))
    return joined.withColumns({"doc_score": _probability(F.col("doc_logit")), "quality_score": score}).withColumn(
        "kept", F.col("quality_score") >= threshold
    ).drop("doc_logit", "global_rate")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the hosts are the sources, the paths below them the languages."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = learn_classifier(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, "source", "lang")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "doc_score", "site_rate", "quality_score", "kept")
