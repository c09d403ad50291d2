"""Near-duplicate documents: MinHash bands, connected components, one survivor each.

``key`` must identify a row. Signatures never leave their row; what is shuffled are band
keys of 16 bytes, and then only pairs of document keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.minhash import MinHashPlan, band_keys, signature
from ..functions.settle import settle
from .components import connected_components
from ..plans.lineage import cut_lineage
from .skew import HOT_ROWS, join_facts


def minhash_signatures(
    docs: DataFrame, key: str = "doc_id", text_col: str = "text", plan: MinHashPlan = MinHashPlan()
) -> DataFrame:
    """(key, signature) for every text long enough to have a shingle."""
    texts = docs.select(key, F.col(text_col).alias("_text"))
    signed = settle(texts, "signature", signature(F.col("_text"), plan)).drop("_text")
    return signed.filter(F.col("signature").isNotNull())


def match_buckets(
    signatures: DataFrame, key: str = "doc_id", plan: MinHashPlan = MinHashPlan(), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Edges (src, dst) with src > dst between documents that share a band.

    Each document is linked to the first one of its band and to no other, so a band of
    any size gives a star: as many edges as documents, and the same components as all
    its pairs. A band that a large part of the corpus shares is split, see ``join_facts``.
    """
    bands = signatures.select(key, F.explode(band_keys(F.col("signature"), plan)).alias("band"))
    # Written once: the bands are looked at twice, but their signatures cost a pass over
    # all texts.
    bands = cut_lineage(bands, "bands")
    firsts = (
        bands.groupBy("band")
        .agg(F.min(key).alias("dst"), F.count(F.lit(1)).alias("_members"))
        .filter(F.col("_members") > 1)
    )
    firsts = cut_lineage(firsts, "shared-bands")
    linked = join_facts(bands, firsts, "band", "_members", F.col(key), hot_rows)
    return linked.filter(F.col(key) > F.col("dst")).select(F.col(key).alias("src"), "dst").distinct()


def duplicate_clusters(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, cluster) for all documents with a match; a cluster is named by its first."""
    return connected_components(edges, hot_rows)


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def removed_ids(members: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of all documents but the first of each cluster."""
    return members.filter(F.col("node") != F.col("cluster")).select(F.col("node").alias(key), "cluster")


def mark_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    plan: MinHashPlan = MinHashPlan(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``docs`` with ``cluster``: NULL where a document stays, else the document that stays in its place."""
    edges = match_buckets(minhash_signatures(docs, key, text_col, plan), key, plan, hot_rows)
    return docs.join(removed_ids(duplicate_clusters(edges, hot_rows), key), key, "left")


def deduplicate_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    plan: MinHashPlan = MinHashPlan(),
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(kept, removed); ``removed`` carries the ``cluster`` whose first document stays.
    The ids to remove have been written by now, so their size is known and Spark
    broadcasts them only when they are small."""
    edges = match_buckets(minhash_signatures(docs, key, text_col, plan), key, plan, hot_rows)
    gone = removed_ids(duplicate_clusters(edges, hot_rows), key)
    return docs.join(gone, key, "left_anti"), docs.join(gone, key, "inner")
