"""Near-duplicate join of documents by word n-grams: MinHash LSH forest, exact verification.

Texts are sets of hashed five-word shingles of lower-cased words (letters, digits, anything beyond ASCII); a text
with fewer words is one shingle. Equal texts are one class, kept as one row with its number of copies. Each class has
a path of min-hashes in each of several tries. Paths match on prefixes, at first of the full depth; prefixes are
shortened until a pair at the threshold shares one in some trie with the target probability. Classes with a common
prefix are tied to the first of them, so a prefix of any size costs its members only, and the ties' components hold
every candidate pair. Inside them all pairs are verified exactly on the whole shingle sets: a component is dealt into
blocks of bounded size, every two blocks meet in a task, and there a matrix product counts common shingles, so pairs
are never rows.

Inputs: NULL counts as the empty text. Texts without any word match only their equals. Repeated rows are copies of
each other. Ties go to the smallest id; a NULL id comes last. Texts of any length are used whole. An empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tekstmill.operators.components import connected_components

from .common import cut_lineage, map_texts, read_table, text_or_empty


@dataclass(frozen=True)
class ForestPlan:
    words: int = 5
    threshold: float = 0.8
    trees: int = 24
    depth: int = 8
    recall: float = 0.999
    # Size of a block of a component, in classes and in shingles.
    block_rows: int = 512
    block_shingles: int = 2_000_000

    def recall_at(self, depth: int) -> float:
        """Probability that a pair at the threshold shares a prefix of this length in some trie."""
        return 1 - (1 - self.threshold**depth) ** self.trees

    def prefix(self) -> int:
        """The longest prefix with the target recall, shortened label by label."""
        depth = self.depth
        while depth > 1 and self.recall_at(depth) < self.recall:
            depth -= 1
        return depth


# Multipliers of the hash functions come from a fixed seed: every run and every worker has the same.
_RANDOM = np.random.default_rng(20_240_501)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * STEP
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word, from running sums of byte values times powers of a base."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    inside = WORD_BYTES[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    # Position within the word, so that a word's hash doesn't depend on where it stands.
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
    values = BYTE_VALUES[raw[inside]] * powers[place]
    return _mix(np.add.reduceat(values, np.cumsum(lengths) - lengths))


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        total = total * BASE + hashes[k : k + len(total)]
    return np.unique(_mix(total))


class Signer:
    """Min-hash paths of shingle sets, one label of 16 bits per level."""

    def __init__(self, plan: ForestPlan) -> None:
        random = np.random.default_rng(7)
        n = plan.trees * plan.depth
        self.a = random.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = random.integers(0, 2**63, n, dtype=np.uint64)

    def paths(self, items: np.ndarray) -> bytes:
        if not len(items):
            return b""
        low = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(items), 512):
            np.minimum(low, (items[at : at + 512, None] * self.a + self.b).min(0), out=low)
        return (_mix(low) >> np.uint64(48)).astype(np.uint16).tobytes()


def class_of(text: Column) -> Column:
    """Equal texts have equal classes: 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def text_classes(docs: DataFrame, plan: ForestPlan, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(class, text_id, copies, n, paths), one row per distinct text."""
    keyed = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")).withColumn("class", class_of(F.col("text")))

    def make():
        signer = Signer(plan)

        def sign(texts):
            sets = [shingles(t, plan.words) for t in texts]
            return [pa.array([len(s) for s in sets], pa.int32()), pa.array([signer.paths(s) for s in sets], pa.binary())]

        return sign

    signed = map_texts(keyed, ["id", "class"], "text", make, [("n", "int"), ("paths", "binary")])
    first = signed.groupBy("class").agg(
        F.min("id").alias("text_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("paths").alias("paths")
    )
    return cut_lineage(first, "classes")


def candidate_components(classes: DataFrame, plan: ForestPlan) -> DataFrame:
    """(class, component) of all classes that share a prefix with another."""
    level, width = plan.prefix(), 2 * plan.depth
    tree = F.sequence(F.lit(0), F.lit(plan.trees - 1))
    keys = F.transform(tree, lambda t: F.xxhash64(t, F.col("paths").substr(t * width + 1, F.lit(2 * level))))
    prefixes = classes.filter("n > 0").select("class", F.explode(keys).alias("prefix"))
    prefixes = cut_lineage(prefixes, "prefixes")
    shared = prefixes.groupBy("prefix").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("members"))
    ties = prefixes.join(shared.filter("members > 1"), "prefix").filter(F.col("class") > F.col("first"))
    components = connected_components(ties.select(F.col("class").alias("src"), F.col("first").alias("dst")).distinct())
    return components.select(F.col("node").alias("class"), F.col("cluster").alias("component"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Common items of every set of ``left`` with every one of ``right`` (with each other where that is None)."""
    sets = left if right is None else [*left, *right]
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, index, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Items of a single set are common to no two.
    rank = np.cumsum(counts > 1) - 1
    shared = counts[index] > 1
    owners, columns = owners[shared], rank[index[shared]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    n_left = len(left)
    total = np.zeros((n_left, len(sets) if right is None else len(right)), np.float64)
    n_columns = int(columns[-1]) + 1 if len(columns) else 0
    for low in range(0, n_columns, 4096):
        a, b = np.searchsorted(columns, [low, low + 4096])
        part = np.zeros((len(sets), min(4096, n_columns - low)), np.float32)
        part[owners[a:b], columns[a:b] - low] = 1
        total += part[:n_left] @ (part if right is None else part[n_left:]).T
    return total


def link_matrix(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    sizes = np.array([len(s) for s in left], float)
    others = sizes if right is None else np.array([len(s) for s in right], float)
    common = common_counts(left, right)
    links = common >= threshold * (sizes[:, None] + others[None, :] - common) - 1e-9
    if right is None:
        np.fill_diagonal(links, False)
    return links


def _roots(links: np.ndarray) -> np.ndarray:
    """The smallest index that links lead to, for each row of a symmetric matrix."""
    labels = np.arange(len(links))
    while True:
        lowest = np.minimum(labels, np.where(links, labels[None, :], len(labels)).min(1, initial=len(labels)))
        if (lowest == labels).all():
            return labels
        labels = lowest


def _verify(batches, plan: ForestPlan):
    """Links of the rows of each (component, low, high), which come one after another."""

    def rows(batch: pa.RecordBatch):
        items = batch.column("items")
        flat = items.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(items).to_numpy(zero_copy_only=False))])
        plain = [batch.column(c).to_pylist() for c in ("component", "low", "high", "block", "class", "copies")]
        for i, (component, low, high, block, name, copies) in enumerate(zip(*plain)):
            yield (component, low, high), (block, name, copies, flat[ends[i] : ends[i + 1]])

    def answer(key, group):
        _, low, high = key
        left = [g for g in group if g[0] == low]
        right = None if low == high else [g for g in group if g[0] == high]
        everyone = left if right is None else [*left, *right]
        if len(everyone) < 2 or right == [] or not left:
            return []
        links = link_matrix([g[3] for g in left], None if right is None else [g[3] for g in right], plan.threshold)
        if right is not None:
            n = len(left)
            whole = np.zeros((len(everyone), len(everyone)), bool)
            whole[:n, n:], whole[n:, :n] = links, links.T
            links = whole
        copies = np.array([g[2] for g in everyone])
        texts, documents, roots = links.sum(1), links @ copies, _roots(links)
        return [
            (everyone[i][1], int(texts[i]), int(documents[i]), everyone[roots[i]][1])
            for i in np.flatnonzero(texts)
        ]

    names, kinds = ["class", "text_links", "doc_links", "root"], [pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def table(found):
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names=names)

    current, group, found = None, [], []
    for batch in batches:
        for key, row in rows(batch):
            if key != current:
                found += answer(current, group) if group else []
                current, group = key, []
                if len(found) > 10_000:
                    yield table(found)
                    found = []
            # Rows that repeat an id and its text follow each other and are one here.
            if not group or group[-1][1] != row[1]:
                # A copy, so that the row doesn't hold its batch in memory.
                group.append((*row[:3], row[3].copy()))
    found += answer(current, group) if group else []
    yield table(found)


def verified_links(
    docs: DataFrame, classes: DataFrame, components: DataFrame, plan: ForestPlan, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(class, text_links, doc_links, root) per class and pair of blocks in which it has a link."""
    members = cut_lineage(components.join(classes.select("class", "text_id", "copies", "n"), "class"), "members")
    size = members.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("all_n"))
    blocks = F.ceil(F.greatest(F.col("rows") / plan.block_rows, F.col("all_n") / plan.block_shingles)).cast("int")
    dealt = members.join(size.select("component", blocks.alias("blocks")), "component").withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    ).drop("n")
    # One row per candidate class meets its text again; of copies, those that bear the smallest id.
    texts = docs.select(F.col(doc_id).alias("text_id"), text_or_empty(text).alias("text")).withColumn("class", class_of(F.col("text")))
    # Sorted and merged whatever the size, so that a plan tried on little data is the one that runs on much.
    found = texts.join(dealt.withColumnRenamed("text_id", "first_id").hint("merge"), "class").filter(F.col("text_id").eqNullSafe(F.col("first_id")))

    def make():
        return lambda values: [pa.array([shingles(t, plan.words).view(np.int64) for t in values], pa.list_(pa.int64()))]

    keys = ["class", "component", "block", "blocks", "copies"]
    sets = map_texts(found, keys, "text", make, [("items", "array<bigint>")])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = sets.select("*", other).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class",
        "copies", "items",
    )
    paired = paired.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "class")
    schema = "class binary, text_links bigint, doc_links bigint, root binary"
    return paired.mapInArrow(lambda batches: _verify(batches, plan), schema)


def _ids_are_unique(docs: DataFrame, doc_id: str, text: str) -> bool:
    keyed = docs.select(F.col(doc_id).alias("id"), class_of(text_or_empty(text)).alias("class"))
    return keyed.groupBy("id", "class").count().filter("count > 1").isEmpty()


def near_duplicate_classes(
    docs: DataFrame, plan: ForestPlan = ForestPlan(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per distinct text: (class, text_id, copies, text_links, doc_links, keeper, class_id).

    ``text_links`` counts other texts at the threshold or above, ``doc_links`` the documents that have them,
    ``class_id`` is the smallest id that links lead to and ``keeper`` the class of that document.
    """
    classes = text_classes(docs, plan, doc_id, text)
    components = candidate_components(classes, plan)
    links = cut_lineage(verified_links(docs, classes, components, plan, doc_id, text), "links")
    sums = links.groupBy("class").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    edges = links.filter(F.col("class") != F.col("root")).select(
        F.greatest("class", "root").alias("src"), F.least("class", "root").alias("dst")
    )
    groups = connected_components(edges.distinct()).withColumnsRenamed({"node": "class"})
    whole = classes.drop("paths").join(sums, "class", "left").join(groups, "class", "left")
    whole = whole.withColumn("cluster", F.coalesce("cluster", "class"))
    whole = cut_lineage(whole, "clusters")
    # The smallest id, NULL last, then the smallest class.
    order = F.struct(F.col("text_id").isNull(), F.col("text_id"), F.col("class"))
    first = whole.groupBy("cluster").agg(F.min(order).alias("o"))
    first = first.select("cluster", F.col("o.text_id").alias("class_id"), F.col("o.class").alias("keeper"))
    return whole.join(first, "cluster").select(
        "class", "text_id", "copies", "keeper", "class_id",
        F.coalesce("text_links", F.lit(0)).cast("bigint").alias("text_links"),
        F.coalesce("doc_links", F.lit(0)).cast("bigint").alias("doc_links"),
    )


def join_near_duplicates(
    docs: DataFrame, plan: ForestPlan = ForestPlan(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, class_id, text_id, n_text_links, n_links) of every document; ``n_links`` counts its copies as well."""
    found = cut_lineage(near_duplicate_classes(docs, plan, doc_id, text), "near-duplicates")
    keyed = docs.select(F.col(doc_id).alias("doc_id"), class_of(text_or_empty(text)).alias("class"))
    return keyed.join(found, "class").select(
        "doc_id", "class_id", "text_id", F.col("text_links").alias("n_text_links"),
        (F.col("doc_links") + F.col("copies") - 1).alias("n_links"),
    )


def drop_near_duplicates(
    docs: DataFrame, plan: ForestPlan = ForestPlan(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, once."""
    found = near_duplicate_classes(docs, plan, doc_id, text).filter(F.col("class") == F.col("keeper"))
    keepers = cut_lineage(found.select(F.col("class").alias("__class"), F.col("class_id").alias("__id")), "keepers")
    same = class_of(text_or_empty(text)).eqNullSafe(F.col("__class")) & F.col(doc_id).eqNullSafe(F.col("__id"))
    kept = docs.join(keepers, same)
    if not _ids_are_unique(docs, doc_id, text):
        kept = kept.dropDuplicates(["__class"])
    return kept.select(*docs.columns)


def op3_ngram_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
