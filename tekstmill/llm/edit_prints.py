"""Document fingerprints by a randomised edit embedding.

A walk reads a text character by character. At output position t it emits the characters it stands on, and goes on by
one character if the coin of (t, character) says so, else stays. All texts share the coins, so the walks of two texts
with few edits soon run together again, and edit distance turns into Hamming distance of the outputs. The coins repeat
after a thousand positions, which keeps them in memory for a text of any length. Outputs are sampled at fixed
random positions, as many in each octave [64 * 2^k, 64 * 2^(k+1)), two bits each, so that texts of all lengths have
comparable fingerprints: ``<length of the output in hex>:<samples in base64>``. Their likeness is the share of equal
samples, each octave weighted by its length and freed of the agreement of chance.

Near copies are found by bands of samples. Lengths are graded in steps of 1.25; a grade draws its samples evenly from
the outputs below it, and a text has the bands of the grades that it can share with a text at the threshold. Samples
per band grow with the number of fingerprints, so that bands meet seldom by chance, and the number of bands follows
from the threshold and a target recall, for the worst place that the differences can have. Texts with a band in common
are tied to the first of it and ties are verified by the likeness of the fingerprints. Where texts of a band are left
that no tie connects, those of it that are apart are compared in blocks, all with all; a pair that several bands of the
same first text hold is compared once. Bands of different first texts are not compared with each other: bands meet by
chance so often that they hang together, and the more the larger the table.
Components become classes.

Inputs: NULL counts as the empty text, whose fingerprint is ``0:`` (alike to itself by 1, to any other by 0). Equal
texts have equal fingerprints; so repeated rows do. Texts of any length are walked whole. Rows go by descending id,
NULL last, equal ids by a hash of the text; a single row is its own next. An empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tekstmill.operators.components import connected_components

from .common import cut_lineage, read_table, text_or_empty

PERIOD = 1 << 10
CLASSES = 32
OCTAVE = 64
SAMPLES = 64
# Octaves for which positions are drawn: outputs of up to 2^40 steps.
OCTAVES = 35
CHANCE = 0.25
# Step from one grade of lengths to the next, and the share of pairs at the threshold that bands are to find.
GRADE = 1.25
RECALL = 0.999
# Fingerprints of a band that meet at a time, and pairs whose samples lie in memory together.
BLOCK_ROWS = 1024
PAIRS = 1 << 14


@lru_cache(1)
def _coins() -> list[list]:
    """For each step of the period a list: its number, then for each character class the list of the step after that
    at which the walk leaves a character of the class."""
    heads = np.random.default_rng(11).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    leave = np.empty((PERIOD, CLASSES), np.int64)
    after = np.argmax(heads, axis=1) + PERIOD
    for t in range(PERIOD - 1, -1, -1):
        after = np.where(heads[:, t], t, after)
        leave[t] = after
    follow = ((leave + 1) % PERIOD).tolist()
    states: list[list] = [[t] for t in range(PERIOD)]
    for state, row in zip(states, follow):
        state.extend(map(states.__getitem__, row))
    return states


@lru_cache(1)
def _positions() -> np.ndarray:
    """Sampled output positions, one row per octave."""
    random = np.random.default_rng(12)
    rows = [np.sort(random.choice(OCTAVE, SAMPLES, replace=SAMPLES > OCTAVE))]
    for k in range(1, OCTAVES):
        low = OCTAVE << (k - 1)
        rows.append(np.sort(random.integers(low, 2 * low, SAMPLES)))
    return np.array(rows)


def _octave_starts() -> np.ndarray:
    return np.concatenate([[0], OCTAVE << np.arange(OCTAVES)])


STARTS = _octave_starts()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def walk(points: np.ndarray, start: int = 0) -> np.ndarray:
    """Output position after each character, for a walk that stands at ``start``."""
    classes = (((points * np.uint32(2_654_435_761)) >> np.uint32(27)) % CLASSES + 1).astype(np.uint8).tobytes()
    passed = accumulate(classes, getitem, initial=_coins()[start % PERIOD])
    steps = np.fromiter(map(itemgetter(0), passed), np.int64, len(points) + 1)
    rounds = np.cumsum(np.diff(steps) <= 0)
    return start - start % PERIOD + steps[1:] + PERIOD * rounds


def octaves_of(length: int) -> int:
    return int(np.searchsorted(STARTS, length))


def print_of(points: np.ndarray, ends: np.ndarray) -> str:
    """Fingerprint of a text from its code points and its walk."""
    length = int(ends[-1]) if len(ends) else 0
    rows = octaves_of(length)
    at = _positions()[:rows].ravel()
    # The character that covers an output position, and the three after it.
    index = np.minimum(np.searchsorted(ends, at, side="right"), max(0, len(points) - 1))
    padded = np.concatenate([points, np.zeros(3, np.uint32)]).astype(np.uint64)
    symbol = np.zeros(len(at), np.uint64)
    for k in range(4):
        symbol = symbol * np.uint64(0x9E3779B97F4A7C15) + padded[index + k]
    symbol ^= symbol >> np.uint64(31)
    symbol = (symbol * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(62)
    symbol[at >= length] = 0
    bits = symbol.astype(np.uint8).reshape(-1, 4)
    packed = bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6
    return f"{length:x}:{base64.b64encode(packed.tobytes()).decode()}"


def fingerprint(text: str) -> str:
    points = code_points(text)
    return print_of(points, walk(points))


def samples(print_: str) -> tuple[int, np.ndarray]:
    """Output length and samples, one row per octave."""
    length, _, coded = print_.partition(":")
    packed = np.frombuffer(base64.b64decode(coded), np.uint8)
    bits = np.stack([packed >> k & 3 for k in (0, 2, 4, 6)], axis=1)
    return int(length, 16), bits.reshape(-1, SAMPLES)


def likeness(left: str, right: str) -> float:
    """Share of equal outputs, from 0 to 1."""
    if left == right:
        return 1.0
    (n, a), (m, b) = samples(left), samples(right)
    shared = min(len(a), len(b))
    if shared == 0:
        return 0.0
    inside = _positions()[:shared] < min(n, m)
    alike = ((a[:shared] == b[:shared]) & inside).sum(1) / np.maximum(1, inside.sum(1))
    alike = np.clip((alike - CHANCE) / (1 - CHANCE), 0, 1)
    # Outputs of each octave that both have; beyond the shorter output nothing is equal.
    common = np.clip(min(n, m) - STARTS[:shared], 0, np.diff(STARTS)[:shared])
    return float((alike * common).sum() / max(n, m))


def edit(text: str, following: str) -> str:
    """The last third replaced by the first characters of another text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _facts(text: str, points: np.ndarray, ends: np.ndarray, own: str, following: str, next_print: str) -> tuple:
    third = len(points) // 3
    kept = len(points) - third
    edited = edit(text, following)
    # The walk of the edited text is that of the text up to the edit.
    tail = code_points(following[:third])
    start = int(ends[kept - 1]) if kept else 0
    edited_print = print_of(np.concatenate([points[:kept], tail]), np.concatenate([ends[:kept], walk(tail, start)]))
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return len(points), digest, own, edited_print, likeness(own, edited_print), likeness(own, next_print)


def _walked(text: str) -> tuple:
    points = code_points(text)
    ends = walk(points)
    return text, points, ends, print_of(points, ends)


FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
TYPES = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Texts are shuffled once, into ranges of descending ids, and each task compares its rows with the following ones.
    The first and the last row of a range are written with their texts; these few meet the neighbouring range after.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"part int, place int, doc_id {kind}, text string, {TYPES}"

    def run(batches):
        part = TaskContext.get().partitionId()
        first, last = True, None
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                out, keep = [], []
                for i, value in enumerate(some.column("text").to_pylist()):
                    row = some.slice(i, 1).column("doc_id"), _walked(value)
                    if first:
                        # Place 0: the text alone, for the range before.
                        out.append((0, value, *[None] * 6))
                        keep.append(row[0])
                        first = False
                    if last is not None:
                        out.append((1, None, *_facts(*last[1], row[1][0], row[1][3])))
                        keep.append(last[0])
                    last = row
                if out:
                    yield table(part, out, keep)
        if last is not None:
            yield table(part, [(2, last[1][0], *[None] * 6)], [last[0]])

    def table(part, out, ids):
        columns = [pa.array([o[i] for o in out], k) for i, k in enumerate([pa.int32(), pa.string(), *KINDS])]
        parts = pa.array([part] * len(out), pa.int32())
        id_column = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [parts, columns[0], id_column, *columns[1:]], names=["part", "place", "doc_id", "text", *FIELDS]
        )

    found = cut_lineage(ordered.mapInArrow(run, schema), "edit-prints", drop_shuffles=True)
    # One row per range from here on.
    starts = found.filter("place = 0").select("part", F.col("text").alias("following"))
    parts = starts.select("part")
    around = Window.orderBy("part")
    nexts = parts.select(
        "part", F.coalesce(F.lead("part").over(around), F.min("part").over(around.rowsBetween(Window.unboundedPreceding, 0))).alias("next")
    )
    ends = found.filter("place = 2").select("part", "doc_id", "text").join(nexts, "part")
    ends = ends.join(starts.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def finish(batches):
        for batch in batches:
            texts, following = (batch.column(c).to_pylist() for c in ("text", "following"))
            rest = [_facts(*_walked(t), f, fingerprint(f)) for t, f in zip(texts, following)]
            columns = [pa.array([r[i] for r in rest], k) for i, k in enumerate(KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *FIELDS])

    last = cut_lineage(ends.mapInArrow(finish, f"doc_id {kind}, {TYPES}"), "edit-ends")
    return found.filter("place = 1").select("doc_id", *FIELDS).unionByName(last)


@lru_cache(1)
def _grades() -> np.ndarray:
    """Lengths at which grades begin."""
    steps = np.arange(int(math.log(OCTAVE << (OCTAVES - 1), GRADE)))
    return np.unique(np.floor(GRADE**steps).astype(np.int64))


def band_samples(count: int) -> int:
    """Samples of a band, so that of ``count`` fingerprints few meet by chance."""
    return max(8, math.ceil(math.log2(max(2, count)) / 2 + 1))


def band_count(threshold: float, width: int, recall: float = RECALL) -> int:
    """Bands of ``width`` samples that find a pair at the threshold with the target probability, even if all its
    differences are below the grade and what is beyond it is equal."""
    beyond = 1 - 1 / GRADE
    below = max(0.0, (threshold - beyond) / (1 - beyond))
    meet = (CHANCE + (1 - CHANCE) * below) ** width
    return 1 if meet >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))


@lru_cache(1024)
def _bands(grade: int, bands: int, width: int) -> np.ndarray:
    """Which samples make the bands of a grade: each from an octave by its share of the outputs below the grade."""
    top = int(_grades()[grade])
    random = np.random.default_rng([100, grade, width])
    inside = (_positions() < top).sum(1)
    shares = np.clip(top - STARTS[:-1], 0, np.diff(STARTS)) * (inside > 0)
    octave = random.choice(OCTAVES, (bands, width), p=shares / shares.sum())
    # Positions of an octave are sorted, so those below the grade are its first.
    return octave * SAMPLES + np.floor(random.random((bands, width)) * inside[octave]).astype(np.int64)


def _unpacked(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Output lengths, where the octaves of each fingerprint begin, and the samples of all of them, one row per octave."""
    parts = [p.partition(":") for p in prints]
    lengths = np.array([int(n, 16) for n, _, _ in parts], np.int64)
    packed = np.frombuffer(b"".join([base64.b64decode(c) for _, _, c in parts]), np.uint8)
    bits = np.stack([packed >> k & 3 for k in (0, 2, 4, 6)], axis=1).reshape(-1, SAMPLES)
    octaves = np.searchsorted(STARTS, lengths)
    return lengths, np.cumsum(octaves) - octaves, bits


def band_keys(prints: list[str], threshold: float, bands: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bands of all grades that texts of these lengths share with one at the threshold, and whose they are.
    Only the empty text has none; it is like no other."""
    lengths, begins, bits = _unpacked(prints)
    flat, grades = bits.ravel(), _grades()
    high = np.searchsorted(grades, lengths, side="right")
    # The shorter of a pair has a share of at least the threshold, and a grade not far below its length.
    low = np.searchsorted(grades, (lengths * threshold).astype(np.int64), side="right") - 1
    low = np.maximum(0, np.minimum(high - 1, low))
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for grade in range(int(low.min(initial=0)), int(high.max(initial=0))):
        some = np.flatnonzero((low <= grade) & (grade < high))
        if len(some) == 0:
            continue
        values = np.zeros((len(some), bands), np.uint64)
        for column in _bands(grade, bands, width).T:
            values = (values ^ flat[begins[some, None] * SAMPLES + column]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
            values ^= values >> np.uint64(29)
        values ^= np.uint64(grade << 32) + np.arange(bands, dtype=np.uint64)
        rows.append(np.repeat(some, bands))
        keys.append((values * np.uint64(0xD6E8FEB86659FD93)).view(np.int64).ravel())
    return np.concatenate(rows), np.concatenate(keys)


def _laid_out(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Output lengths, and samples by octave and row; 255 where there are none."""
    found = [samples(p) for p in prints]
    rows = np.full((max((len(b) for _, b in found), default=0), len(prints), SAMPLES), 255, np.uint8)
    for i, (length, bits) in enumerate(found):
        inside = _positions()[: len(bits)] < length
        rows[: len(bits), i] = np.where(inside, bits, 255)
    return np.array([n for n, _ in found], np.int64), rows


def likeness_table(left: list[str], right: list[str]) -> np.ndarray:
    """``likeness`` of every fingerprint of ``left`` with every one of ``right``, none of them equal."""
    (n, a), (m, b) = _laid_out(left), _laid_out(right)
    total = np.zeros((len(left), len(right)), np.float64)
    shorter = np.minimum(n[:, None], m[None, :])
    for k in range(min(len(a), len(b))):
        same = sum((a[k] == v).astype(np.float32) @ (b[k] == v).astype(np.float32).T for v in range(4))
        inside = np.minimum((a[k] < 255).sum(1)[:, None], (b[k] < 255).sum(1)[None, :])
        alike = np.clip((same / np.maximum(1, inside) - CHANCE) / (1 - CHANCE), 0, 1)
        total += alike * np.clip(shorter - STARTS[k], 0, STARTS[k + 1] - STARTS[k])
    return total / np.maximum(1, np.maximum(n[:, None], m[None, :]))


def likeness_of(lengths: np.ndarray, begins: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``likeness`` of pairs of rows of ``_unpacked``, none of them equal."""
    total = np.zeros(len(left), np.float64)
    for low in range(0, len(left), PAIRS):
        a, b = left[low : low + PAIRS], right[low : low + PAIRS]
        shorter = np.minimum(lengths[a], lengths[b])
        for k in range(octaves_of(int(shorter.max()))):
            at = np.flatnonzero(shorter > STARTS[k])
            inside = _positions()[k] < shorter[at, None]
            same = (bits[begins[a[at]] + k] == bits[begins[b[at]] + k]) & inside
            alike = same.sum(1) / np.maximum(1, inside.sum(1))
            alike = np.clip((alike - CHANCE) / (1 - CHANCE), 0, 1)
            total[low + at] += alike * np.minimum(shorter[at] - STARTS[k], STARTS[k + 1] - STARTS[k])
    return total / np.maximum(1, np.maximum(lengths[left], lengths[right]))


def _ties(distinct: DataFrame, threshold: float, bands: int, width: int) -> DataFrame:
    """(key, node, first) of every fingerprint but the first of each band."""

    def keys(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                rows, found = band_keys(some.column("fingerprint").to_pylist(), threshold, bands, width)
                nodes = some.column("node").to_numpy()[rows]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(nodes)], names=["key", "node"])

    def tie(batches):
        last, first = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
            begins = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            firsts = np.where(at < 0, first, node[at])
            last, first = key[-1], firsts[-1]
            rest = ~begins
            columns = [pa.array(c[rest], pa.int64()) for c in (key, node, firsts)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "first"])

    found = distinct.select("node", "fingerprint").mapInArrow(keys, "key bigint, node bigint")
    # Each row is looked at once, so a band of any size costs its members only.
    met = found.repartition("key").sortWithinPartitions("key", "node")
    return cut_lineage(met.mapInArrow(tie, "key bigint, node bigint, first bigint"), "print-ties", drop_shuffles=True)


def _verified(ties: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """(src, dst) of the ties at the threshold or above."""
    left = distinct.select("node", F.col("fingerprint").alias("a"))
    right = distinct.select(F.col("node").alias("first"), F.col("fingerprint").alias("b"))

    def verify(batches):
        for batch in batches:
            prints = [p for c in ("a", "b") for p in batch.column(c).to_pylist()]
            at = np.arange(batch.num_rows)
            good = pa.array(likeness_of(*_unpacked(prints), at, at + batch.num_rows) >= threshold, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("first")], names=["src", "dst"]).filter(good)

    pairs = ties.select("node", "first").distinct()
    edges = pairs.join(left, "node").join(right, "first").mapInArrow(verify, "src bigint, dst bigint")
    return cut_lineage(edges, "print-edges", drop_shuffles=True)


def _compared(ties: DataFrame, groups: DataFrame, distinct: DataFrame, threshold: float, block: int = BLOCK_ROWS) -> DataFrame:
    """(src, dst) that connect what is alike in bands whose texts verified ties leave apart."""
    members = ties.select("key", "node", "first").union(ties.select("key", F.col("first").alias("node"), "first").distinct())
    known = members.join(groups, "node", "left").withColumn("c", F.coalesce("cluster", "node"))
    # The only pair of a band of two is verified already.
    band = Window.partitionBy("key")
    known = known.select("*", *[f.over(band).alias(n) for n, f in (("low", F.min("c")), ("high", F.max("c")), ("n", F.count(F.lit(1))))])
    # Bands of the same first text have much the same texts, so they meet as one group, each text once with its bands.
    met = known.filter("n > 2 and low < high").groupBy("first", "node", "c").agg(F.collect_list("key").alias("keys"))
    met = cut_lineage(met, "print-open", drop_shuffles=True)
    sizes = met.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = met.join(sizes, "first").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.join(distinct.select("node", "fingerprint"), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    names, facts = ["first", "low", "high"], ["block", "node", "c", "keys", "fingerprint"]
    paired = dealt.select("*", other).select("first", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), *facts)
    paired = paired.repartition(*names).sortWithinPartitions(*names, "block")

    def pairs(rows, low, start):
        """Places of the pairs of one group of rows that have a band in common and that ties leave apart: all with
        all, or those of one block with those of the other."""
        block, cluster = (np.array([r[i] for r in rows]) for i in (0, 2))
        cut = int(np.searchsorted(block, low, side="right"))
        alone = cut == len(rows)
        bands, at = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
        within = np.zeros((len(rows), len(bands)), np.float32)
        within[np.repeat(np.arange(len(rows)), [len(r[3]) for r in rows]), at] = 1
        right = 0 if alone else cut
        near = (within[:cut] @ within[right:].T > 0) & (cluster[:cut, None] != cluster[None, right:])
        a, b = np.nonzero(np.triu(near, 1) if alone else near)
        return a + start, b + right + start

    def compare(batches):
        def answer(groups):
            rows = [r for _, group in groups for r in group]
            starts = accumulate([len(g) for _, g in groups], initial=0)
            a, b = (np.concatenate(x) for x in zip(*[pairs(g, key[1], at) for (key, g), at in zip(groups, starts)]))
            near = likeness_of(*_unpacked([r[4] for r in rows]), a, b) >= threshold
            nodes = np.array([r[1] for r in rows], np.int64)
            a, b = nodes[a[near]], nodes[b[near]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["src", "dst"])

        # Whole groups, compared when about a block of rows is together.
        held, n = [], 0
        for batch in batches:
            for *key, part, node, c, keys, print_ in zip(*[batch.column(x).to_pylist() for x in (*names, *facts)]):
                if not held or held[-1][0] != key:
                    if n >= block:
                        yield answer(held)
                        held, n = [], 0
                    held.append((key, []))
                held[-1][1].append((part, node, c, keys, print_))
                n += 1
        if held:
            yield answer(held)

    return paired.mapInArrow(compare, "src bigint, dst bigint").distinct()


def near_classes(prints: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", column: str = "fingerprint") -> DataFrame:
    """(fingerprint, class_id) of every distinct fingerprint: the smallest id among those that verified ties lead to."""
    distinct = prints.groupBy(F.col(column).alias("fingerprint")).agg(F.min(doc_id).alias("first_id"))
    distinct = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()), "prints", drop_shuffles=True)
    width = band_samples(distinct.count())
    ties = _ties(distinct, threshold, band_count(threshold, width), width)
    edges = _verified(ties, distinct, threshold)
    groups = cut_lineage(connected_components(edges), "print-verified")
    more = _compared(ties, groups, distinct, threshold)
    stars = groups.filter("node <> cluster").select(F.col("node").alias("src"), F.col("cluster").alias("dst"))
    both = stars.union(more.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")))
    groups = connected_components(both.distinct()).withColumnRenamed("cluster", "c")
    whole = distinct.join(groups, "node", "left").withColumn("c", F.coalesce("c", "node"))
    whole = cut_lineage(whole.select("fingerprint", "first_id", "c"), "print-groups", drop_shuffles=True)
    ids = whole.groupBy("c").agg(F.min("first_id").alias("class_id"))
    return whole.join(ids, "c").select("fingerprint", "class_id")


def op9_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, with the class of near copies that bands and verification find."""
    found = fingerprint_documents(read_table(spark, sf_dir, "documents"))
    classes = near_classes(found)
    return found.join(classes, "fingerprint").select("doc_id", *FIELDS, "class_id")
