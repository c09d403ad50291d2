import random
import re

import pytest
from pyspark.sql import functions as F

from tekstmill.functions.minhash import MinHashPlan
from tekstmill.operators import minhash_dedup, sentence_dedup
from tekstmill.operators.components import connected_components
from tekstmill.operators.skew import join_facts


def brute_sentence_dedup(rows, n=3, min_words=50):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        pieces = re.findall(r"[^.!?]+[.!?]*", text)
        even = [re.sub(r"\s+", " ", p).strip().lower() for p in pieces]
        cut = set()
        for i in range(len(even) - n + 1):
            window = tuple(even[i : i + n])
            if window in seen:
                cut.update(range(i, i + n))
            seen.add(window)
        left = [p for i, p in enumerate(pieces) if i not in cut]
        new = "".join(left) if cut else text
        kept = not cut or (len(re.findall(r"[^\W_]+", new)) >= min_words and bool(left))
        out[doc_id] = (new, len(cut), kept)
    return out


def random_docs(count, seed=5):
    draw = random.Random(seed)
    pool = [f"Sentence number {i} says this." for i in range(30)]
    return [(i, " ".join(draw.choice(pool) for _ in range(draw.randrange(1, 25)))) for i in range(count)]


@pytest.mark.parametrize("hot_rows, partitions", [(100_000, 1), (2, 4), (2, 17)])
def test_sentence_dedup_against_brute_force(spark, hot_rows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = random_docs(80) + [(100 + i, "Same one here. Same two here. Same three here. " * 3) for i in range(40)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        out = sentence_dedup.deduplicate_sentences(docs, min_doc_words=10, hot_rows=hot_rows, partitions=partitions)
        found = {r.doc_id: (r.text, r.removed_sentences, r.kept) for r in out.collect()}
        assert found == brute_sentence_dedup(rows, min_words=10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_sentence_dedup_is_idempotent(spark):
    docs = spark.createDataFrame(random_docs(60), "doc_id bigint, text string")
    once = sentence_dedup.deduplicate_sentences(docs, min_doc_words=0).filter("kept").select("doc_id", "text")
    again = sentence_dedup.duplicate_windows(sentence_dedup.sentence_windows(once))
    # Cutting joins sentences that were apart, so only windows made anew may repeat.
    first = sentence_dedup.duplicate_windows(sentence_dedup.sentence_windows(docs))
    assert again.count() < first.count()
    same = sentence_dedup.deduplicate_sentences(docs.limit(0)).count()
    assert same == 0


def test_sentence_dedup_lines_and_index(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny")], "doc_id bigint, text string")
    out = sentence_dedup.deduplicate_sentences(docs, split_sentences=False, min_doc_words=1)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a\nb\nc\nd", 2: "x\ny"}
    windows = sentence_dedup.sentence_windows(docs, split_sentences=False)
    index = windows.select("h").limit(0)
    assert sentence_dedup.duplicate_windows(windows, index=index).count() == 0
    # Windows of known text are duplicates wherever they occur.
    assert sentence_dedup.duplicate_windows(windows, index=windows).count() == 5


def test_negative_parallelism(spark, texts):
    with pytest.raises(ValueError):
        sentence_dedup.deduplicate_sentences(texts("a"), partitions=-3)


@pytest.mark.parametrize("hot_rows", [1, 3, 100_000])
def test_join_facts(spark, hot_rows):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    facts = rows.groupBy("k").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).filter("k < 40")
    plain = rows.join(facts.drop("n"), "k").select("id", "k", "low")
    split = join_facts(rows, facts, "k", "n", F.col("id"), hot_rows)
    assert sorted(split.collect()) == sorted(plain.collect())


def test_hot_keys_are_spread(spark):
    """A key with a third of all rows must not end up in one partition."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        facts = rows.groupBy("k").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
        split = join_facts(rows, facts, "k", "n", F.col("id"), hot_rows=100)
        sizes = [r.n for r in split.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 3
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert plan.count("_salt") and "hashpartitioning(k#" in plan
        assert all("_salt" in line for line in plan.split("\n") if "ENSURE_REQUIREMENTS" in line and "low" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("kind, hot_rows", [("random", 100_000), ("random", 2), ("chain", 100_000), ("star", 5), ("none", 9)])
def test_components(spark, kind, hot_rows):
    draw = random.Random(9)
    edges = {
        "random": [(a, b) if a > b else (b, a) for a, b in (draw.sample(range(120), 2) for _ in range(70))],
        "chain": [(i + 1, i) for i in range(40)],
        "star": [(i, 0) for i in range(1, 60)] + [(99, 59)],
        "none": [],
    }[kind]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    members = connected_components(df, hot_rows).collect()
    assert {m.node: m.cluster for m in members} == brute_components(edges)
    assert len(members) == len(brute_components(edges))


def brute_signature(text, plan):
    from pyspark.sql import SparkSession

    tokens = re.findall(r"[^\W_]+", text.lower())
    import hashlib

    lanes = []
    for i in range(len(tokens) - plan.ngram + 1):
        h = hashlib.md5(" ".join(tokens[i : i + plan.ngram]).encode()).hexdigest()
        lanes.append((int(h[:7], 16), int(h[8:15], 16)))
    p = (1 << 31) - 1
    if not lanes:
        return None
    return [min(((a * x + b) % p) * 2**31 + (c * y + d) % p for x, y in lanes) for a, b, c, d in plan.coefficients()]


def test_signatures_against_brute_force(spark, texts, monkeypatch):
    plan = MinHashPlan(buckets=3, rows=2, shingle_hash="md5")
    draw = random.Random(2)
    rows = [" ".join(draw.choice("ab cd ef gh ij".split()) for _ in range(n)) for n in (0, 4, 5, 6, 300, 40_000, 7)] + ["Æble på ø " * 3]
    signed = minhash_dedup.minhash_signatures(texts(*rows).coalesce(1), plan=plan).collect()
    assert {r.doc_id: r.signature for r in signed} == {
        i: s for i, s in enumerate(brute_signature(t, plan) for t in rows) if s
    }


@pytest.mark.parametrize("shingle_hash", ["md5", "xxhash64"])
def test_document_dedup(spark, shingle_hash):
    draw = random.Random(4)
    base = [[draw.choice("abcdefghij") * 3 + str(draw.randrange(90)) for _ in range(200)] for _ in range(8)]
    near = [w[:90] + ["changed"] + w[91:] for w in base[:3]]
    rows = [(i, " ".join(w)) for i, w in enumerate(base + near)] + [(50 + i, " ".join(base[5])) for i in range(30)] + [(99, "too short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept, removed = minhash_dedup.deduplicate_documents(docs, plan=MinHashPlan(shingle_hash=shingle_hash), hot_rows=4)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(8), 99]
    gone = {r.doc_id: r.cluster for r in removed.collect()}
    assert gone == {8: 0, 9: 1, 10: 2} | {50 + i: 5 for i in range(30)}


def test_plan_is_checked():
    with pytest.raises(ValueError):
        MinHashPlan(buckets=0)
    with pytest.raises(ValueError):
        MinHashPlan(shingle_hash="sha1")


def test_many_hot_keys_are_split(spark):
    """Over a thousand heavy keys, with adaptive execution off: no partition holds much more than its share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.range(1200 * 40 + 9000).select(
            F.when(F.col("id") < 48_000, F.col("id") % 1200).otherwise(F.lit(5000)).alias("k"), "id"
        )
        facts = rows.groupBy("k").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        joined = join_facts(rows, facts, "k", "n", F.col("id"), 20)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.count() == 57_000 and joined.filter("first > id").isEmpty()
        assert max(sizes) < 2 * 57_000 / 64
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_permutation_estimates_jaccard():
    import numpy as np

    from tekstmill.functions.minhash import one_permutation, rotation_step

    rng = np.random.default_rng(5)
    errors = []
    for similarity in (0.2, 0.5, 0.8):
        for _ in range(40):
            shared = rng.integers(0, 1 << 56, int(1000 * similarity))
            a = np.concatenate([shared, rng.integers(0, 1 << 56, 1000 - len(shared))])
            b = np.concatenate([shared, rng.integers(0, 1 << 56, 1000 - len(shared))])
            true = len(shared) / (2000 - len(shared))
            rows = one_permutation(np.concatenate([a, b]), np.array([1000, 1000]), 112)
            errors.append(abs((rows[0] == rows[1]).mean() - true))
    assert np.mean(errors) < 0.05 and max(errors) < 0.2


def test_one_permutation_fills_empty_bins():
    import numpy as np

    from tekstmill.functions.minhash import one_permutation, rotation_step

    rows = one_permutation(np.array([5 * 8 + 3], dtype=np.int64), np.array([0, 1]), 8)
    assert rows.shape == (1, 8)
    # The one shingle lies in bin 3 with value 5; bin j takes it at distance (3 - j) % 8.
    assert list(rows[0]) == [5 + ((3 - j) % 8) * rotation_step(8) for j in range(8)]


def test_window_index_over_batches(spark):
    from pyspark.sql import functions as F

    from tekstmill.operators import sentence_dedup
    from tekstmill.operators.window_index import WindowIndex

    texts = ["A b. C d. E f. G h.", "C d. E f. G h. X.", "Y. Z. W. V.", "A b. C d. E f. Q.", "Y. Z. W. V."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {tuple(r) for r in sentence_dedup.duplicate_windows(sentence_dedup.sentence_windows(docs)).collect()}
    index = WindowIndex(spark, buckets=4)
    try:
        got = set()
        for batch in (docs.filter("doc_id < 2"), docs.filter("doc_id >= 2 and doc_id < 4"), docs.filter("doc_id >= 4")):
            windows = sentence_dedup.sentence_windows(batch)
            got |= {tuple(r) for r in index.duplicates(windows).collect()}
            index.add(windows)
        assert got == whole and whole
        # A large index is not broadcast: then only the new windows are dealt into its buckets.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = index.known(sentence_dedup.sentence_windows(docs))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1, plan
    finally:
        index.drop()


def test_permuted_minima_where_first_lanes_repeat():
    import numpy as np

    from tekstmill.functions import minhash

    plan = minhash.MinHashPlan(buckets=2, rows=3)
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 700, 1, 9000, 40])
    packed = rng.integers(0, 1 << 56, lengths.sum())
    # In some texts, first lanes that several second lanes share, and shingles that come again.
    packed[100:400] = packed[5] >> 28 << 28 | rng.integers(0, 1 << 28, 300)
    packed[2000:3000] = packed[3000:4000]
    texts = np.split(packed, np.cumsum(lengths)[:-1])
    expected = [
        [min((((int(x) >> 28) * a + b) % minhash.PRIME << 31) + ((int(x) & (1 << 28) - 1) * c + d) % minhash.PRIME for x in t)
         for a, b, c, d in plan.coefficients()]
        for t in texts if len(t)
    ]
    assert minhash.permuted_minima(packed, lengths, plan).tolist() == expected


def test_md5_lanes_of_joined_words():
    import hashlib

    from tekstmill.functions.minhash import md5_lanes

    def lane(words):
        digest = hashlib.md5(" ".join(words).encode()).hexdigest()
        return int(digest[:7] + digest[8:15], 16)

    split = "straße é 1 b c d".split()
    assert md5_lanes("straße é 1 b c d".encode(), 5).tolist() == [lane(split[:5]), lane(split[1:])]
    assert md5_lanes(b"a b", 3).tolist() == []
    assert md5_lanes(b"a b", 1).tolist() == [lane(["a"]), lane(["b"])]


@pytest.mark.parametrize("scheme", ["permutations", "one_permutation"])
def test_signature_work_arrays_do_not_grow_with_the_batch(scheme):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tekstmill.functions import minhash
    from tekstmill.functions.batches import parts

    plan = minhash.MinHashPlan(buckets=1, rows=4, scheme=scheme)
    peaks = []
    for texts in (400, 1600):
        values = np.random.default_rng(2).integers(0, 1 << 56, texts * 1000)
        batch = pa.ListArray.from_arrays(np.arange(0, texts * 1000 + 1, 1000, dtype=np.int32), pa.array(values))
        tracemalloc.start()
        for part in parts(batch, minhash.PART_ITEMS):
            minhash.signature_rows(part, plan)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0]


def test_null_and_short_texts_have_no_signature(spark, texts):
    rows = texts(None, "", " ", "a b c d", "a b c d e", "a-b c d e f")
    for scheme in ("permutations", "one_permutation"):
        plan = MinHashPlan(shingle_hash="md5", scheme=scheme)
        assert {r.doc_id for r in minhash_dedup.minhash_signatures(rows, plan=plan).collect()} == {4, 5}
