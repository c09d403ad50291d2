"""Whole results where a rule of thumb has lost some."""

import numpy as np

from tekstmill.llm import edit_prints, nn_descent, toxicity, wrapper
from tekstmill.plans import lineage
from tekstmill.plans.lineage import cut_lineage


def edited(random, text, edits):
    letters = list(text)
    for at in random.integers(0, len(text), edits):
        letters[at] = chr(random.integers(97, 123))
    return "".join(letters)


def test_bands_find_pairs_at_the_threshold(spark):
    random = np.random.default_rng(5)
    texts = []
    for i in range(60):
        base = "".join(chr(c) for c in random.integers(97, 123, random.integers(20, 2000)))
        texts += [base, *(edited(random, base, max(1, len(base) // k)) for k in (12, 16, 20, 30))]
        texts.append(base[: int(len(base) * 0.93)])
    prints = sorted({edit_prints.fingerprint(t) for t in texts})
    alike = np.array([[edit_prints.likeness(a, b) for b in prints] for a in prints])
    table = edit_prints.likeness_table(prints, prints)
    np.fill_diagonal(table, 1)
    assert np.allclose(table, alike)
    # Classes by brute force.
    labels = np.arange(len(prints))
    while True:
        lowest = np.where(alike >= 0.8, labels[None, :], len(prints)).min(1)
        if (lowest == labels).all():
            break
        labels = lowest
    found = edit_prints.near_classes(spark.createDataFrame(list(enumerate(prints)), "doc_id bigint, fingerprint string"))
    assert {r["fingerprint"]: r["class_id"] for r in found.collect()} == dict(zip(prints, labels.tolist()))


def test_copies_meet_beside_the_first_of_a_band(spark):
    # Likeness: 1 and 2 are near, 0 is near to neither; all share a band.
    random = np.random.default_rng(6)
    base = "".join(chr(c) for c in random.integers(97, 123, 3000))
    other = base[:1500] + "".join(chr(c) for c in random.integers(97, 123, 1500))
    prints = [edit_prints.fingerprint(t) for t in (other, base, edited(random, base, 20))]
    distinct = spark.createDataFrame(list(enumerate(prints)), "node bigint, fingerprint string")
    ties = spark.createDataFrame([(7, 1, 0), (7, 2, 0)], "key bigint, node bigint, first bigint")
    none = spark.createDataFrame([], "node bigint, cluster bigint")
    assert edit_prints._verified(ties, distinct, 0.8).count() == 0
    for block in (1024, 1):
        edges = edit_prints._compared(ties, none, distinct, 0.8, block).collect()
        assert {(r["src"], r["dst"]) for r in edges} == {(2, 1)}


def test_bands_that_share_texts_are_not_compared_with_each_other(spark):
    # Texts in a chain of bands of three; the expected links are those of all pairs within a band that lie apart.
    random = np.random.default_rng(9)
    bases = ["".join(chr(c) for c in random.integers(97, 123, 900)) for _ in range(7)]
    prints = [edit_prints.fingerprint(edited(random, bases[i % 7], 2)) for i in range(21)]
    bands = [[k, k + 1, k + 2] for k in range(0, 19, 2)] + [[0, 1, 7, 8, 14], [2, 3, 9, 20]]
    distinct = spark.createDataFrame(list(enumerate(prints)), "node bigint, fingerprint string")
    ties = [(k, n, b[0]) for k, b in enumerate(bands) for n in b[1:]]
    ties = spark.createDataFrame(ties, "key bigint, node bigint, first bigint")
    groups = spark.createDataFrame([(0, 0), (14, 0)], "node bigint, cluster bigint")
    met = {(a, b) for band in bands for a in band for b in band if a > b and (a, b) != (14, 0)}
    expected = {p for p in met if edit_prints.likeness(prints[p[0]], prints[p[1]]) >= 0.8}
    assert expected == {(7, 0), (14, 7), (8, 1), (9, 2)}
    for block in (1024, 2, 1):
        edges = edit_prints._compared(ties, groups, distinct, 0.8, block).collect()
        assert sorted((r["src"], r["dst"]) for r in edges) == sorted(expected)


def test_bands_of_one_first_text_meet_as_one_group(spark, monkeypatch):
    # Six bands hold the same five texts, one holds two of them and another: a row for each text, not for each band.
    random = np.random.default_rng(12)
    bases = ["".join(chr(c) for c in random.integers(97, 123, 900)) for _ in range(3)]
    prints = [edit_prints.fingerprint(edited(random, bases[i], 2)) for i in (0, 1, 1, 2, 2, 1)]
    distinct = spark.createDataFrame(list(enumerate(prints)), "node bigint, fingerprint string")
    ties = [(k, n, 0) for k in range(6) for n in (1, 2, 3, 4)] + [(6, n, 0) for n in (1, 3, 5)]
    ties = spark.createDataFrame(ties, "key bigint, node bigint, first bigint")
    written = {}

    def kept(df, name, **options):
        written[name] = cut_lineage(df, name, **options)
        return written[name]

    monkeypatch.setattr(edit_prints, "cut_lineage", kept)
    none = spark.createDataFrame([], "node bigint, cluster bigint")
    for block in (1024, 2, 1):
        edges = edit_prints._compared(ties, none, distinct, 0.8, block).collect()
        # Texts 2 and 5 are alike, but no band holds both.
        assert sorted((r["src"], r["dst"]) for r in edges) == [(2, 1), (4, 3), (5, 1)]
        assert sorted(r["node"] for r in written["print-open"].collect()) == [0, 1, 2, 3, 4, 5]


def test_shuffles_of_a_write_go_with_it_on_demand(spark):
    before = spark.conf.get(lineage.DROP_SHUFFLES, None)
    rows = cut_lineage(spark.range(100).repartition(3, "id"), drop_shuffles=True)
    assert sorted(r["id"] for r in rows.collect()) == [*range(100)]
    assert spark.conf.get(lineage.DROP_SHUFFLES, None) == before


def test_band_keys_and_likeness_of_many_texts():
    random = np.random.default_rng(10)
    base = "".join(chr(c) for c in random.integers(97, 123, 5000))
    prints = [edit_prints.fingerprint(edited(random, base[:n], n // 20)) if n else "0:" for n in (0, 1, 5, 70, 400, 800, 4000, 5000, 4900)]
    rows, keys = edit_prints.band_keys(prints, 0.8, 20, 8)
    assert sorted({*rows.tolist()}) == [*range(1, len(prints))]
    for i, one in enumerate(prints):
        assert sorted(keys[rows == i].tolist()) == sorted(edit_prints.band_keys([one], 0.8, 20, 8)[1].tolist())
    a, b = np.triu_indices(len(prints), 1)
    alike = edit_prints.likeness_of(*edit_prints._unpacked(prints), a, b)
    assert np.allclose(alike, [edit_prints.likeness(prints[i], prints[j]) for i, j in zip(a, b)])


def test_recall_is_enforced(spark):
    # Pairs in a table of many blocks, with lists too short to find them.
    random = np.random.default_rng(8)
    x = random.standard_normal((300, 24))
    x = np.concatenate([x, x + 0.22 * random.standard_normal(x.shape) * np.abs(x).mean()])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    exact = (unit @ unit.T >= 0.95).sum(1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    plan = nn_descent.DescentPlan(block=4, passes=1, neighbours=1, joined=1, rounds=1, audited=32, compared=200)
    rows = sorted(nn_descent.near_duplicate_vectors(table, plan).collect())
    assert exact.sum() > 200 and [r["n_links"] for r in rows] == exact.tolist()


def test_text_beside_a_long_paragraph_stays():
    long, short = "many words " * 450, "some words " * 27
    page = f"<body><div><h1>The title</h1><p>{short}</p><p>{long}</p></div></body>"
    assert wrapper.extract_block([page]) == [" ".join(f"The title {short} {long}".split())]
    assert wrapper.extract_block([f"<body><div><div>Lead.</div><div><pre>{long}</pre></div></div></body>"]) == [f"Lead. {long}".strip()]


def test_class_words_do_not_drop_the_article():
    text = "The whole article of this page. " * 20
    for start in ("div class='content has-sidebar'", "div id='page' class='no-sidebar'", "article class='post comments-open alert'", "div class='layout top'", "div class='top'"):
        tag = start.split()[0]
        page = f"<body><div class='sidebar'>Other pages</div><{start}><p>{text}</p></{tag}></body>"
        assert wrapper.extract_block([page]) == [text.strip()]


def test_near_copies_do_not_hide_a_stem(spark):
    random = np.random.default_rng(9)
    words = ["".join(chr(c) for c in random.integers(97, 123, 6)) for _ in range(400)]
    some = lambda n: " ".join(random.choice(words, n))
    rows = [(f"{some(10)} grubling {some(10)}", 1) for _ in range(40)] + [(some(20), 0) for _ in range(200)]
    copied = some(25).split()
    for i in range(300):
        rows.append((" ".join([*copied[:12], "grubling", *copied[12:], f"end{i}"]), 1))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    assert any("grubling".startswith(s) for s in toxicity.learn_lexicon(docs, labels).weights)
