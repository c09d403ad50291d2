"""Operators against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tekstmill.llm import bpe, common, edit_prints, forest, mixing, nn_descent, quality, token_files, toxicity, training, warc, wrapper

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_LIBRARY = Tokenizer.from_file(WORD_BPE)
LETTERS = "abcdeéÉßİΣσç'’!?#$ \t\n\x0b\x1c\x85\xa0 　<|endoftext|>STREVLlmd01²½日本🙂é​ǅﬁ\x00"


def texts_of(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


# -- tokens --------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*LETTERS, "<|endoftext|>", "<|startoftext|>", "don't"]), max_size=40).map("".join))
def test_word_bpe_equals_the_library(text):
    library, own = WORD_LIBRARY, bpe.load(WORD_BPE)
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_merges_by_number_are_those_of_the_file():
    import public_tokenizers

    coder = bpe.ForcedBoundaryBPE(public_tokenizers.path("word_bpe_49k.json"))
    assert [coder.tokens[x] for x in coder.made] == [a + b for a, b in coder.ranks]

    def plain(parts):
        while pairs := [(coder.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in coder.ranks]:
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    random = np.random.default_rng(13)
    words = [bytes(random.choice(list(b"aaabeeinnorstthl's1\xc3\xa9"), n).tolist()) for n in (1, 2, 3, 5, 8, 13, 40, 64, 65, 90) for _ in range(30)]
    for word in [b"internationalization", b"aaaaaaaaaaaa", b"thethethethe", *words]:
        for last in (True, False):
            parts = [coder.letters[b] for b in word]
            parts[-1] += coder.end if last else ""
            assert [coder.tokens[x] for x in coder.merge(word, last)] == plain(parts)


def test_cuts_are_certain():
    own = bpe.load(WORD_BPE)
    for word in ("hello", "naïve", "xqzj", "日本語"):
        pieces = own.cut(word.encode())
        assert b"".join(pieces) == word.encode()
        assert all((a[-1], b[0]) not in own.inside for a, b in itertools.pairwise(pieces))


def test_op6_on_a_table(spark):
    library = Tokenizer.from_file(WORD_BPE)
    texts = texts_of(spark, SMALL)
    for r in bpe.op6_bpe_round_trip(spark, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_byte_pieces_equal_the_library():
    random.seed(4)
    library, own = Tokenizer.from_file(BYTE_BPE), token_files.Encoder(BYTE_BPE)
    texts = ["".join(random.choice(LETTERS) for _ in range(random.randrange(30))) for _ in range(5000)] + ["a<|endoftext|> b"]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_op5_on_a_table(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = {r["doc_id"]: r for r in token_files.op5_token_files(spark, SMALL).collect()}
    at = 0
    for doc_id, text in sorted(texts_of(spark, SMALL).items()):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (rows[doc_id]["start"], rows[doc_id]["n_tokens"]) == (at, len(ids))
        assert rows[doc_id]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_sequences_are_views_of_the_file(tmp_path):
    uri = str(tmp_path / "a.arrow")
    file = token_files.SequenceFile(uri, 8, np.uint16)
    run = np.arange(8 * token_files.BATCH_SEQUENCES + 11, dtype=np.uint16)
    assert [file.add(run[:5]), file.add(run[5:])] == [0, 5]
    file.close()
    reader = token_files.SequenceReader(uri)
    assert not reader.batch(0).flags.owndata
    ids, mask = reader.sequence(token_files.BATCH_SEQUENCES + 1)
    assert ids.tolist() == [*run[-3:], 0, 0, 0, 0, 0] and mask.tolist() == [True] * 3 + [False] * 5
    assert np.concatenate(list(reader.ids(3, len(run) - 3))).tolist() == run[3:].tolist()


# -- near duplicates -----------------------------------------------------------------


def test_forest_equals_all_pairs(spark):
    texts = texts_of(spark, MEDIUM)
    sets = {i: set(forest.shingles(t).tolist()) for i, t in texts.items()}
    links, root = dict.fromkeys(texts, 0), {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b]) if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) else 0
        if texts[a] == texts[b] or common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            links[a], links[b] = links[a] + 1, links[b] + 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    rows = forest.op3_ngram_forest(spark, MEDIUM).collect()
    assert {r["doc_id"]: (r["n_links"], r["class_id"]) for r in rows} == {i: (links[i], find(i)) for i in texts}
    kept = forest.drop_near_duplicates(spark.read.parquet(f"{MEDIUM}/documents.parquet")).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({find(i) for i in texts})


def test_forest_in_blocks(spark):
    """A group of near copies that is dealt into several blocks loses no link."""
    random.seed(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        words[random.randrange(120)] = f"x{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plan = forest.ForestPlan(block_rows=7)
    rows = forest.join_near_duplicates(docs, plan).collect()
    sets = [set(forest.shingles(t).tolist()) for t in texts]
    expected = [sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    assert [r["n_links"] for r in sorted(rows)] == expected and {r["class_id"] for r in rows} == {0}


def test_prefixes_are_shortened_until_the_recall():
    plan = forest.ForestPlan()
    assert plan.recall_at(plan.prefix()) >= plan.recall > plan.recall_at(plan.prefix() + 1)


def test_vectors_equal_all_pairs(spark):
    random_ = np.random.default_rng(3)
    centers = random_.standard_normal((80, 24))
    x = np.repeat(centers, 12, axis=0) + 0.08 * random_.standard_normal((960, 24))
    x = np.concatenate([x, random_.standard_normal((400, 24)), x[:30]]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    exact = (unit @ unit.T >= 0.95).sum(1) - 1
    plan = nn_descent.DescentPlan(block=128, passes=2)
    rows = sorted(nn_descent.near_duplicate_vectors(table, plan).collect())
    found = np.array([r["n_links"] for r in rows])
    assert exact.sum() > 5000 and (found <= exact).all() and found.sum() >= 0.99 * exact.sum()
    nodes = nn_descent.nodes_of(table, "vec_id", "embedding")
    _, audits = nn_descent.neighbour_graph(nodes, plan)
    assert audits[-1][1] >= 0.9 * audits[-1][0]


# -- fingerprints --------------------------------------------------------------------


def plain_walk(points):
    """The walk step by step."""
    heads = np.random.default_rng(11).integers(0, 2, (edit_prints.CLASSES, edit_prints.PERIOD)).astype(bool)
    ends, t = [], 0
    for p in points.tolist():
        k = ((p * 2_654_435_761) % (1 << 32) >> 27) % edit_prints.CLASSES
        while not heads[k, t % edit_prints.PERIOD]:
            t += 1
        t += 1
        ends.append(t)
    return ends


def test_walk_equals_single_steps():
    for text in ("", "a", "the same text " * 300, "ÆØÅ🙂日本" * 50):
        points = edit_prints.code_points(text)
        assert edit_prints.walk(points).tolist() == plain_walk(points)
        cut = len(points) // 2
        ends = edit_prints.walk(points)
        assert edit_prints.walk(points[cut:], int(ends[cut - 1]) if cut else 0).tolist() == ends[cut:].tolist()


def test_op9_on_a_table(spark):
    texts = sorted(texts_of(spark, SMALL).items(), reverse=True)
    rows = {r["doc_id"]: r for r in edit_prints.op9_edit_prints(spark, SMALL).collect()}
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        edited, own = edit_prints.edit(text, following), edit_prints.fingerprint(text)
        r = rows[doc_id]
        assert r["fingerprint"] == own and r["edited_fingerprint"] == edit_prints.fingerprint(edited)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(text)
        assert r["near_next"] == pytest.approx(edit_prints.likeness(own, edit_prints.fingerprint(following)))
        assert r["near_edited"] == pytest.approx(edit_prints.likeness(own, r["edited_fingerprint"]))
    apart = [r["near_edited"] > r["near_next"] for r in rows.values() if r["n_chars"] > 100 and r["near_next"] < 0.5]
    assert np.mean(apart) > 0.99


def test_few_edits_stay_near():
    text = " ".join(f"word{i * i % 997}" for i in range(400))
    for edited in (text[:900] + "X" + text[901:], text[:700] + text[705:], text[:1500] + "abc" + text[1500:]):
        assert edit_prints.likeness(edit_prints.fingerprint(text), edit_prints.fingerprint(edited)) > 0.6


# -- classifiers ---------------------------------------------------------------------


def accuracy(rows, labels, name, predicted):
    held = [(predicted(r), labels[r["doc_id"]][name]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return np.mean([bool(p) == bool(y) for p, y in held])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert accuracy(toxicity.op8_toxicity(spark, folder).collect(), labels, "toxic", lambda r: r["predicted"]) > 0.98
    assert accuracy(quality.op10_quality(spark, folder).collect(), labels, "quality", lambda r: r["kept"]) > 0.97


def test_disguises_are_folded():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "scum": 4.0}, exceptions={"scum bucket"})
    find = lambda t: len(toxicity.matches(toxicity.fold(t), lexicon, lexicon.automaton()))
    assert [find(t) for t in ("an 1d10t", "ІDІОТ", "ïdïót!", "id​iot", "kidiot", "scum", "a scum bucket", "")] == [1, 1, 1, 1, 0, 1, 0, 0]


def test_sites_are_shrunk(spark):
    """A path with few documents stays near its host, one with many goes its own way."""
    rows = [("h", "many", 3.0)] * 400 + [("h", "few", -3.0)] + [("g", "x", -3.0)] * 400 + [(None, None, 0.0)]
    logits = spark.createDataFrame(rows, "host string, path string, doc_logit double")
    rates = {(r["host"], r["path"]): r for r in quality.site_rates(logits).collect()}
    assert rates["h", "many"]["path_rate"] > 0.9 and rates["g", "x"]["path_rate"] < 0.1
    assert 0.2 < rates["h", "few"]["path_rate"] < rates["h", "many"]["path_rate"]
    assert sum(r["n"] for r in rates.values()) == 802 and (None, None) in rates


def test_held_out_is_crc32(spark):
    rows = spark.range(50).select("id", training.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


# -- mixing --------------------------------------------------------------------------


def test_targets_share_the_excess(spark):
    table = spark.createDataFrame([("a", 1, 10), ("b", 1, 1000), ("c", 1, 5), (None, 1, 985)], "source string, n_docs bigint, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    # c and a are full at three times their size; b and the NULL source share the rest by 2 to 1.
    assert found["a"] == 30 and found["c"] == 15
    assert found["b"] == pytest.approx(1955 * 2 / 3) and found[None] == pytest.approx(1955 / 3)


def test_one_emission_per_integer_passed(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(300)], "doc_id bigint, text string, source string")
    rows = mixing.plan_mix(docs).collect()
    for source_size, target in {(r["source_size"], r["target"]) for r in rows}:
        copies = [r["copies"] for r in rows if r["source_size"] == source_size]
        rate = target / source_size
        assert set(copies) <= {int(rate), int(rate) + 1} and abs(sum(copies) - rate * len(copies)) <= 1
    assert sorted(rows) == sorted(mixing.plan_mix(docs.repartition(7)).collect())


# -- pages ---------------------------------------------------------------------------


def test_loser_tree_sorts():
    random.seed(8)
    for n in (0, 1, 2, 3, 7, 16):
        runs = [sorted((random.randrange(20), i, k) for k in range(random.randrange(9))) for i in range(n)]
        assert [x for _, x in warc.LoserTree([iter(r) for r in runs])] == sorted(itertools.chain(*runs))


def test_archive_is_readable(tmp_path):
    digest = warc.base32_sha1(b"<p>x</p>")
    assert digest == base64.b32encode(hashlib.sha1(b"<p>x</p>").digest()).decode()
    archive = warc.Archive(str(tmp_path), "a.warc.gz")
    record = warc.record_bytes("response", "http://h/\n", "2024-01-01T00:00:00Z", "1", digest, 8, b"<p>x</p>", "")
    archive.add("k", 1, "1", record)
    (_, _, _, start, length), = archive.close()
    raw = (tmp_path / "a.warc.gz").read_bytes()
    fields, http, payload = warc.parse_record(zlib.decompress(raw[start : start + length], 31))
    assert payload == b"<p>x</p>" and http["Content-Length"] == "8" and fields["WARC-Target-URI"] == "http://h/%0A"


@pytest.mark.parametrize(("url", "key"), [("http://www.B.example/x?q#f", "example,b,www)/x?q"), ("https://u@h:8/", "h:8)/"), ("", ""), ("http://h", "h)/")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


PAGE = (
    "<html><body><div class='hd'>The site</div><ul class=links><li><a href=/>Home</a><li><a href=/a>About us</a></ul>"
    "<div><h1>Title {0}</h1><p>Body {0} of the text, caf&eacute; &#8212; a<br>b <b>bo</b>ld.<p>Second {0} part {1}</div>"
    "<div>Written by our staff. All rights reserved.</div>"
    "<div class='reader-comments'><p>First! {0}</p></div><form><p>Your mail {0}</p></form></body></html>"
)


def test_wrapper_finds_the_slots():
    pages = [PAGE.format(i, "more " * (i % 5) + f"end{i}") for i in range(9)]
    for i, text in enumerate(wrapper.extract_block(pages)):
        more = "more " * (i % 5) + f"end{i}"
        assert text == f"Title {i} Body {i} of the text, café — a b bold. Second {i} part {more}"


def test_copies_are_no_template():
    page = "<body><div>Menu</div><div><p>The same long article on every page, word for word.</p></div></body>"
    assert set(wrapper.extract_block([page] * 20)) == {"The same long article on every page, word for word."}


def test_tree_matching_counts():
    trees = [wrapper.parse(p) for p in ("<div><p>a</p><ul><li>x</ul></div>", "<div><ul><li>x<li>y</ul><p>a</p></div>")]
    for t in trees:
        wrapper.measure(t)
    # The page, the division, and of list and paragraph the larger: the list with one item.
    assert wrapper.match_size(*trees, {}) == 4


# -- pipeline ------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    good = pipeline.quality_stage(spark, docs, MEDIUM)
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns
    assert all(i in kept for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0)
    clean = {r["doc_id"] for r in pipeline.toxicity_stage(spark, docs, MEDIUM).collect()}
    assert np.mean([(i in clean) == (not r["toxic"]) for i, r in labels.items()]) > 0.98
    rows = pipeline.run(spark, MEDIUM)
    assert rows.filter(F.size("token_ids") != F.col("n_tokens")).isEmpty() and rows.count() > 300
    assert {r["doc_id"] for r in rows.select("doc_id").distinct().collect()} <= kept
    assert pipeline.token_stage(spark, pipeline.mixing_stage(spark, docs.limit(0), MEDIUM), MEDIUM).isEmpty()


def test_spark_entry_lists_them():
    import __spark_entry__ as entry

    names = entry.queries()
    numbered = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert "pipeline" in names and numbered == list(range(1, 14))
    assert {"op1_warc_merge", "op4_mix_sources", "op11_fill_in_middle"} <= set(entry.oracle_sql())


def test_byte_pieces_equal_the_library_on_white_space():
    """All white space of the pattern's class, in runs beside blanks, letters, marks and a special token."""
    random.seed(9)
    library, own = Tokenizer.from_file(BYTE_BPE), token_files.Encoder(BYTE_BPE)
    spaces = "\t\n\x0b\x0c\r \x85\xa0        　"
    alphabet = spaces + "  aab́é中.,'1\U0001F642"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randrange(25))) for _ in range(100_000)]
    texts += [" \xa0 \xa0", "a \xa0 b<|endoftext|> \n", "x \n y", "a \xa0b"]
    for low in range(0, len(texts), 5000):
        chunk = texts[low : low + 5000]
        for text, ids in zip(chunk, own.encode(chunk)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_words_merge_like_the_library_in_time():
    import time

    own = bpe.load(WORD_BPE)
    for unit in ("a", "ab", "thequickbrownfox", "tion"):
        word = unit * (20_000 // len(unit))
        began = time.perf_counter()
        ids = own.encode(word).tolist()
        assert time.perf_counter() - began < 5
        assert ids == WORD_LIBRARY.encode(word, add_special_tokens=False).ids


def test_word_bpe_decodes_columns_like_lists():
    import pyarrow as pa

    own = bpe.load(WORD_BPE)
    ids = [own.encode(t).tolist() for t in ("", "One two, three!", "Straße 12 日本", "")] + [[]]
    assert own.decode_column(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == [own.decode(x) for x in ids]


def test_printable_texts_are_cut_without_a_search(monkeypatch):
    crowded = token_files.CROWDED
    texts = ["", " ", "a b", " a", "a ", "a  b", "a\n b", "a\nb c", "a\u3000 b", "a \xa0b", "\u2028 x", "a\tb", "\x00 b", "\u200b c d"]
    for text in texts:
        whole, spaced = token_files._pieces(text)
        assert "".join(whole) + "".join(" " + p for p in spaced) == text
        assert bool(spaced) == (" " in text and not crowded.search(text))
    monkeypatch.setattr(token_files, "CROWDED", None)
    assert token_files._pieces("one two,\nthree four") == (["one"], ["two,\nthree", "four"])


def test_texts_go_to_the_worker_once(spark, capsys):
    import pyarrow as pa

    docs = spark.createDataFrame([(1, "one", "x"), (2, None, "y"), (3, "", None)], "id int, text string, other string")
    fields = [("n", "int")]

    def make():
        return lambda texts: [pa.array([len(t) for t in texts], pa.int32())]

    def sent(df):
        df.explain()
        (line,) = [x for x in capsys.readouterr().out.splitlines() if "MapInArrow" in x]
        return line[line.index("(") : line.index(")")].count(",") + 1

    kept = common.map_texts(docs, ["id"], "text", make, fields)
    assert kept.columns == ["id", "n"] and sent(kept) == 2
    assert sorted(map(tuple, kept.collect())) == [(1, 3), (2, 0), (3, 0)]
    whole = common.append_columns(docs, "text", make, fields)
    assert whole.columns == ["id", "text", "other", "n"] and sent(whole) == 3
    assert sorted(map(tuple, whole.collect())) == [(1, "one", "x", 3), (2, None, "y", 0), (3, "", None, 0)]
    # A text that is replaced, or no string, still has a column of its own.
    replaced = common.append_columns(docs, "text", make, [("TEXT", "int")])
    assert replaced.columns == ["id", "other", "TEXT"]
    assert sorted(map(tuple, replaced.collect())) == [(1, "x", 3), (2, "y", 0), (3, None, 0)]
    numbers = common.append_columns(docs, "id", make, fields)
    assert numbers.columns == ["id", "text", "other", "n"] and [r["n"] for r in numbers.collect()] == [1, 1, 1]


def test_a_tokenizer_keeps_no_tables_of_strings_for_encoding():
    coder = bpe.ForcedBoundaryBPE(WORD_BPE)
    text = "One two, internationalization " + "thequickbrownfox" * 20
    ids = coder.encode(text)
    assert ids.tolist() == WORD_LIBRARY.encode(text, add_special_tokens=False).ids
    assert not {"vocab", "ranks", "tokens"} & set(vars(coder))
    assert coder.decode(ids.tolist()) == WORD_LIBRARY.decode(ids.tolist(), skip_special_tokens=False)
