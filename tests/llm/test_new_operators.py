"""Fill-in-the-middle (op11), periodic runs (op12) and the URL filter (op13): brute force, SQL twins and edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tekstmill.llm import fim, runs, url_filter

TEXTS = [
    "", None, "Hello, world! abc", "<P> already a sentinel", "x<S>y", "ÆØÅ café 🙂\nnew line\ttab", "a" * 50_000,
    " ".join(f"w{i % 7}" for i in range(3_000)), "12 34 ab-cd", "one", "a b", "<M>",
]
SCHEMA = "doc_id bigint, text string, fim_n string, form string, runs int, collapsed double, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 1, 2.0, "z") for i, t in enumerate(TEXTS * 2)] + [(None, "no id", "x", "y", 1, 2.0, "z")]
    rows += [(1000 + i, TEXTS[2], "x", "y", 1, 2.0, "z") for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def as_duckdb(df):
    import pyarrow as pa

    rows = [r.asDict() for r in df.select("doc_id", "text").collect()]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    return con


# --- op11 ---------------------------------------------------------------------------------------------------------


def test_wavelet_rank_equals_counting():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 3, 5_000)
    matrix = fim.WaveletMatrix(values, 2)
    positions = rng.integers(0, 5_001, 300)
    for symbol in range(3):
        expected = np.array([(values[:p] == symbol).sum() for p in positions])
        assert (matrix.rank(symbol, positions) == expected).all()


def test_cuts_equal_the_token_pattern():
    texts = ["", "ab cd", "Ünïcode and ASCII", "!!", "abc", "a1b2c3 zz", "x" * 1000 + " y"]
    index = fim.TokenIndex(texts)
    pattern = re.compile(r"[A-Za-z]+|[^A-Za-z]")
    n = index.counts()
    for i, text in enumerate(texts):
        tokens = pattern.findall(text)
        assert n[i] == len(tokens)
        for k in range(len(tokens) + 1):
            cut = index.cut_after(np.array([k if j == i else 0 for j in range(len(texts))]))[i]
            assert cut == len("".join(tokens[:k]))


def test_op11_equals_its_sql(docs):
    got = fim.fill_in_middle(docs).select(
        "doc_id", "fim_n", "fim_form", "prefix_chars", "middle_chars", "fim_text", "fim_restored", "text"
    ).collect()
    expected = {r[0]: r for r in as_duckdb(docs).sql(fim.OP11_SQL).fetchall()}
    assert len(got) == len(TEXTS) * 2 + 4
    for row in got:
        if row.doc_id is None:
            assert row.fim_restored == "no id"
            continue
        e = expected[row.doc_id]
        assert (row.fim_n, row.fim_form, row.prefix_chars, row.middle_chars) == e[1:5]
        assert hashlib.sha256(row.fim_text.encode()).hexdigest() == e[5]
        assert row.fim_restored == (row.text or "")


def test_op11_forms_and_restore():
    assert fim.fim_form("", 0, 0) == "plain" and fim.fim_form("a<P>b", 0, 0) == "plain"
    assert fim.fim_form("ab", 95, 0) == "plain" and fim.fim_form("ab", 0, 5) == "spm" and fim.fim_form("ab", 0, 50) == "psm"
    for form in ("psm", "spm", "plain"):
        assert fim.restore(fim.arrange("pre", "mid", "suf", form), form) == "premidsuf"


def test_op11_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fim.fill_in_middle(empty).count() == 0


# --- op12 ---------------------------------------------------------------------------------------------------------


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            smaller = any(all(words[k] == words[k + p] for k in range(i, i + size - p)) for p in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(1500):
        n, k = rng.randint(0, 80), rng.randint(1, 4)
        words = [rng.choice("abcd"[:k]) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            words = runs.planted(words, 10 * rng.randint(0, 10**6))
        assert runs.find_runs(words) == brute_runs(words), words


def test_pruning_keeps_every_run():
    rng = random.Random(11)
    for _ in range(300):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(50, 400))]
        words = runs.planted(base, 10 * rng.randint(0, 10**6))
        ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
        whole = runs.squares([ids[w] for w in words])
        full = sorted(
            (s, e - s, p) for (s, p), e in whole.items()
            if e - s >= max(6, 4 * p) and runs.primitive([ids[w] for w in words], s, p)
        )
        assert sorted(runs.find_runs(words)) == full


def test_planted_tail():
    words = [str(i) for i in range(40)]
    out = runs.planted(words, 10 * 13)  # g = 13: a = 13, p = 1 + 27 // 8 = 4
    assert out[:13] == words[:13] and out[13:17] == ["13", "14", "15", "16"] and out[17] == "13"
    assert runs.planted(words, 11) == words and runs.planted([], 0) == []


def test_collapse_keeps_first_period():
    words = "x a b a b a b a b a b y".split()
    found = runs.find_runs(words)
    assert found == [(1, 10, 2)]
    assert runs.collapse(words, found) == "x a b y"


def test_op12_edge_cases(docs, spark):
    got = {r.doc_id: r for r in runs.detect_runs(docs).collect()}
    assert len(runs.detect_runs(docs).collect()) == len(TEXTS) * 2 + 4
    long_word = got[6]
    assert long_word.n_words == 1 and long_word.runs == []
    assert got[1].n_words == 0 and got[1].collapsed == ""
    assert got[1000].runs == got[1001].runs == [] and got[1000].collapsed == got[1001].collapsed == TEXTS[2]
    assert runs.detect_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_op12_query_columns(docs):
    found = runs.detect_runs(docs.filter("doc_id = 7"))
    row = found.first()
    words = runs.planted(TEXTS[7].split(), zlib.crc32(b"7"))
    assert [(r.start, r.length, r.period) for r in row.runs] == runs.find_runs(words)


# --- op13 ---------------------------------------------------------------------------------------------------------

URLS = [
    "http://www.example.net/en/x", "https://a.b.NET/", "http://example.com/de/7", "http://shop.example.com/fr/",
    "https://x.org/fr/a?q=1", "https://x.org/frx", "ftp://noslash", None, "no scheme here", "HTTP://UPPER.NET/De/",
    "https://cheap-pills4u.example.com/en/1#top", "https://example.net", "http://é.net/",
]


def python_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    return host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)), path


def python_rule(host, path):
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string")
    host, path = url_filter.host_and_path(df.url)
    rows = df.select("url", host.alias("h"), path.alias("p")).collect()
    for r in rows:
        assert (r.h, r.p) == python_host_path(r.url)
    rule, verdict = url_filter.rule_of(host, path)
    for r in df.select("url", rule.alias("rule"), verdict.alias("v")).collect():
        assert (r.rule, r.v) == python_rule(*python_host_path(r.url))


def all_splits(run):
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        words, start = [], 0
        for i, c in enumerate(cuts, start=1):
            if c:
                words.append(run[start:i])
                start = i
        yield words + [run[start:]]


def test_viterbi_equals_all_splits():
    counts = {"cheap": 50, "pills": 20, "che": 5, "ap": 9, "pill": 30, "s": 100, "a": 300}
    total = 10_000

    def score(words):
        return sum(
            math.log(counts[w] / total) if w in counts else math.log(url_filter.UNKNOWN / total) - len(w) * math.log(10)
            for w in words
        )

    for run in ["cheappills", "apills", "xyz", "a", "sapa"]:
        known = {(i, j): counts[run[i:j]] for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in counts}
        best = max(all_splits(run), key=score)
        assert math.isclose(score(url_filter.viterbi(run, known, total)), score(best))


def test_judge_urls_against_python(spark):
    pages = spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(URLS * 3)] + [(99, URLS[0], "x", "y")],
        "page_id int, url string, host string, verdict string",
    )
    docs = spark.createDataFrame([(1, "cheap pills for you, cheap"), (2, None), (3, "shop and example")], "doc_id int, text string")
    out = url_filter.judge_urls(pages, docs).collect()
    assert len(out) == len(URLS) * 3 + 1
    for r in out:
        url = (URLS * 3 + [URLS[0]])[r.page_id] if r.page_id != 99 else URLS[0]
        assert (r.host, r.path) == python_host_path(url)
        rule, verdict = python_rule(r.host, r.path)
        assert r.rule == rule
        assert r.verdict == (verdict or r.nb_verdict)
        assert r.nb_verdict == ("block" if r.nb_margin > 0 else "allow")


def test_naive_bayes_equals_counting(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string")
    docs = spark.createDataFrame([(1, "cheap pills example")], "doc_id int, text string")
    out = {r.page_id: r for r in url_filter.judge_urls(pages, docs).collect()}
    # Recount by hand from the rows and tokens.
    host_words = {}
    for r in out.values():
        host_words[(r.host, r.path)] = None
    tokens = url_filter.url_tokens(
        spark.createDataFrame(list(host_words), "host string, path string"),
        url_filter.word_counts(docs), 3,
    ).collect()
    by_pair = {}
    for t in tokens:
        by_pair.setdefault((t.host, t.path), []).append(t.token)
    labelled = [(r.host, r.path, python_rule(r.host, r.path)[1]) for r in out.values()]
    labelled = [x for x in labelled if x[2]]
    counts = {"allow": {}, "block": {}}
    for h, p, v in labelled:
        for t in by_pair.get((h, p), []):
            counts[v][t] = counts[v].get(t, 0) + 1
    vocabulary = set(counts["allow"]) | set(counts["block"])
    totals = {c: sum(counts[c].values()) for c in counts}
    prior = {c: math.log((sum(1 for x in labelled if x[2] == c) + 1) / (len(labelled) + 2)) for c in counts}
    for r in out.values():
        margin = prior["block"] - prior["allow"]
        for t in by_pair.get((r.host, r.path), []):
            if t in vocabulary:
                margin += math.log((counts["block"].get(t, 0) + 1) / (totals["block"] + len(vocabulary)))
                margin -= math.log((counts["allow"].get(t, 0) + 1) / (totals["allow"] + len(vocabulary)))
        assert math.isclose(r.nb_margin, margin, abs_tol=1e-9)


def test_op13_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert url_filter.judge_urls(pages, docs).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    assert url_filter.judge_urls(one, docs).first().verdict == "allow"
