"""Periodic runs of words: online suffix automaton with link-cut access over its suffix-link tree.

Words are the runs of ``[^\\x20\\x09-\\x0D]+`` of a text, numbered from 0. A run is a stretch of consecutive words with
smallest period q (words q apart are equal), of length at least max(6, 4 q), that no neighbouring word extends with
period q. A word is dropped if some run holds it after that run's first q words; the collapsed text is the kept words
joined by one space.

Method. Words are appended one at a time to a suffix automaton. Its suffix-link tree is held in a link-cut tree whose
preferred paths carry a colour: the end of the last occurrence of every suffix on the path. Appending word i adds a
leaf for the whole prefix; ``access`` of that leaf walks its root path and meets it in segments of one colour j each,
the deepest state of a segment of length hi. The suffixes of the prefix that last ended at j are those up to length
hi, so the longest common suffix of prefixes i and j is hi; where d = i - j <= hi, the words from i - hi - d + 1 to i
have period d, which is a square ending at i, extended to the left as far as it goes. The access then recolours the
whole path with i. A run of smallest period q is met so at each of its positions from its second period on with the
same start (a later occurrence of its last q words inside it would make q no smallest period), so the largest end
found for a (start, period) is the run's end. A clone that the automaton splits off a state is put into the state's
preferred path just above it, with its colour, so colours stay whole on paths without a structural access. Found
repetitions of length >= max(6, 4 d) are kept if their first d words are no power of a shorter word (then d is the
smallest period). Work per word is amortised O(log n).

Only stretches that can hold a run go through the automaton; the rest provably holds none. In a run of period q every
word from the (q+1)-th on occurred q words before, so its distance to the previous occurrence of the same word is at
most q, over at least max(5, 3 q) words in a row. For each Q = 1, 2, 4, ... up to n (q in (Q/2, Q]) the stretches of
words with distance <= Q and of length >= max(5, 3 (Q // 2) + 1) are found by array operations, widened by Q to the
left, and the overlapping ones merged. Every run lies inside one merged interval, and a run found inside an interval
is maximal in the whole text (an extension of it would be a run too, inside an interval that meets this one), so the
result equals that of the whole text; tests compare it with brute force.

Before the search, the text of every id whose unsigned crc32 of the decimal id, h, has h % 10 = 0 and n > 0 is made
periodic from word a = g % n (g = h // 10) on: word i >= a becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).

Inputs: a NULL text has no words; a NULL id hashes as the empty id. Texts are used whole, each in one task. Repeated
rows give equal rows; an empty table gives an empty result. Columns named like the new ones are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import append_columns, read_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = "struct<start:bigint,length:bigint,period:bigint>"
FIELDS = [("runs", f"array<{RUN}>"), ("collapsed", "string"), ("n_words", "bigint")]


def planted(words: list[str], h: int) -> list[str]:
    """The words after the periodic tail that ``h`` (crc32 of the id) plants, if it plants one."""
    n = len(words)
    if h % 10 != 0 or n == 0:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def squares(ids: list[int]) -> dict[tuple[int, int], int]:
    """{(start, period): largest end (exclusive)} of the repetitions found at each appended word."""
    size = 2 * len(ids) + 2
    # Automaton (states from 1; 1 is the root) and link-cut tree over its suffix links (0 is no node).
    length, link, moves = [0] * size, [0] * size, [None] * size
    left, right, up, colour, pending = [0] * size, [0] * size, [0] * size, [-1] * size, [-1] * size
    moves[1] = {}
    states, last = 1, 1
    found: dict[tuple[int, int], int] = {}

    def is_root(x: int) -> bool:
        p = up[x]
        return p == 0 or (left[p] != x and right[p] != x)

    def push(x: int) -> None:
        c = pending[x]
        if c != -1:
            for child in (left[x], right[x]):
                if child:
                    colour[child] = pending[child] = c
            pending[x] = -1

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if not is_root(p):
            if left[g] == p:
                left[g] = x
            else:
                right[g] = x
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b:
            up[b] = p
        up[x], up[p] = g, x

    def splay(x: int) -> None:
        chain = [x]
        y = x
        while not is_root(y):
            y = up[y]
            chain.append(y)
        for y in reversed(chain):
            push(y)
        while not is_root(x):
            p = up[x]
            if not is_root(p):
                g = up[p]
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    for i, word in enumerate(ids, start=1):
        states += 1
        cur = states
        length[cur], moves[cur] = i, {}
        p = last
        while p and word not in moves[p]:
            moves[p][word] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = moves[p][word]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                states += 1
                clone = states
                length[clone], moves[clone], link[clone] = length[p] + 1, dict(moves[q]), link[q]
                # The clone goes into q's preferred path just above q, with q's colour.
                splay(q)
                below = left[q]
                left[clone], right[clone], up[clone] = below, 0, q
                if below:
                    up[below] = clone
                left[q] = clone
                colour[clone], pending[clone] = colour[q], -1
                while p and moves[p].get(word) == q:
                    moves[p][word] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        up[cur] = link[cur]
        last = cur
        # Access: every preferred path met on the way up is a segment of one colour.
        before, x = 0, cur
        while x:
            splay(x)
            if x != cur:
                j, longest = colour[x], length[x]
                d = i - j
                if j > 0 and 0 < d <= longest:
                    key = (i - longest - d, d)
                    if found.get(key, 0) < i:
                        found[key] = i
            right[x] = before
            before = x
            x = up[x]
        splay(cur)
        colour[cur] = pending[cur] = i
    return found


def primitive(words: list, start: int, period: int) -> bool:
    """Whether the ``period`` words from ``start`` are no power of a shorter word."""
    root = words[start : start + period]
    return not any(
        period % k == 0 and root == root[:k] * (period // k) for k in range(1, period // 2 + 1)
    )


def candidate_intervals(ids: list[int]) -> list[tuple[int, int]]:
    """Merged [low, high) word intervals outside which no run can lie."""
    values = np.asarray(ids, dtype=np.int64)
    n = len(values)
    if n < 6:
        return []
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    previous = np.full(n, -1, dtype=np.int64)
    previous[order[1:][same]] = order[:-1][same]
    distance = np.where(previous >= 0, np.arange(n) - previous, n + 1)
    found, level = [], 1
    while level // 2 <= n // 4:
        need = max(5, 3 * (level // 2) + 1)
        edges = np.diff(np.concatenate([[0], (distance <= level).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - starts >= need
        found += [(max(0, int(a) - level), int(b)) for a, b in zip(starts[long], ends[long])]
        level *= 2
    merged: list[list[int]] = []
    for low, high in sorted(found):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [(a, b) for a, b in merged]


def find_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    ids, known = [], {}
    for w in words:
        ids.append(known.setdefault(w, len(known)))
    runs = []
    for low, high in candidate_intervals(ids):
        for (start, period), end in squares(ids[low:high]).items():
            size = end - start
            if size >= max(6, 4 * period) and primitive(ids, low + start, period):
                runs.append((low + start, size, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    cut = [0] * (len(words) + 1)
    for start, size, period in runs:
        cut[start + period] += 1
        cut[start + size] -= 1
    kept, inside = [], 0
    for i, w in enumerate(words):
        inside += cut[i]
        if inside == 0:
            kept.append(w)
    return " ".join(kept)


def _batch(hashes: list[int]):
    def run(texts: list[str]):
        import pyarrow as pa

        runs, collapsed, counts = [], [], []
        for text, h in zip(texts, hashes):
            words = planted(WORD.findall(text), h)
            found = find_runs(words)
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(collapse(words, found))
            counts.append(len(words))
        return [pa.array(runs), pa.array(collapsed, pa.large_string()), pa.array(counts, pa.int64())]

    return run


def id_hash(doc_id: Column) -> Column:
    """Unsigned crc32 of the decimal id (NULL: the empty id)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def detect_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``runs``, ``collapsed`` (planted tail applied) and ``n_words``."""
    keyed = df.withColumn("__crc", id_hash(F.col(f"`{doc_id}`")))
    texts = F.concat(F.col("__crc").cast("string"), F.lit(":"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    keyed = keyed.withColumn("__keyed", texts)

    def make():
        def work(values: list[str]):
            hashes, bodies = [], []
            for v in values:
                head, _, body = v.partition(":")
                hashes.append(int(head))
                bodies.append(body)
            return _batch(hashes)(bodies)

        return work

    return append_columns(keyed, "__keyed", make, FIELDS).drop("__keyed", "__crc")


def _ratio_first(a: Column, b: Column) -> Column:
    """Order of runs: greater length/period first (exact), then smaller start, then smaller period."""
    left, right = a["length"] * b["period"], b["length"] * a["period"]
    return (
        F.when(left > right, -1).when(left < right, 1)
        .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
        .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document (planted tails applied), the strongest of them, and digests of all and of the rest."""
    found = detect_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.get(F.array_sort("runs", _ratio_first), 0)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.try_divide(best["length"] * 1000 - (best["length"] * 1000) % best["period"], best["period"]).cast("bigint")
        .alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
