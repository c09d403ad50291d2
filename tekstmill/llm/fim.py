"""Fill-in-the-middle: every text cut at two token boundaries into prefix, middle and suffix, and put in FIM form.

Tokens are ``[A-Za-z]+|[^A-Za-z]`` matched left to right over code points: a run of ASCII letters, or any other single
code point. Whether a code point begins a token depends only on its class and its left neighbour's, so each code
point gets one of three classes: a letter after a letter (0), a letter that begins a run (1), anything else (2). The
classes of all texts of an Arrow batch form one sequence, held as a wavelet matrix of two levels of bit vectors with
prefix counts. A rank query (how many class-0 code points before position i) takes two lookups, so the number of
tokens in any range is its length minus that rank; the token count of every text is one vectorised rank query, and
the code point at which the k-th token ends is found by bisection on ranks, for all texts of the batch at once.

Where the cuts fall and which form a text takes comes from sha256 of ``1:`` and the decimal id (``cut_hashes``): the
prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) tokens, the middle after the larger. A text is left
plain if it is empty, holds a sentinel (``<P>``, ``<S>``, ``<M>``) or h3 % 100 >= 90; otherwise it is SPM if
h4 % 100 < 20, else PSM. ``restore`` rebuilds the text from output and form.

Inputs: a NULL text is the empty text, a NULL id hashes as the empty id. Texts of any length are used whole, inside
bounded Arrow batches (a text longer than a batch is a batch of its own). Repeated rows give equal rows. An empty
table gives an empty result. Columns named like the new ones are replaced; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import read_table, slices, text_or_empty

# Fixed values of the task: sentinels and the shares of plain and SPM texts, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

FIELDS = [
    ("fim_n", "bigint"), ("fim_form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"),
    ("fim_text", "string"), ("fim_restored", "string"),
]


class WaveletMatrix:
    """Wavelet matrix of a sequence of small non-negative integers, with rank queries over arrays of positions."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        current = values.astype(np.uint8)
        for level in range(bits):
            bit = (current >> (bits - 1 - level)) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            # Stable: the values whose bit is 0 first, then those with 1.
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbol: int, positions: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each of ``positions``."""
        low = np.zeros_like(positions)
        high = positions.astype(np.int64)
        for level in range(self.bits):
            ones = self.ones[level]
            if (symbol >> (self.bits - 1 - level)) & 1:
                low, high = self.zeros[level] + ones[low], self.zeros[level] + ones[high]
            else:
                low, high = low - ones[low], high - ones[high]
        return high - low


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the offsets of each text (one more than texts)."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, offsets


def classes(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """0: letter after a letter of the same text, 1: letter that begins a run, 2: any other code point."""
    letter = ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122))
    before = np.concatenate([[False], letter[:-1]])
    before[offsets[:-1][offsets[:-1] < len(points)]] = False
    return np.where(letter, np.where(before, 0, 1), 2).astype(np.uint8)


class TokenIndex:
    """Token counts and token ends of many texts at once, by rank queries on one wavelet matrix."""

    def __init__(self, texts: list[str]):
        points, self.offsets = code_points(texts)
        self.matrix = WaveletMatrix(classes(points, self.offsets), 2)
        self.starts, self.ends = self.offsets[:-1], self.offsets[1:]

    def tokens_before(self, begin: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Tokens that begin in [begin, position): every code point but letters after letters."""
        return (position - begin) - (self.matrix.rank(0, position) - self.matrix.rank(0, begin))

    def counts(self) -> np.ndarray:
        return self.tokens_before(self.starts, self.ends)

    def cut_after(self, k: np.ndarray) -> np.ndarray:
        """Code points of each text up to the end of its k-th token (0 <= k <= its count)."""
        n = self.counts()
        inner = k < n
        # The (k+1)-th token begins at p - 1 for the least p with k + 1 tokens before p; bisect on ranks.
        low, high = self.starts.copy(), self.ends.copy()
        while True:
            open_ = inner & (high - low > 1)
            if not open_.any():
                break
            middle = (low + high) // 2
            enough = self.tokens_before(self.starts, middle) >= k + 1
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle, low)
        cut = np.where(inner, high - 1 - self.starts, self.ends - self.starts)
        return np.where(k == 0, 0, cut)


def cut_hashes(doc_id: Column) -> list[Column]:
    """h1 to h4: the first four groups of 8 hex digits of sha256 of ``1:`` and the id, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"__h{i + 1}") for i in range(4)]


def fim_form(text: str, h3: int, h4: int) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return "plain"
    return "spm" if h4 % 100 < SPM_BELOW else "psm"


def arrange(prefix: str, middle: str, suffix: str, form: str) -> str:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    if form == "spm":
        return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return prefix + middle + suffix


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made of, in ``form``; sentinels never stand in the text of a FIM form."""
    if form == "plain":
        return output
    body, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = body[len(PREFIX):].split(SUFFIX, 1)
    else:
        suffix, prefix = body[len(SUFFIX):].split(PREFIX, 1)
    return prefix + middle + suffix


def transform_batch(texts: list[str], hashes: list[np.ndarray]) -> list[pa.Array]:
    """The FIM columns of a batch of texts with their h1 to h4."""
    index = TokenIndex(texts)
    n = index.counts()
    h1, h2, h3, h4 = hashes
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = index.cut_after(np.minimum(a, b)), index.cut_after(np.maximum(a, b))
    forms, prefixes, middles, outputs, restored = [], [], [], [], []
    for i, text in enumerate(texts):
        form = fim_form(text, int(h3[i]), int(h4[i]))
        x, y = int(first[i]), int(second[i])
        output = text if form == "plain" else arrange(text[:x], text[x:y], text[y:], form)
        forms.append(form)
        prefixes.append(None if form == "plain" else x)
        middles.append(None if form == "plain" else y - x)
        outputs.append(output)
        restored.append(restore(output, form))
    return [
        pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
        pa.array(middles, pa.int64()), pa.array(outputs, pa.large_string()), pa.array(restored, pa.large_string()),
    ]


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``df`` and the FIM columns of ``FIELDS``."""
    new = {name.lower() for name, _ in FIELDS}
    kept = [c for c in df.columns if c.lower() not in new]
    passed = df.select(*[F.col(f"`{c}`") for c in kept], text_or_empty(text).alias("__fim_in"), *cut_hashes(F.col(f"`{doc_id}`")))
    added = [T.StructField(n, T._parse_datatype_string(t)) for n, t in FIELDS]
    schema = T.StructType([*passed.schema.fields[: len(kept)], *added])
    types = [to_arrow_type(f.dataType) for f in added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__fim_in"):
                hashes = [batch.column(f"__h{i}").to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5)]
                arrays = transform_batch(batch.column("__fim_in").to_pylist(), hashes)
                out = [*batch.columns[: len(kept)], *[a.cast(t) for a, t in zip(arrays, types)]]
                yield pa.RecordBatch.from_arrays(out, names=[*kept, *[n for n, _ in FIELDS]])
            del whole
            pa.default_memory_pool().release_unused()

    return passed.mapInArrow(work, schema)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in FIM form, with the digests of its output and of the text restored from it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = fill_in_middle(docs)
    return done.select(
        "doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"), "prefix_chars", "middle_chars",
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("fim_restored").cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
with t as (
    select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
    from documents
),
u as (
    select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as toks,
        ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
        ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
    from t
),
v as (select *, len(toks)::bigint as n from u),
w as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as k1, greatest(h1 % (n + 1), h2 % (n + 1)) as k2,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
            or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from v
),
x as (
    select *, array_to_string(list_slice(toks, 1, k1), '') as pre,
        array_to_string(list_slice(toks, k1 + 1, k2), '') as mid,
        array_to_string(list_slice(toks, k2 + 1, n), '') as suf
    from w
)
select doc_id, n, form,
    case when form = 'plain' then null else length(pre)::bigint end as prefix_chars,
    case when form = 'plain' then null else length(mid)::bigint end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
    sha256(text) as restored_sha256
from x
"""
