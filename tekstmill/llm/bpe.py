"""Byte pair encoding with forced boundaries, and decoding.

Byte pairs that occur inside no token of the vocabulary are certain cuts: no merge ever spans them. A text is cut
there, each fragment is encoded by itself, once per distinct fragment, and the ids are concatenated. The end of a
word counts as part of its last symbol, so that every word end is such a cut too; white space, which no token holds,
separates the pieces that a worker remembers.

Inputs: NULL and the empty text give no ids and decode to the empty text. Repeated rows and ties are encoded each by
itself. Long texts are encoded whole. Extra columns pass through; one with the name of an output is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import append_columns, map_texts, read_table

# The white space of Unicode.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Fragments with more parts than this are merged with a heap; words longer than LONGEST_REMEMBERED are not remembered.
LONG_FRAGMENT = 64
LONGEST_REMEMBERED = 256
PIECES = re.compile(f"[^{SPACE}]+")
# Pieces and words that a worker remembers before a new generation begins; bounds its memory. What is still met moves
# on from the generation before. Words cost more to encode than pieces to put together from words.
KNOWN_PIECES, KNOWN_WORDS = 60_000, 100_000
MARKS = tuple(",.;:!?")
# Text encoded at a time; its ids, their tokens and the decoded text take some ten times as much.
ENCODED_BYTES = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable in Latin-1, else the next free one."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class ForcedBoundaryBPE:
    """A tokenizer file of the BPE kind with word ends: NFC, lower case, one pattern of words, byte letters."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        # Merges by number: the rank of a pair of ids, and the id that each rank makes. Tokens are kept in one column;
        # every worker holds a tokenizer, so no table of strings stays that encoding and ``decode_column`` don't use.
        self.base = len(vocab) and max(vocab.values()) + 1
        self.rank_of = {vocab[a] * self.base + vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        self.inner = [vocab.get(x) for x in self.letters]
        self.final = [vocab.get(x + self.end) for x in self.letters]
        self.inside = self._inner_pairs(vocab)
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.token_column = pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.string())
        self.known_pieces: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    @cached_property
    def tokens(self) -> dict[int, str]:
        return {i: t for i, t in enumerate(self.token_column.to_pylist()) if t is not None}

    @cached_property
    def ranks(self) -> dict[tuple[str, str], int]:
        return {(self.tokens[p // self.base], self.tokens[p % self.base]): rank for p, rank in self.rank_of.items()}

    def _inner_pairs(self, vocab: dict[str, int]) -> set[tuple[int, int]]:
        """The byte pairs that occur inside a token."""
        byte_of = {letter: b for b, letter in enumerate(self.letters)}
        inside = set()
        for token in vocab:
            known = [byte_of[c] for c in (token.removesuffix(self.end) if self.end else token) if c in byte_of]
            inside.update(zip(known, known[1:]))
        return inside

    def cut(self, word: bytes) -> list[bytes]:
        """Fragments of one word between certain cuts."""
        if self.inside.issuperset(zip(word, word[1:])):
            return [word]
        edges = [0, *[i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.inside], len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:])]

    def merge(self, fragment: bytes, last: bool) -> list[int]:
        """Ids of one fragment; the last one of a word carries the word end. The lowest rank goes first, the
        leftmost among equals."""
        inner, base, get, none = self.inner, self.base, self.rank_of.get, len(self.made)
        ids = [inner[b] for b in fragment]
        if last:
            ids[-1] = self.final[fragment[-1]]
        if len(ids) > LONG_FRAGMENT:
            return self._merge_long(ids)
        ranks = [get(a * base + b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            ids[i] = new = self.made[low]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new * base + ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] * base + new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for long fragments in O(n log n): pairs wait in a heap by (rank, left place), neighbours are
        linked, and a popped pair counts only if it still stands there with that rank."""
        base, get, none = self.base, self.rank_of.get, len(self.made)
        right = list(range(1, len(ids) + 1))
        left = list(range(-1, len(ids) - 1))
        alive = [True] * len(ids)
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a * base + b, none)) < none]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= len(ids) or get(ids[i] * base + ids[j], none) != rank:
                continue
            ids[i] = self.made[rank]
            alive[j] = False
            right[i] = right[j]
            if right[i] < len(ids):
                left[right[i]] = i
                if (r := get(ids[i] * base + ids[right[i]], none)) < none:
                    heapq.heappush(heap, (r, i))
            if left[i] >= 0 and (r := get(ids[left[i]] * base + ids[i], none)) < none:
                heapq.heappush(heap, (r, left[i]))
        return [x for x, a in zip(ids, alive) if a]

    def _word(self, word: str) -> bytes:
        fragments = self.cut(word.encode())
        last = len(fragments) - 1
        return array("i", [x for i, f in enumerate(fragments) for x in self.merge(f, i == last)]).tobytes()

    def _known_word(self, word: str) -> bytes:
        if len(word) > LONGEST_REMEMBERED:
            return self._word(word)
        found = self.known_words.get(word)
        if found is None:
            found = self.old_words.get(word)
            self.known_words[word] = found = self._word(word) if found is None else found
        return found

    def _plain(self, text: str) -> bytes:
        # Letter by letter, without the rule for a final sigma.
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # Letters alone, or with one mark after them, need no search for words.
        if text.isalpha():
            return self._known_word(text)
        if text[-1:] in MARKS and text[:-1].isalpha():
            return self._known_word(text[:-1]) + self._known_word(text[-1])
        return b"".join([self._known_word(w) for w in self.words.findall(text)])

    def _piece(self, piece: str) -> bytes:
        if not self.special_pattern or not self.special_pattern.search(piece):
            return self._plain(piece)
        parts = self.special_pattern.split(piece)
        return b"".join(array("i", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in parts)

    def encode(self, text: str) -> np.ndarray:
        known = self.known_pieces
        found = PIECES.findall(text)
        for piece in set(found).difference(known):
            old = self.old_pieces.get(piece)
            known[piece] = self._piece(piece) if old is None else old
        ids = np.frombuffer(b"".join(map(known.__getitem__, found)), np.int32)
        if len(self.known_pieces) > KNOWN_PIECES:
            self.old_pieces, self.known_pieces = self.known_pieces, {}
        if len(self.known_words) > KNOWN_WORDS:
            self.old_words, self.known_words = self.known_words, {}
        return ids

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens joined by a space."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def decode_column(self, ids: pa.ListArray) -> pa.Array:
        """``decode`` of every list of ids, with no Python object per id."""
        tokens = pa.ListArray.from_arrays(ids.offsets, self.token_column.take(ids.values))
        return pc.binary_join(tokens, " ")


@lru_cache(2)
def load(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def _ids_array(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))


def encode_documents(
    df: DataFrame, path: str, text: str = "text", keys: list[str] | None = None, decoded: str | None = None
) -> DataFrame:
    """``df``, or its ``keys`` only, with ``token_ids`` (array<int>, empty for NULL) and, in a column named
    ``decoded``, on demand the text that they decode to."""

    def make():
        bpe = load(path)

        def encode(texts: list[str]) -> list[pa.Array]:
            ids = [bpe.encode(t) for t in texts]
            out = [_ids_array(ids)]
            if decoded is not None:
                out.append(bpe.decode_column(out[0]))
            return out

        return encode

    fields = [("token_ids", "array<int>"), *([(decoded, "string")] if decoded is not None else [])]
    if keys is None:
        return append_columns(df, text, make, fields, ENCODED_BYTES)
    return map_texts(df, keys, text, make, fields, ENCODED_BYTES)


def decode_documents(df: DataFrame, path: str, ids: str = "token_ids", output: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (empty for NULL or none), for ids that are stored."""
    others = [c for c in df.columns if c.lower() != output.lower()]
    schema = df.select(*others).schema.add(output, "string")

    def work(batches):
        bpe = load(path)
        for batch in batches:
            # Some thousand rows at a time, so that the ids as Python numbers stay few.
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [bpe.decode(x.as_py()) if x.is_valid else "" for x in part.column(ids)]
                columns = [part.column(c) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*others, output])

    return df.mapInArrow(work, schema)


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    coded = encode_documents(read_table(spark, sf_dir, "documents"), path, keys=["doc_id"], decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
