"""MinHash signatures: ``plan.size`` permutations (Broder 1997) with 62-bit values, or one permutation dealt into
``plan.size`` bins (Li, Owen and Zhang 2012) with empty bins filled by rotation (Shrivastava and Li 2014)."""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from .batches import list_lengths, parts
from .text import bind, run_fields, runs, words

try:
    # The same digest without the set-up that each call costs in OpenSSL.
    from _md5 import md5
except ImportError:
    from hashlib import md5

# Mersenne prime of the permutations, and the width of one lane.
PRIME = (1 << 31) - 1
LANE_BITS = 31
# Bits of a lane of a shingle's hash.
LANE = 28


@dataclass(frozen=True)
class MinHashPlan:
    """Shape of a signature: ``buckets`` bands of ``rows`` values over word n-grams.

    ``shingle_hash`` is ``xxhash64``, or ``md5`` where another engine must be able to
    compute the same signature; both give two lanes of 28 bits per shingle.

    ``scheme`` ``permutations`` takes the least of ``size`` permuted values of all shingles; ``one_permutation``
    hashes each shingle once, to bin v % size with value v // size, keeps the least value of each bin and gives an
    empty bin the value of the nearest bin to its right (cyclically) that isn't empty, plus ``rotation_step`` times
    the distance. Both estimate Jaccard similarity by the share of equal values; the second costs one hash a shingle
    instead of ``size``.
    """

    buckets: int = 14
    rows: int = 8
    ngram: int = 5
    shingle_hash: str = "xxhash64"
    seed: int = 1
    scheme: str = "permutations"

    def __post_init__(self) -> None:
        if self.scheme not in ("permutations", "one_permutation"):
            raise ValueError("scheme must be 'permutations' or 'one_permutation'.")
        if min(self.buckets, self.rows, self.ngram) < 1:
            raise ValueError("buckets, rows and ngram must be positive.")
        if self.shingle_hash not in ("xxhash64", "md5"):
            raise ValueError("shingle_hash must be 'xxhash64' or 'md5'.")

    @property
    def size(self) -> int:
        return self.buckets * self.rows

    def coefficients(self) -> list[tuple[int, int, int, int]]:
        """Factor and offset of both lanes, per signature value."""
        draw = random.Random(self.seed)
        return [
            (draw.randrange(1, PRIME), draw.randrange(PRIME), draw.randrange(1, PRIME), draw.randrange(PRIME))
            for _ in range(self.size)
        ]


def md5_lanes(joined: bytes, ngram: int) -> np.ndarray:
    """Both lanes of every shingle of one or more words joined by blanks; a shingle is a slice of them."""
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == ord(" "))
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(joined)][ngram - 1 :]
    digests = b"".join([md5(joined[a:b]).digest() for a, b in zip(starts, ends)])
    # Of the first eight bytes, four bits after each lane are not used.
    first = np.frombuffer(digests, ">u8")[::2].astype(np.uint64)
    lanes = first >> np.uint64(36) << np.uint64(LANE) | first >> np.uint64(4) & np.uint64((1 << LANE) - 1)
    return lanes.view(np.int64)


def shingle_lanes(text: Column, plan: MinHashPlan) -> Column:
    """Both 28-bit lanes of every shingle, packed into one bigint per shingle.

    MD5 goes over slices of the joined words, an Arrow batch at a time: as an expression it would build a string per
    shingle, another for its digest and two to read numbers from that.
    """
    if plan.shingle_hash == "md5":

        @F.arrow_udf("array<bigint>")
        def lanes_of(batch: pa.Array) -> pa.Array:
            texts = batch.cast(pa.binary())
            blanks = pc.fill_null(pc.count_substring(texts, " "), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            filled = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) > 0
            ends = np.concatenate(([0], np.cumsum(np.where(filled, np.maximum(blanks + 2 - plan.ngram, 0), 0))))
            values = np.empty(ends[-1], np.int64)
            for low, high, joined in zip(ends[:-1].tolist(), ends[1:].tolist(), texts):
                if low < high:
                    values[low:high] = md5_lanes(joined.as_py(), plan.ngram)
            missing = np.concatenate((pc.is_null(texts).to_numpy(zero_copy_only=False), [False]))
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), mask=missing), pa.array(values))

        return lanes_of(F.array_join(words(F.lower(text)), " "))

    def lanes(run: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*run_fields(run, plan.ngram)), 8)

    return bind(words(F.lower(text)), lambda w: F.transform(runs(w, plan.ngram), lanes))


# Shingles (a power of two) and permutations worked on at a time: keeps the work arrays in the processor cache.
BLOCK = 1 << 13
ROWS = 8
# Texts whose shingles are sorted together: their number shares 64 bits with the 56 of a shingle.
TEXTS = 256
# Shingles of a part of a batch: bounds the work arrays whatever a batch holds.
PART_ITEMS = 1 << 18
# Shingle hashes have 56 bits; a bin's value is below ROTATION // size.
ROTATION = 1 << 56


def rotation_step(size: int) -> int:
    """Offset per bin of distance in rotation: above any value that a bin holds."""
    return ROTATION // size + 1


def one_permutation(packed: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``size`` densified bin minima, one per text with shingles (``lengths`` > 0), in order."""
    counts = lengths[lengths > 0]
    row = np.repeat(np.arange(len(counts)), counts)
    out = np.full((len(counts), size), np.iinfo(np.int64).max, np.int64)
    np.minimum.at(out, (row, packed % size), packed // size)
    if len(counts) == 0:
        return out
    # Nearest bin at or right of each, cyclically: over the bins written twice, the least filled index from the right.
    filled = np.concatenate([out, out], axis=1) != np.iinfo(np.int64).max
    index = np.where(filled, np.arange(2 * size), 2 * size)
    nearest = np.minimum.accumulate(index[:, ::-1], axis=1)[:, ::-1][:, :size]
    distance = nearest - np.arange(size)
    taken = np.take_along_axis(out, nearest % size, axis=1)
    return taken + distance * rotation_step(size)


def _folded(lane: np.ndarray, factor: np.ndarray, offset: np.ndarray, out: np.ndarray, work: np.ndarray) -> np.ndarray:
    """(lane * factor + offset) % PRIME without a division, one row per factor: the bits above the lowest 31 are added
    to these, and what is not below the prime then loses it once."""
    prime = np.uint64(PRIME)
    np.multiply(lane, factor[:, None], out=out)
    np.add(out, offset[:, None], out=out)
    np.right_shift(out, np.uint64(LANE_BITS), out=work)
    np.bitwise_and(out, prime, out=out)
    np.add(out, work, out=out)
    # Below the prime, the difference wraps round and is the larger one.
    np.subtract(out, prime, out=work)
    return np.minimum(out, work, out=out)


def _block_minima(one: np.ndarray, two: np.ndarray, cuts: np.ndarray, drawn: np.ndarray, apart: bool) -> np.ndarray:
    """Least values of the shingles from each cut to the next, one row per cut.

    The first lane orders the values, and a permutation gives different lanes different values. Where no text has a
    first lane twice (``apart``), its place is carried along and the second lane is permuted at that place alone.
    """
    bits, size = np.uint64(BLOCK.bit_length() - 1), drawn.shape[1]
    place = np.arange(len(one), dtype=np.uint64)
    out = np.empty((size, len(cuts)), np.uint64)
    values, works = np.empty((2, ROWS, len(one)), np.uint64)
    for low in range(0, size, ROWS):
        a, b, c, d = drawn[:, low : low + ROWS]
        value, work = values[: len(a)], works[: len(a)]
        _folded(one, a, b, value, work)
        if apart:
            np.left_shift(value, bits, out=value)
            np.bitwise_or(value, place, out=value)
        else:
            high = value << np.uint64(LANE_BITS)
            np.add(_folded(two, c, d, value, work), high, out=value)
        np.minimum.reduceat(value, cuts, axis=1, out=out[low : low + ROWS])
    if apart:
        second = (two[out & np.uint64(BLOCK - 1)] * drawn[2][:, None] + drawn[3][:, None]) % np.uint64(PRIME)
        out = out >> bits << np.uint64(LANE_BITS) | second
    return out.T.view(np.int64)


def permuted_minima(packed: np.ndarray, lengths: np.ndarray, plan: MinHashPlan) -> np.ndarray:
    """Rows of ``plan.size`` least permuted values, one per text with shingles (``lengths`` > 0), in order."""
    counts = lengths[lengths > 0]
    ends = np.cumsum(counts)
    out = np.full((len(counts), plan.size), np.iinfo(np.int64).max, np.int64)
    mask = np.uint64((1 << LANE) - 1)
    drawn = np.array(plan.coefficients(), np.uint64).T
    for low in range(0, len(counts), TEXTS):
        high = min(low + TEXTS, len(counts))
        text = np.repeat(np.arange(high - low, dtype=np.uint64), counts[low:high])
        shingles = text << np.uint64(2 * LANE) | packed[ends[low] - counts[low] : ends[high - 1]].view(np.uint64)
        # Each distinct shingle of a text once, in order.
        shingles.sort()
        shingles = shingles[np.concatenate(([True], shingles[1:] != shingles[:-1]))]
        for start in range(0, len(shingles), BLOCK):
            block = shingles[start : start + BLOCK]
            text = block >> np.uint64(2 * LANE)
            cuts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            lane = block >> np.uint64(LANE)
            apart = not (lane[1:] == lane[:-1]).any()
            here = _block_minima(lane & mask, block & mask, cuts, drawn, apart)
            rows = low + text[cuts].astype(np.int64)
            out[rows] = np.minimum(out[rows], here)
    return out


def signature_rows(batch: pa.ListArray, plan: MinHashPlan) -> pa.ListArray:
    """Signatures of the texts of one part of a batch, NULL for those without shingles."""
    lengths = list_lengths(batch)
    packed = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    single = plan.scheme == "one_permutation"
    out = one_permutation(packed, lengths, plan.size) if single else permuted_minima(packed, lengths, plan)
    signed = lengths > 0
    offsets = np.concatenate(([0], np.cumsum(signed * plan.size))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.concatenate((~signed, [False]))), pa.array(out.ravel()))


def signature(text: Column, plan: MinHashPlan) -> Column:
    """Array of ``plan.size`` minima, NULL for a text of fewer words than a shingle has.

    The minima of a text need all its shingles and nothing else, so they are taken where
    the row lies. One Arrow batch at a time, in parts of bounded size, each permutation runs over the shingles of
    many texts; as an aggregation the same would shuffle and take one wide
    buffer per text.
    """

    @F.arrow_udf("array<bigint>")
    def minima(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([signature_rows(part, plan) for part in parts(batch, PART_ITEMS)])

    return minima(shingle_lanes(text, plan))


def band_keys(signature_col: Column, plan: MinHashPlan) -> Column:
    """One 128-bit key per bucket; the bucket number is part of what is hashed."""
    return bind(
        signature_col,
        lambda s: F.transform(
            F.sequence(F.lit(0), F.lit(plan.buckets - 1)),
            lambda b: F.unhex(
                F.md5(F.concat_ws(",", b.cast("string"), F.slice(s, b * plan.rows + 1, plan.rows).cast("array<string>")))
            ),
        ),
    )
