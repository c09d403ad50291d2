"""Token ids in Arrow files of equal-length sequences, and reading them back.

Documents in ascending order of their ids are encoded and run together, an end id after each. A file holds the run of
one range partition, cut into sequences of one length: record batches of a fixed-size list of ids and one of mask
bits (false where the last sequence is filled up), uncompressed, so that a reader maps the file into memory and takes
any sequence without a copy. An index tells where in which file each document lies. Files are in the shared folder
under names that no other attempt of a task uses; only those in the index, which Spark commits as a whole, are read.

Inputs: NULL and empty texts are an end id alone. The NULL id comes first. Equal ids are ordered by a hash of the text.
Texts of any length are encoded whole. An empty table gives no files and an empty result. Extra columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import SPACE, byte_letters
from .common import cut_lineage, open_store, read_table, scratch_path, text_or_empty, token

SEQUENCE = 2048
# Sequences in a record batch.
BATCH_SEQUENCES = 512
END_ID = 0
# White space and what follows it up to the next white space. The byte-level pattern of words never joins a letter,
# digit or sign to white space after it, so these pieces are encoded independently of each other. A blank that is a
# run of white space by itself (no white space on either side) may be cut before, as the pattern takes it to the word
# after it; a blank beside other white space lies inside a longer run, which the pattern takes whole.
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
CROWDED = re.compile(f"[{SPACE}] | [{SPACE}]")
# Pieces that a worker remembers before a new generation begins; bounds its memory.
REMEMBERED = 900_000
MARKS = tuple(".,;:!?")
# The letter that stands for the blank in byte-level tokens.
BLANK = byte_letters()[32]


def _crowded(text: str) -> bool:
    """Whether a blank stands beside white space. All white space but the blank is not printable, so a text whose only
    such character is the line feed needs no search by pattern."""
    if "  " in text or "\n " in text or " \n" in text:
        return True
    return not text.replace("\n", "").isprintable() and CROWDED.search(text) is not None


def _pieces(text: str) -> tuple[list[str], list[str]]:
    if _crowded(text):
        return PIECES.findall(text), []
    first, *others = text.split(" ")
    return [first] if first else [], others


class Encoder:
    """The tokenizers library on pieces of texts, each distinct one once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # Ids of tokens that begin with a blank.
        tokens = sorted((i, t) for t, i in self.tokenizer.get_vocab().items())
        self.opens = np.zeros(tokens[-1][0] + 1, bool)
        self.opens[[i for i, t in tokens if t.startswith(BLANK)]] = True
        # By piece, and by piece without the blank before it.
        self.plain: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32

    def _learn(self, pieces: list[str], known: dict[str, bytes], before: str) -> None:
        """Encode pieces in one call: run together where each begins with a blank, which then begins a token of each,
        otherwise with a special token between them. Those that hold special tokens or begin with white space go alone."""
        rest = pieces
        if not before or any(s in "".join(pieces) for s in self.special) or any(not p[:1].strip() for p in pieces):
            alone = [p for p in pieces if any(s in p for s in self.special) or not p[:1].strip()] if before or self.special else pieces
            for piece in alone:
                ids = self.tokenizer.encode(before + piece, add_special_tokens=False).ids
                known[piece] = np.array(ids, self.width).tobytes()
            rest = [p for p in pieces if p not in known]
        if not rest:
            return
        mark, mark_id = next(iter(self.special.items()), ("", -1))
        joined = before + before.join(rest) if before else mark.join(rest)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.width)
        raw, size = ids.tobytes(), ids.itemsize
        if before:
            starts = (size * np.flatnonzero(self.opens[ids])).tolist()
            ends = [*starts[1:], len(raw)]
        else:
            marks = np.flatnonzero(ids == mark_id)
            starts, ends = [0, *(size * (marks + 1)).tolist()], [*(size * marks).tolist(), len(raw)]
        known.update((p, raw[a:b]) for p, a, b in zip(rest, starts, ends, strict=True))

    def _missing(self, pieces: set[str], known: dict[str, bytes], old: dict[str, bytes], before: str) -> None:
        """Bring ``known`` up to date. A mark after letters is always a token of its own, so such pieces are put
        together from the word and the mark."""
        new = [p for p in pieces if p not in old]
        known.update((p, old[p]) for p in pieces.difference(new))
        marked = {p for p in new if p[-1:] in MARKS and p[:-1].isalpha() and max(p) < "\u0250"}
        words = {p[:-1] for p in marked}
        known.update((w, old[w]) for w in words if w in old)
        need = [*{w for w in words if w not in known}.union(p for p in new if p not in marked)]
        for low in range(0, len(need), 100):
            self._learn(need[low : low + 100], known, before)
        if marked:
            self._learn([m for m in MARKS if m not in self.plain], self.plain, "")
            known.update((p, known[p[:-1]] + self.plain[p[-1]]) for p in marked)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.spaced) > REMEMBERED or len(self.plain) > REMEMBERED:
            self.old, self.plain, self.spaced = (self.plain, self.spaced), {}, {}
        # Either all pieces, or the first and those after a blank.
        cut = [_pieces(t) for t in texts]
        plain, spaced = self.plain, self.spaced
        self._missing(set().union(*[a for a, _ in cut]).difference(plain), plain, self.old[0], "")
        self._missing(set().union(*[b for _, b in cut]).difference(spaced), spaced, self.old[1], " ")
        runs = (b"".join([*map(plain.__getitem__, a), *map(spaced.__getitem__, b)]) for a, b in cut)
        return [np.frombuffer(run, self.width) for run in runs]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class SequenceFile:
    """Writes a run of ids as equal-length sequences."""

    def __init__(self, uri: str, length: int, width: type) -> None:
        self.length, self.width = length, width
        ids = pa.list_(pa.from_numpy_dtype(width), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        system, path = open_store(uri)
        self.stream = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.stream, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.written = 0

    def add(self, ids: np.ndarray) -> int:
        """Append ids; returns where they start in the file."""
        at = self.written + self.n_waiting
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        full = BATCH_SEQUENCES * self.length
        if self.n_waiting >= full:
            run = np.concatenate(self.waiting)
            whole = len(run) // full * full
            for low in range(0, whole, full):
                self._batch(run[low : low + full])
            self.waiting, self.n_waiting = [run[whole:]], len(run) - whole
        return at

    def _batch(self, run: np.ndarray) -> None:
        rows = -(-len(run) // self.length)
        values = np.zeros(rows * self.length, self.width)
        values[: len(run)] = run
        mask = np.zeros(rows * self.length, bool)
        mask[: len(run)] = True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
        self.written += len(run)

    def close(self) -> None:
        if self.n_waiting:
            self._batch(np.concatenate(self.waiting))
        self.writer.close()
        self.stream.close()


class SequenceReader:
    """Sequences of one file, taken from mapped memory where the file system allows it."""

    def __init__(self, uri: str) -> None:
        system, path = open_store(uri)
        local = system.type_name == "local"
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self._last: tuple[int, np.ndarray] | None = None

    def batch(self, k: int) -> np.ndarray:
        """All ids of one record batch, as a view of the file."""
        if self._last is None or self._last[0] != k:
            batch = self.reader.get_batch(k)
            ids = batch.column(0)
            flat = ids.values.slice(ids.offset * self.length, len(ids) * self.length)
            self._last = k, flat.to_numpy(zero_copy_only=True)
        return self._last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        k, row = divmod(i, BATCH_SEQUENCES)
        mask = self.reader.get_batch(k).column(1)[row].values.to_numpy(zero_copy_only=False)
        return self.batch(k)[row * self.length : (row + 1) * self.length], mask

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in views of one record batch each."""
        size = BATCH_SEQUENCES * self.length
        while n > 0:
            k, at = divmod(start, size)
            view = self.batch(k)[at : min(at + n, size)]
            yield view
            start, n = start + len(view), n - len(view)

    def close(self) -> None:
        self._last = self.reader = None
        self.source.close()


INDEX = "file string, part int, doc_id {id}, local_start bigint, n_tokens bigint"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Files in ``folder``, and their index: (file, part, doc_id, local_start, n_tokens, base).

    ``base`` is the number of ids in all files before; parts are in ascending order of the ids.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def write(batches):
        part, name, file = TaskContext.get().partitionId(), None, None
        coder = encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                some = batch.slice(low, 500)
                if some.num_rows == 0:
                    continue
                if file is None:
                    name = f"part-{part:06d}-{token()}.arrow"
                    file = SequenceFile(f"{folder}/{name}", length, coder.width)
                starts, sizes = [], []
                for ids in coder.encode(some.column("text").to_pylist()):
                    ids = np.append(ids, coder.width(end_id))
                    starts.append(file.add(ids))
                    sizes.append(len(ids))
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array([part] * n, pa.int32()), some.column("doc_id"),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                    names=["file", "part", "doc_id", "local_start", "n_tokens"],
                )
        if file is not None:
            file.close()

    make_folder(folder)
    index = cut_lineage(ordered.mapInArrow(write, INDEX.format(id=kind)), "token-index")
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    # One row per file.
    return index.join(F.broadcast(bases), "part")


def make_folder(folder: str) -> None:
    system, path = open_store(folder)
    system.create_dir(path, recursive=True)


def read_tokens(
    index: DataFrame, folder: str, fields: list[tuple[str, str]], of: Callable[[Iterator[np.ndarray]], tuple]
) -> DataFrame:
    """(doc_id, start, n_tokens) and what ``of`` makes of the ids of each document, read from the files."""
    kind = index.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, " + ", ".join(f"{n} {t}" for n, t in fields)
    # Rows of one file come together, in the order in which they lie there.
    placed = index.repartition("part").sortWithinPartitions("part", "local_start")

    def read(batches):
        reader, opened = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("file", "local_start", "n_tokens")]
            for name, start, n in zip(*columns):
                if name != opened:
                    if reader is not None:
                        reader.close()
                    reader, opened = SequenceReader(f"{folder}/{name}"), name
                found.append(of(reader.ids(start, n)))
            starts = pa.compute.add(batch.column("base"), batch.column("local_start"))
            values = [pa.array([f[i] for f in found]) for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), starts, batch.column("n_tokens"), *values],
                names=["doc_id", "start", "n_tokens", *[n for n, _ in fields]],
            )
        if reader is not None:
            reader.close()

    return placed.mapInArrow(read, schema)


def _crc(views: Iterator[np.ndarray]) -> tuple[int]:
    total = 0
    for view in views:
        total = zlib.crc32(view.astype("<u4").tobytes(), total)
    return (total,)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies in the run of all ids, and the checksum of its ids as the files have them."""
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    index = write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(index, folder, [("ids_crc32", "bigint")], _crc)
