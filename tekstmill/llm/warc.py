"""WARC archives, locally sorted index runs, and their external merge.

Every page becomes a record of a gzip-per-record WARC file: a response with its payload, or, where a page with a
smaller id has the same payload, a revisit without it. A task writes archives of bounded size and, for each, a run:
the index entries of its captures sorted by URL key (host reversed), time and id, in blocks. Runs are cut at the limits
of key ranges (from a bounded sample of block keys, which only balances the ranges), and each range is merged from all
runs by a loser tree; ranges follow each other, so the whole is one ordered capture history per URL key. Captures are
read back through the merged index.

Archives lie in the shared folder under names that no other attempt of a task uses; only those that the committed
index names are read.

Inputs: NULL and empty payloads are records with 0 bytes. A NULL URL is written as no target, with an empty key. A
NULL time counts as the epoch. Pages with a NULL id are responses unless an equal payload has an id; rows that repeat
the smallest id and its payload are responses all. Ties of key and time are ordered by id. Payloads are written whole.
An empty table gives no archive and an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut_lineage, open_store, read_table, scratch_path, slices, text_or_empty, token
from .token_files import make_folder

ARCHIVE_BYTES = 64 << 20
CENTURY_SECONDS = 3_155_760_000
ARCHIVE_RECORDS = 50_000
BLOCK_ENTRIES = 256
# Entries that one merging task holds, about, and block keys that the driver sees, at most.
RANGE_ENTRIES = 50_000
SAMPLE_BLOCKS = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def warc_date(seconds: int) -> str:
    """UTC date of Unix seconds as WARC writes it, for any 64-bit number of seconds (years beyond 9999 get more
    digits), by the days-to-civil rule of the proleptic Gregorian calendar."""
    days, rest = divmod(seconds, 86400)
    z = days + 719468
    era = z // 146097
    doe = z - era * 146097
    yoe = (doe - doe // 1460 + doe // 36524 - doe // 146096) // 365
    doy = doe - (365 * yoe + yoe // 4 - yoe // 100)
    mp = (5 * doy + 2) // 153
    day = doy - (153 * mp + 2) // 5 + 1
    month = mp + 3 if mp < 10 else mp - 9
    year = yoe + era * 400 + (month <= 2)
    hours, rest = divmod(rest, 3600)
    minutes, secs = divmod(rest, 60)
    return f"{year:04d}-{month:02d}-{day:02d}T{hours:02d}:{minutes:02d}:{secs:02d}Z"


def url_key(url: str) -> str:
    """Host parts in reverse, then the path: what belongs together sorts together."""
    match = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", url.lower())
    if not match:
        return url.lower()
    host, port, rest = match.groups()
    return f"{','.join(reversed(host.split('.')))}{port or ''}){rest or '/'}"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, url: str, date: str, page_id: str, digest: str, size: int, payload: bytes, refers_to: str) -> bytes:
    """One record. The HTTP head of a revisit still tells the length of the payload that it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = lambda i: uuid.uuid5(NAMESPACE, f"page:{i}:{digest}")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {page_id}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(payload)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{name(refers_to)}>", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def info_record(file: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, file)}>\r\n"
        f"WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Filename: {file}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record fields, HTTP fields and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


class Archive:
    """One WARC file and the index entries of its records."""

    def __init__(self, folder: str, name: str) -> None:
        self.name = name
        system, path = open_store(f"{folder}/{name}")
        self.stream = system.open_output_stream(path, compression=None)
        self.at = 0
        self.entries: list[tuple] = []
        self._put(info_record(name))

    def _put(self, data: bytes) -> int:
        packed = gzip_member(data)
        self.stream.write(packed)
        self.at += len(packed)
        return len(packed)

    def add(self, key: str, seconds: int, page_id: str, record: bytes) -> None:
        start = self.at
        length = self._put(record)
        self.entries.append((key, seconds, page_id, start, length))

    def full(self) -> bool:
        return self.at >= ARCHIVE_BYTES or len(self.entries) >= ARCHIVE_RECORDS

    def close(self) -> list[tuple]:
        """The run: its entries in order."""
        self.stream.close()
        return sorted(self.entries)


ENTRY = "struct<key:string,seconds:bigint,page:string,start:bigint,length:bigint>"
ENTRY_TYPE = pa.struct([("key", pa.string()), ("seconds", pa.int64()), ("page", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
RUN_SCHEMA = f"archive string, key string, seconds bigint, page string, entries array<{ENTRY}>"


def _block_table(rows: list[tuple], more: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    """Rows of (archive, sorted entries) with the key of the first entry."""
    entries = [[dict(zip(("key", "seconds", "page", "start", "length"), e)) for e in r[1]] for r in rows]
    columns = {
        "archive": pa.array([r[0] for r in rows], pa.string()), "key": pa.array([r[1][0][0] for r in rows], pa.string()),
        "seconds": pa.array([r[1][0][1] for r in rows], pa.int64()), "page": pa.array([r[1][0][2] for r in rows], pa.string()),
        "entries": pa.array(entries, pa.list_(ENTRY_TYPE)),
    }
    return pa.RecordBatch.from_pydict(columns | (more or {}))


def with_roles(pages: DataFrame, page_id: str, url: str, payload: str, time: Column, least_bytes: int) -> DataFrame:
    """(page_id, url, seconds, digest, size, payload, refers_to); revisits have no payload but the id of their response."""
    text = text_or_empty(payload)
    keyed = pages.select(
        F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.unix_timestamp(time), F.lit(0)).alias("seconds"), F.sha1(text.cast("binary")).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"), text.alias("payload"),
    )
    same = keyed.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Written, so that Spark knows its size: payloads are only shuffled where it is too large to be broadcast.
    same = cut_lineage(same.filter("n > 1 and first is not null").select(F.col("digest").alias("d"), "first"), "same-payloads")
    joined = keyed.join(same, F.col("digest") == F.col("d"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "seconds", "digest", "size", F.when(~again, F.col("payload")).otherwise("").alias("payload"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    time: Column | None = None, least_bytes: int = 0,
) -> DataFrame:
    """WARC files in ``folder``; returns their runs in blocks: (archive, key, seconds, page, entries)."""
    time = F.lit(0).cast("timestamp") if time is None else time
    rows = with_roles(pages, page_id, url, payload, time, least_bytes)
    rows = rows.withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})

    def write(batches):
        part, archive = TaskContext.get().partitionId(), None

        def run():
            entries = archive.close()
            blocks = [(archive.name, entries[i : i + BLOCK_ENTRIES]) for i in range(0, len(entries), BLOCK_ENTRIES)]
            return _block_table(blocks)

        for whole in batches:
            for batch in slices(whole, "payload"):
                for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "seconds", "digest", "size", "payload", "refers_to")]):
                    page, link, seconds, digest, size, body, first = row
                    if archive is None:
                        archive = Archive(folder, f"part-{part:06d}-{token()}.warc.gz")
                    digest = base64.b32encode(bytes.fromhex(digest)).decode()
                    date = warc_date(seconds)
                    kind = "response" if first is None else "revisit"
                    page = "" if page is None else page
                    record = record_bytes(kind, link, date, page, digest, size, body.encode(), first or "")
                    archive.add(url_key(link), seconds, page, record)
                    if archive.full():
                        yield run()
                        archive = None
        if archive is not None:
            yield run()

    make_folder(folder)
    return cut_lineage(rows.mapInArrow(write, RUN_SCHEMA), "index-runs")


class LoserTree:
    """Merges sorted iterators: inner nodes hold the losers of their matches, so a next item costs one match per level."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        n = len(runs)
        self.losers = [0] * n
        winners = [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if n > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        """Runs that have ended come last, equal items in the order of the runs."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return x < y or (x == y and a < b)

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        while self.runs and (item := self.heads[self.winner]) is not None:
            yield self.winner, item
            leader = self.winner
            self.heads[leader] = next(self.runs[leader], None)
            node = (leader + len(self.runs)) // 2
            while node:
                if self._before(self.losers[node], leader):
                    leader, self.losers[node] = self.losers[node], leader
                node //= 2
            self.winner = leader


def merge_runs(runs: DataFrame, range_entries: int = RANGE_ENTRIES, sample_blocks: int = SAMPLE_BLOCKS) -> DataFrame:
    """(position, key, seconds, page, archive, start, length): all captures in the order of key, time and id."""
    n_entries = runs.agg(F.sum(F.size("entries"))).first()[0] or 0
    ranges = max(1, min(sample_blocks, -(-n_entries // range_entries)))
    sample = runs.select("key", "seconds", "page").orderBy(F.xxhash64("archive", "key", "seconds", "page")).limit(sample_blocks)
    keys = sorted(map(tuple, sample.collect())) if ranges > 1 else []
    limits = sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []

    def cut(batches):
        for batch in batches:
            rows, numbers = [], []
            for archive, entries in zip(batch.column("archive").to_pylist(), batch.column("entries").to_pylist()):
                entries = [tuple(e.values()) for e in entries]
                low = 0
                while low < len(entries):
                    number = bisect.bisect_right(limits, entries[low][:3])
                    high = len(entries) if number == len(limits) else bisect.bisect_left(entries, limits[number], low, key=itemgetter(0, 1, 2))
                    rows.append((archive, entries[low:high]))
                    numbers.append(number)
                    low = high
            if rows:
                yield _block_table(rows, {"range": pa.array(numbers, pa.int32())})

    pieces = runs.mapInArrow(cut, f"{RUN_SCHEMA}, range int").repartition("range")
    pieces = pieces.sortWithinPartitions("range", "archive", "key", "seconds", "page")
    schema = "range int, place bigint, key string, seconds bigint, page string, archive string, start bigint, length bigint"

    def merge(batches):
        number, held = None, {}

        def flush():
            names = sorted(held)
            out = [(*item, names[run]) for run, item in LoserTree([iter(held[n]) for n in names])]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            key, seconds, page, start, length, archive = (pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))
            return pa.RecordBatch.from_arrays(
                [pa.array([number] * len(out), pa.int32()), pa.array(range(len(out)), pa.int64()), key, seconds, page, archive, start, length],
                names=["range", "place", "key", "seconds", "page", "archive", "start", "length"],
            )

        for batch in batches:
            for where, archive, entries in zip(*[batch.column(c).to_pylist() for c in ("range", "archive", "entries")]):
                if where != number:
                    if held:
                        yield flush()
                    number, held = where, {}
                held.setdefault(archive, []).extend(tuple(e.values()) for e in entries)
        if held:
            yield flush()

    merged = cut_lineage(pieces.mapInArrow(merge, schema), "merged-index")
    counts = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    bases = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    joined = merged.join(F.broadcast(bases), "range")
    return joined.select((F.col("base") + F.col("place")).alias("position"), "key", "seconds", "page", "archive", "start", "length")


def read_captures(index: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, position, url_key) of every capture in an index.

    A response's length and digest are those of the payload read, a revisit's those it carries. A response whose digest
    is not the one it carries fails the task.
    """
    placed = index.select("archive", "start", "length", "position", "key").repartition("archive").sortWithinPartitions("archive", "start")
    schema = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, position bigint, url_key string"
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position", "url_key"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def read(batches):
        file, opened = None, None
        for batch in batches:
            out = []
            for archive, start, length, position, key in zip(*[c.to_pylist() for c in batch.columns]):
                if archive != opened:
                    if file is not None:
                        file.close()
                    system, path = open_store(f"{folder}/{archive}")
                    file, opened = system.open_input_file(path), archive
                fields, http, payload = parse_record(zlib.decompress(file.read_at(length, start), 31))
                digest, kind, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], int(http["Content-Length"])
                if kind == "response":
                    if base32_sha1(payload) != digest:
                        raise ValueError(f"{archive} at {start}: the payload is not the one that was written")
                    size = len(payload)
                out.append((fields["X-Page-Id"] or None, size, digest, kind, fields.get("X-Refers-To-Page-Id"), position, key))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)
        if file is not None:
            file.close()

    found = placed.mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op1_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back through the merged index; pages are captured a second apart,
    ids taken modulo the seconds of a century, so that any id gives a time of this century."""
    pages = read_table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    offset = F.pmod(F.coalesce(F.col("page_id").cast("bigint"), F.lit(0)), F.lit(CENTURY_SECONDS))
    time = F.timestamp_seconds(F.lit(1_704_067_200) + offset)
    index = merge_runs(write_archives(pages, folder, time=time))
    captures = read_captures(index, folder)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
with pages_ as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
),
first as (
    select *, min(page_id) over (partition by hex) as response from pages_
)
select page_id, strlen(payload)::bigint as payload_bytes,
    -- 20 bits of the digest give four letters
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, (5 * (k // 4) + 1)::int, 5))::bigint >> (15 - 5 * (k % 4))::int) & 31)::int, 1)
        for k in range(0, 32)
    ], '') as payload_digest,
    case when page_id = response then 'response' else 'revisit' end as record_type,
    case when page_id <> response then response end as refers_to
from first
"""
