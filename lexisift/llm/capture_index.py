"""WARC archives with a two-level capture index.

Captures are written as WARC records, one gzip member each, by map tasks that also hand
out where every record lies. Of equal payloads one record holds the payload and the others
revisit it. Index entries are sorted by the URL with its host reversed and packed into
compressed blocks; a directory has the first entry of every block. A lookup binary-searches
the list of index files, the directory of one, and one block, and then knows the byte range
of the record, which is all that is read of the archive.

Tasks write under names of their own. What counts is the table of entries, which is written
as Parquet once all tasks are done, so files of failed attempts are never looked at.
Files are reached with Arrow's file systems (local, HDFS, S3, GCS, Azure), by the folder's URI.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.tables import blocks_for, text_of
from lexisift.session import durable, located

SHARED_BYTES = 100               # payloads below this are always stored
ARCHIVE_BYTES = 1_000_000_000    # compressed bytes after which a task begins another archive
BLOCK_ENTRIES = 1_000            # index entries of one compressed block
SHARD_ENTRIES = 250_000          # index entries of one index file, about
READ_BYTES = 128_000_000         # archive bytes that one task reads, about
CHUNK_BYTES = 4_000_000          # archive bytes that always go to the same task
GAP_BYTES = 16_384               # unwanted bytes read to save a request
KEPT = 8                         # blocks, and directories, that a lookup keeps at hand
DATE = "1970-01-01T00:00:00Z"    # of records without a capture time
LEVEL = 6                        # of compression

ENTRIES = "key string, page_id long, archive string, offset long, length long"
_RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
            "refers_to long, payload binary")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*))?([^#]*)", re.S)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")

# Where an entry sorts: by key, then id; rows without an id come first.
Place = tuple[str, int, int]


def safe_url(url: str) -> str:
    """The URL with blanks and control characters escaped, so that it fits into one line."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str | None) -> str:
    """Host labels from last to first, then the path: ``com,example,www)/a?b``.

    Scheme, login, fragment and the ports 80 and 443 are left out; hosts are lower-cased.
    Without a host the key begins with ``)``; without a URL it is empty.
    """
    if url is None:
        return ""
    authority, path = _URL.match(url).groups()
    host, _, port = (authority or "").rpartition("@")[2].lower().partition(":")
    labels = ",".join(reversed(host.split(".")))
    return safe_url(labels + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (path or "/"))


def _place(key: str, page_id: int | None) -> Place:
    return (key, 0, 0) if page_id is None else (key, 1, page_id)


def _member(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _capture(page_id: int | None, url: str | None, payload: str | None, size: int, digest: str, first: int | None) -> bytes:
    """A record; without a payload one that revisits ``first``."""
    headers = [("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", safe_url(url)))
    headers.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if payload is None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _urn(first))]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    return _member(headers, http.encode() + (payload or "").encode())


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def parse_capture(member: bytes) -> tuple:
    """``(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload)`` of a gzip member."""
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    if not head.startswith(b"WARC/1.1") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    number = lambda name: int(n) if (n := fields[name][len("<urn:page:"):-1]) else None
    if fields["warc-type"] == "revisit":
        return number("warc-record-id"), fields.get("warc-target-uri"), "revisit", size, digest, number("warc-refers-to"), None
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of record {fields['warc-record-id']} is not what was written")
    return number("warc-record-id"), fields.get("warc-target-uri"), "response", size, digest, None, payload


def _archiver(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = located(folder)
        out, name = None, None
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "size", "digest", "first"))):
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"captures-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                       ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                member, offset = _capture(*row), out.tell()
                out.write(member)
                rows.append((url_key(row[1]), row[0], name, offset, len(member)))
            yield _entries(rows)
        if out is not None:
            out.close()
    return run


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    names = ("key", "page_id", "archive", "offset", "length")
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_pydict({
        n: pa.array([r[i] for r in rows], kinds[i]) for i, n in enumerate(names)})


def _tasks(spark: SparkSession, amount: int, per_task: int) -> int:
    """Enough tasks for the amount, and for all cores."""
    return max(blocks_for(amount, per_task), 2 * spark.sparkContext.defaultParallelism)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per ``(page_id, url, html)`` row; returns the table of index entries.

    The payload is ``html`` in UTF-8, null counting as empty. Of records with equal payloads of at
    least 100 bytes that with the smallest ``page_id`` holds it and the others revisit it;
    rows that repeat the smallest ``page_id`` hold it as well, as do all where no row has
    an id. Other columns are ignored. Payloads stay in the task that reads them unless so many
    are repeated that their digests have to be joined by a shuffle.
    """
    store, root = located(folder)
    store.create_dir(root, recursive=True)
    payload = text_of("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"),
                        F.sha2(payload, 256).alias("digest"))
    repeated = durable(rows.where(F.col("size") >= SHARED_BYTES).groupBy(F.col("digest").alias("same"))
                       .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    joined = rows.join(repeated, (F.col("digest") == F.col("same")) & (F.col("size") >= SHARED_BYTES), "left")
    kept = F.col("same").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    records = joined.select("page_id", "url", F.when(kept, F.col("payload")).alias("payload"), "size", "digest", "first")
    return durable(records.mapInArrow(_archiver(folder), ENTRIES), "entries")


@dataclass(frozen=True)
class CaptureIndex:
    """Archives and their index, all in one folder."""

    folder: str

    @property
    def shards(self) -> str:
        return f"{self.folder}/shards.json"


def _packer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted entries to one index file of compressed blocks, and its directory."""
        store, root = located(folder)
        name, out, directory, lines, first, last = f"index-{uuid.uuid4().hex}", None, [], [], None, None

        def flush():
            block = zlib.compress("\n".join(lines).encode(), LEVEL)
            directory.append([*first, out.tell(), len(block)])
            out.write(block)
            lines.clear()
        for batch in batches:
            for key, page_id, archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = store.open_output_stream(f"{root}/{name}.blocks", compression=None)
                last = _place(key, page_id)
                first = first if lines else last
                lines.append(f"{key}\t{'' if page_id is None else page_id}\t{archive}\t{offset}\t{length}")
                if len(lines) >= BLOCK_ENTRIES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with store.open_output_stream(f"{root}/{name}.directory", compression=None) as file:
                file.write(zlib.compress(json.dumps(directory).encode()))
            yield pa.RecordBatch.from_pydict({"shard": [name], "range": [json.dumps([directory[0][:3], last])]})
    return run


def build_index(entries: DataFrame, folder: str) -> CaptureIndex:
    """Sort entries by range into index files, each with a block directory.

    The driver sees one row per index file, which ``SHARD_ENTRIES`` and the cores bound.
    """
    shards = _tasks(entries.sparkSession, entries.count(), SHARD_ENTRIES)
    order = ["key", "page_id", "archive", "offset"]
    packed = (entries.select("key", "page_id", "archive", "offset", "length").repartitionByRange(shards, *order)
              .sortWithinPartitions(*order).mapInArrow(_packer(folder), "shard string, range string"))
    # By first and last entry: where many files begin with the same one, longer ranges come later.
    listed = sorted((json.loads(row.range), row.shard) for row in packed.collect())
    index = CaptureIndex(folder)
    store, path = located(index.shards)
    with store.open_output_stream(path, compression=None) as file:
        file.write(json.dumps(listed).encode())
    return index


class Lookup:
    """Binary search over index files, directory and block; reads only what it needs."""

    def __init__(self, index: CaptureIndex):
        self._store, self._root = located(index.folder)
        listed = json.loads(self._read("shards.json"))
        self._firsts, self._names = [tuple(first) for (first, _), _ in listed], [n for _, n in listed]
        self._kept: dict[str, OrderedDict] = {"directory": OrderedDict(), "block": OrderedDict()}

    def _read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        with self._store.open_input_file(f"{self._root}/{name}") as file:
            return file.read_at(file.size() if length is None else length, offset)

    def _cached(self, kind: str, key, load):
        kept = self._kept[kind]
        if key not in kept:
            kept[key] = load()
            if len(kept) > KEPT:
                kept.popitem(last=False)
        kept.move_to_end(key)
        return kept[key]

    def _directory(self, name: str) -> tuple[list[Place], list[tuple[int, int]]]:
        def load():
            rows = json.loads(zlib.decompress(self._read(f"{name}.directory")))
            return [tuple(r[:3]) for r in rows], [tuple(r[3:]) for r in rows]
        return self._cached("directory", name, load)

    def _block(self, name: str, offset: int, length: int) -> tuple[list[Place], list[list[str]]]:
        def load():
            text = zlib.decompress(self._read(f"{name}.blocks", offset, length)).decode()
            rows = [line.split("\t") for line in text.split("\n")]
            return [_place(r[0], int(r[1]) if r[1] else None) for r in rows], rows
        return self._cached("block", (name, offset), load)

    def find(self, low: Place, high: Place) -> Iterator[tuple]:
        """Entries from ``low`` to ``high``, both included."""
        for shard in self._overlapping(self._firsts, low, high):
            firsts, ranges = self._directory(self._names[shard])
            for block in self._overlapping(firsts, low, high):
                places, rows = self._block(self._names[shard], *ranges[block])
                for row in rows[bisect_left(places, low):bisect_right(places, high)]:
                    yield row[0], int(row[1]) if row[1] else None, row[2], int(row[3]), int(row[4])

    @staticmethod
    def _overlapping(firsts: list[Place], low: Place, high: Place) -> range:
        return range(max(bisect_left(firsts, low) - 1, 0), bisect_right(firsts, high))


def _finder(index: CaptureIndex, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = None
        for batch in batches:
            lookup = lookup or Lookup(index)
            rows = []
            for key, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist()):
                low, high = (_place(key, page_id),) * 2 if exact else ((key, 0, 0), (key, 2, 0))
                for row in lookup.find(low, high):
                    rows.append(row)
                    if len(rows) >= 10_000:
                        yield _entries(rows)
                        rows = []
            if rows:
                yield _entries(rows)
    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"key": pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string()),
                                          "page_id": batch.column("page_id")})


def look_up(index: CaptureIndex, requests: DataFrame) -> DataFrame:
    """Index entries of the requested captures, each once.

    ``requests`` have ``url`` and, if wanted, ``page_id``; without the latter all captures of a URL
    are found. Null matches null. Requests are sorted like the index, so a task reads
    neighbouring blocks, each once.
    """
    exact = "page_id" in requests.columns
    page = F.col("page_id").cast("long") if exact else F.lit(None).cast("long")
    keys = (requests.select(F.col("url").cast("string").alias("url"), page.alias("page_id"))
            .mapInArrow(_keys, "key string, page_id long").distinct())
    keys = durable(keys, "requests")
    tasks = _tasks(requests.sparkSession, keys.count(), SHARD_ENTRIES)
    return (keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
            .mapInArrow(_finder(index, exact), ENTRIES))


def _reader(folder: str, payloads: bool):
    def members(store, root, rows):
        """Ranges of one archive that lie close together are one request."""
        archive, offset, end = rows[0][0], rows[0][1], rows[-1][1] + rows[-1][2]
        with store.open_input_file(f"{root}/{archive}") as file:
            data = file.read_at(end - offset, offset)
        for _, at, length in rows:
            yield parse_capture(data[at - offset:at - offset + length])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = located(folder)

        def records(rows):
            found = list(members(store, root, rows))
            names = [field.split()[0] for field in _RECORDS.split(", ")]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_pydict({
                n: pa.array([r[i] if i < 6 or payloads else None for r in found], kinds[i]) for i, n in enumerate(names)})
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if rows and (row[0] != rows[-1][0] or row[1] - rows[-1][1] - rows[-1][2] > GAP_BYTES
                             or row[1] - rows[0][1] > CHUNK_BYTES):
                    yield records(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield records(rows)
    return run


def read_captures(index: CaptureIndex, entries: DataFrame, payloads: bool = True) -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload`` of index entries.

    Every record is read by its byte range, decompressed and held against its own length and
    digest; a damaged one stops the job. Size and digest are those of the whole payload for
    revisits too, whose ``payload`` is null. ``payloads=False`` leaves all payloads null.
    """
    entries = durable(entries, "wanted")
    total = entries.agg(F.sum("length")).first()[0] or 0
    chunk = F.floor(F.col("offset") / CHUNK_BYTES)
    return (entries.select("archive", "offset", "length", chunk.alias("chunk"))
            .repartition(_tasks(entries.sparkSession, total, READ_BYTES), "archive", "chunk")
            .sortWithinPartitions("archive", "offset")
            .mapInArrow(_reader(index.folder, payloads), _RECORDS))


def archive_pages(pages: DataFrame, folder: str) -> CaptureIndex:
    """Write archives and index of ``(page_id, url, html)`` rows below ``folder``."""
    return build_index(write_archives(pages, folder), folder)
