"""WARC archives of pages, and a two-level capture index over them.

Writing: every page becomes a record, a gzip member of its own, in archive files
that each task fills one after another. Of equal payloads of at least
``LEAST_REVISIT`` bytes the page with the smallest id is a ``response``; the
others are ``revisit`` records, which name it and hold no payload.

Index: a capture is a line of its sort key (the URL's host reversed, then path and
query, then the page id) and the place of its record. Lines are sorted over the
whole table by ranges; each range is a shard. A shard's lines are cut into blocks of
``BLOCK_LINES``, each compressed on its own, and a sparse directory holds the first
key, place and size of each block. A list of the shards' first keys (a row for each
shuffle partition) says which shard a key belongs to.

Reading: wanted captures come sorted by key, in ranges. A task searches the shards,
then the shard's directory, by bisection, reads the blocks that can hold the key by
their byte range, and bisects in the block. The records found are dealt out by file
and place, so that a task reads neighbours with one range read, and parsed.

Files lie in a folder that all executors share. A task names its files by itself
and never writes to another's; only the rows of tasks that Spark counts as done
name the files that are read, so the files of a lost or repeated attempt are never
looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

LEAST_REVISIT = 100
BLOCK_LINES = 3000
#: An archive file is closed when it has grown to this.
ARCHIVE_BYTES = 1 << 30
#: Records this near to each other in a file are read at once, up to a read of READ_BYTES (a larger record is read alone).
GAP_BYTES, READ_BYTES = 1 << 14, 8 << 20
#: Rows are handed back to Spark when they hold so many bytes of payload.
BATCH_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records carry no capture time of their own; the field is mandatory.
DATE = "1970-01-01T00:00:00Z"
_ID = "urn:capture:"
_END = b"\r\n\r\n"

CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels from the last to the first, port, path and query, in lower-case host.

    Scheme, user, "www." and fragment don't count. Something without a host is its own
    key, after a space; a null URL's key is empty.
    """
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        host = ""
    if not host:
        return " " + _plain(url)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return _plain(f"{where}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else ""))


def _plain(text: str) -> str:
    """Without characters that end a line or a field."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _id_key(page_id: int | None) -> str:
    """Page ids as text in their order; a null id comes last."""
    return "~" if page_id is None else f"{page_id + (1 << 63):020d}"


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{url_key(url)}\t{_id_key(page_id)}"


def originals(pages: DataFrame) -> DataFrame:
    """``pages`` as (page_id, url, payload, digest, first_id): the full payload in UTF-8, its SHA-256, and
    the smallest id that has it (null if no other row has it or it is shorter than LEAST_REVISIT)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= LEAST_REVISIT)
    # a row for each payload met twice: the join's left side may be split where one payload has many rows
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", "first_id")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first_id: int | None) -> bytes:
    """A WARC record: a response with the payload, or a revisit of the page that has it."""
    revisit = first_id is not None and page_id != first_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", json.dumps(url, ensure_ascii=False)[1:-1]))
    if revisit:
        fields[1:1] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_ID}{first_id}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + _END


def parse(raw: bytes) -> dict:
    """What a record says: its fields, and what the payload itself gives for a response."""
    head, _, rest = raw.partition(_END)
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != _END:
        raise ValueError(f"record {fields['WARC-Record-ID']} is cut")
    http, _, payload = rest[:size].partition(_END)

    def page(name: str) -> int | None:
        told = fields[name][1:-1].removeprefix(_ID)
        return None if told == "none" else int(told)

    found = {"page_id": page("WARC-Record-ID"), "record_type": fields["WARC-Type"], "url": None}
    if "WARC-Target-URI" in fields:
        found["url"] = json.loads(f'"{fields["WARC-Target-URI"]}"')
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if found["record_type"] == "revisit":
        told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
        return found | {
            "payload_bytes": int(told["Content-Length"]), "payload_digest": digest, "refers_to": page("WARC-Refers-To"),
            "payload": None,
        }
    own = hashlib.sha256(payload).hexdigest()
    if own != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
    return found | {"payload_bytes": len(payload), "payload_digest": own, "refers_to": None, "payload": payload}


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` into archive files below ``folder``; returns the captures
    (:data:`CAPTURE`), as a written table, a row for each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(f"{folder}/archive")
        store.create_dir(base)
        out, file, size = None, "", 0
        try:
            for batch in batches:
                rows: list[tuple] = []
                for page_id, url, payload, digest, first_id in zip(*[batch[c] for c in batch.schema.names]):
                    if out is None or size >= archive_bytes:
                        if out is not None:
                            out.close()
                        file, size = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{file}", compression=None)
                    told = (page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), first_id.as_py())
                    member = gzip.compress(record(*told), 6, mtime=0)
                    out.write(member)
                    rows.append((capture_key(told[1], told[0]), told[0], file, size, len(member)))
                    size += len(member)
                if rows:
                    yield _batch(rows, CAPTURE)
        finally:
            if out is not None:
                out.close()

    spark = pages.sparkSession
    originals(pages).mapInArrow(run, CAPTURE).write.parquet(f"{folder}/captures")
    return spark.read.parquet(f"{folder}/captures")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [pa.field(*(lambda name, kind: (name, kinds[kind]))(*f.split())) for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures by key into shards of compressed blocks with a sparse directory each, below
    ``folder``; returns the shards (shard, first_key), as a written table."""
    spark = captures.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(shards, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(f"{folder}/index")
        store.create_dir(base)
        shard, first, directory, lines, size = uuid.uuid4().hex, None, [], [], 0

        def block() -> None:
            nonlocal size
            packed = zlib.compress("\n".join(lines).encode(), 6)
            blocks.write(packed)
            directory.append(f"{_key_of(lines[0])}\n{size} {len(packed)}")
            size += len(packed)
            lines.clear()

        blocks = None
        for batch in batches:
            for key, file, offset, length in zip(*[batch[c].to_pylist() for c in ("key", "file", "offset", "length")]):
                if blocks is None:
                    blocks, first = store.open_output_stream(f"{base}/{shard}.blocks", compression=None), key
                lines.append(f"{key}\t{file} {offset} {length}")
                if len(lines) == block_lines:
                    block()
        if blocks is None:
            return
        if lines:
            block()
        blocks.close()
        with store.open_output_stream(f"{base}/{shard}.directory", compression=None) as out:
            out.write("\n".join(directory).encode())
        yield _batch([(shard, first)], "shard string, first_key string")

    ordered.mapInArrow(run, "shard string, first_key string").write.parquet(f"{folder}/shards")
    return spark.read.parquet(f"{folder}/shards")


def _key_of(line: str) -> str:
    return line.rpartition("\t")[0]


class Index:
    """A reader of the index for keys that come in rising order: it holds a directory and a block at a time."""

    def __init__(self, folder: str, shards: list[tuple[str, str]]) -> None:
        self.store, self.base = _store(f"{folder}/index")
        self.shards = sorted(shards, key=lambda s: s[1].encode())
        self.starts = [first.encode() for _, first in self.shards]
        self.shard = self.held = -1
        self.reads = 0

    def _open(self, shard: int) -> None:
        if shard != self.shard:
            name = f"{self.base}/{self.shards[shard][0]}"
            with self.store.open_input_stream(f"{name}.directory", compression=None) as f:
                told = f.read().decode().split("\n")
            self.firsts = [key.encode() for key in told[::2]]
            self.spans = [tuple(map(int, span.split())) for span in told[1::2]]
            self.blocks = self.store.open_input_file(f"{name}.blocks")
            self.shard, self.held = shard, -1

    def _block(self, block: int) -> None:
        if block != self.held:
            offset, length = self.spans[block]
            self.blocks.seek(offset)
            self.lines = zlib.decompress(self.blocks.read(length)).decode().split("\n")
            self.keys = [_key_of(line).encode() for line in self.lines]
            self.held = block
            self.reads += 1

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of all captures of a key."""
        wanted = key.encode()
        # a key may go on over the ends of blocks and shards: it starts in the last of those that begin before it
        shard = max(0, bisect_left(self.starts, wanted) - 1)
        while shard < len(self.shards) and self.starts[shard] <= wanted:
            self._open(shard)
            block = max(0, bisect_left(self.firsts, wanted) - 1)
            while block < len(self.firsts) and self.firsts[block] <= wanted:
                self._block(block)
                for at in range(bisect_left(self.keys, wanted), bisect_right(self.keys, wanted)):
                    file, offset, length = self.lines[at].rpartition("\t")[2].split()
                    yield file, int(offset), int(length)
                block += 1
            shard += 1


def lookup(wanted: DataFrame, folder: str) -> DataFrame:
    """(file, offset, length): the places of all captures of the (url, page_id) rows of ``wanted``, by the index below ``folder``.

    A capture that several rows ask for is found once; what isn't in the index gives no row.
    """
    spark = wanted.sparkSession
    # a row for each shuffle partition of the index
    shards = spark.sparkContext.broadcast([tuple(r) for r in spark.read.parquet(f"{folder}/shards").collect()])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows := [(capture_key(u, p),) for u, p in zip(batch["url"].to_pylist(), batch["page_id"].to_pylist())]:
                yield _batch(rows, "key string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, rows = Index(folder, shards.value), []
        for batch in batches:
            for key in batch["key"].to_pylist():
                for place in index.find(key):
                    rows.append(place)
                    if len(rows) == 1 << 14:
                        yield _batch(rows, "file string, offset long, length long")
                        rows = []
        if rows:
            yield _batch(rows, "file string, offset long, length long")

    asked = wanted.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("long").alias("page_id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = asked.mapInArrow(keyed, "key string").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    return keys.mapInArrow(run, "file string, offset long, length long")


def _near(places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Sorted (offset, length) in groups that one read takes."""
    group: list[tuple[int, int]] = []
    for offset, length in places:
        if group and (offset - sum(group[-1]) > GAP_BYTES or offset + length - group[0][0] > READ_BYTES):
            yield group
            group = []
        group.append((offset, length))
    if group:
        yield group


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records (:data:`RECORD`) at ``places`` (file, offset, length), read by byte ranges and parsed.

    A revisit has no payload; its size and digest are those that it states.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(f"{folder}/archive")
        names = [f.split()[0] for f in RECORD.split(", ")]
        held, source = "", None
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for file, offset, length in zip(*[batch[c].to_pylist() for c in ("file", "offset", "length")]):
                by_file.setdefault(file, []).append((offset, length))
            rows, size = [], 0
            for file, some in by_file.items():
                if file != held:
                    held, source = file, store.open_input_file(f"{base}/{file}")
                for group in _near(sorted(some)):
                    start = group[0][0]
                    source.seek(start)
                    data = source.read(sum(group[-1]) - start)
                    for offset, length in group:
                        found = parse(gzip.decompress(data[offset - start : offset - start + length]))
                        rows.append(tuple(found[c] for c in names))
                        size += found["payload_bytes"]
                    if size >= BATCH_BYTES:
                        yield _batch(rows, RECORD)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, RECORD)

    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, RECORD)


def archive(pages: DataFrame, folder: str) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives with their index below ``folder``, which must not exist yet.

    A null html is an empty payload, a null url has no target URI and the empty key. Of
    equal payloads of LEAST_REVISIT bytes or more, the rows of the smallest id (all of
    them, if rows repeat) are responses; a null id comes after every other, and where
    only null ids have a payload all are responses. Other columns are ignored; an empty
    table gives an index without shards.
    """
    build_index(write_archives(pages, folder), folder)


def open_archive(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of the (url, page_id) rows of ``wanted``, found by the index below ``folder``."""
    return read_records(lookup(wanted, folder), folder)


def resolve(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records, those of a revisit from the
    response that it refers to; a revisit whose response is not among them fails the query."""
    told = materialise(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    payloads = (
        told.where("record_type = 'response'")
        .select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("held"))
        .distinct()
    )
    lost = F.raise_error(F.concat(F.lit("no response for the revisit of page "), F.col("refers_to"))).cast("long")
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.coalesce("held", lost))
    return told.join(payloads, ["refers_to", "payload_digest"], "left").select(
        "page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
