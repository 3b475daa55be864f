"""WARC archives with a two-level capture index.

Archives: every task writes its pages as WARC/1.1 records, each a gzip member of its own, into files of
at most ``ARCHIVE_BYTES`` in the shared folder, and returns where each record lies. A payload that
several pages share is a response at one of them; the others are revisits, which carry the digest and
the payload's length but not the payload.

Index: entries are sorted by the key of their URL (host reversed, then path) across all tasks, and
written as compressed blocks of ``BLOCK_ENTRIES`` lines. The sparse directory has one row a block: its
first and last key, file, offset and length. A look-up searches the directory by halves, reads the
ranges of the few blocks that can hold the key, searches those by halves, and reads the records'
ranges.

Files that a lost or repeated task leaves behind are never read: only what the committed rows name is.

Edge cases: a null page is an empty payload. Payloads of less than ``MIN_SHARED`` bytes are always
responses. Null ids never are the page that is revisited, unless all pages of the payload have null
ids (then all are responses); repeated rows of the smallest id are all responses. A null or odd URL
has an odd key (empty for null) and is found by it. Empty tables make an empty index. Other columns
of pages are not stored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.llm.common import ship, staged
from celluloid.session import own_scratch, scratch_path

MIN_SHARED = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_ENTRIES = 1_000
READ_GAP = 64 << 10  # ranges this close are read at once
DIRECTORY_ROWS = 2_000_000  # of a directory that is held for look-ups

ENTRY = "key string, url string, page_id long, file string, offset long, length long, record_type string, payload_digest string, payload_bytes long, refers_to long"
BLOCK = "first_key string, last_key string, file string, offset long, length long, entries long"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, port, then path and query; without scheme and fragment."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].lower()
    name, colon, port = host.partition(":")
    name = ",".join(reversed(name.removeprefix("www.").split(".")))
    return f"{name}{colon}{port})/{path}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One WARC record. Line ends in a URL are escaped, so that a header stays one line."""
    revisit = refers_to is not None
    line = lambda text: (text or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {line(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {line(refers_url)}")
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:size]


def planned(pages: DataFrame) -> DataFrame:
    """Pages with payload, its digest and length, and the page that holds it if that is another one."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    known = known.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    narrow = known.where((F.col("bytes") >= MIN_SHARED) & F.col("page_id").isNotNull())
    # only payloads that occur again are joined back; counted before the shuffle
    first = narrow.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("copies"))
    nulls = known.where((F.col("bytes") >= MIN_SHARED) & F.col("page_id").isNull()).select(F.col("digest").alias("null_digest")).distinct()
    first = first.join(nulls, F.col("digest") == F.col("null_digest"), "left").where("copies > 1 or null_digest is not null")
    first = first.select(F.col("digest").alias("shared"), "first")
    return (
        known.join(first, F.col("digest") == F.col("shared"), "left")
        .withColumn("refers_to", F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first.page_id")))
        .select("page_id", "url", "payload", "digest", "refers_to", F.when(F.col("refers_to").isNotNull(), F.col("first.url")).alias("refers_url"))
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the records and returns their index entries, staged."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            entries = []
            for row in batch.to_pylist():
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                member = gzip.compress(record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["refers_url"]), 6, mtime=0)
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                entries.append((url_key(row["url"]), row["url"], row["page_id"], name, at, len(member), kind, row["digest"], len(row["payload"]), row["refers_to"]))
                at += len(member)
            if entries:
                yield _batch(entries, ENTRY)
        if out is not None:
            out.close()

    return staged(planned(pages).mapInArrow(run, ENTRY), "warc-entries")


def _batch(rows: list[tuple], layout: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in layout.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Sorts entries by key, writes them in compressed blocks, and returns the sparse directory, staged.

    Pages of one host, and of one URL, may be many: the sort is by key and then by page and place.
    """
    order = ["key", "page_id", "file", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name, at, waiting, out = f"{uuid.uuid4().hex}.idx", 0, [], None

        def flush() -> tuple:
            nonlocal at, waiting, out
            if out is None:
                out = system.open_output_stream(f"{path}/{name}", compression=None)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _batch([], ENTRY).schema) as writer:
                writer.write_batch(_batch(waiting, ENTRY))
            block = zlib.compress(sink.getvalue().to_pybytes(), 6)
            out.write(block)
            row = (waiting[0][0], waiting[-1][0], name, at, len(block), len(waiting))
            at, waiting = at + len(block), []
            return row

        for batch in batches:
            made = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                waiting.append(row)
                if len(waiting) == BLOCK_ENTRIES:
                    made.append(flush())
            if made:
                yield _batch(made, BLOCK)
        if waiting:
            yield _batch([flush()], BLOCK)
        if out is not None:
            out.close()

    ranged = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ranged.mapInArrow(run, BLOCK), "warc-directory")


def read_block(system: fs.FileSystem, path: str, name: str, offset: int, length: int) -> pa.RecordBatch:
    with system.open_input_file(f"{path}/{name}") as file:
        data = zlib.decompress(file.read_at(length, offset))
    return pa.ipc.open_stream(data).read_next_batch()


@dataclass
class CaptureIndex:
    """Archives and index in one folder; ``directory`` has a row a block."""

    spark: SparkSession
    folder: str
    directory: DataFrame

    @staticmethod
    def build(pages: DataFrame, folder: str | None = None) -> CaptureIndex:
        own_scratch(pages.sparkSession)
        folder = folder or scratch_path(pages.sparkSession, "warc")
        entries = write_archives(pages, f"{folder}/archives")
        return CaptureIndex(pages.sparkSession, folder, write_index(entries, f"{folder}/index"))

    def entries(self) -> DataFrame:
        """All index entries, read from the blocks the directory names."""
        folder = f"{self.folder}/index"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, path = open_folder(folder)
            for batch in batches:
                for row in batch.to_pylist():
                    yield read_block(system, path, row["file"], row["offset"], row["length"])

        ship(self.spark)
        return self.directory.repartition(F.xxhash64("file", "offset")).mapInArrow(run, ENTRY)

    def records(self) -> DataFrame:
        """All records, read back from the archives by the ranges in the index."""
        # neighbours in a file are read by one task, in their order; a file is cut into stretches
        stretch = F.floor(F.col("offset") / (8 << 20))
        ordered = self.entries().repartition("file", stretch).sortWithinPartitions("file", "offset")
        return ordered.select("file", "offset", "length").mapInArrow(_reader(f"{self.folder}/archives"), RECORD)

    def find(self, urls: list[str]) -> list[dict]:
        """Records of some URLs, by halving the directory and then the blocks."""
        rows = self.directory.orderBy("first_key", "last_key").limit(DIRECTORY_ROWS + 1).collect()
        if len(rows) > DIRECTORY_ROWS:
            raise ValueError("the directory is larger than a look-up holds; use find_all")
        first, last = [r["first_key"] for r in rows], [r["last_key"] for r in rows]
        system, path = open_folder(f"{self.folder}/index")
        store, archive_path = open_folder(f"{self.folder}/archives")
        found = []
        for url in urls:
            key = url_key(url)
            for place in range(bisect_left(last, key), bisect_right(first, key)):
                block = read_block(system, path, rows[place]["file"], rows[place]["offset"], rows[place]["length"])
                keys = block.column("key").to_pylist()
                for number in range(bisect_left(keys, key), bisect_right(keys, key)):
                    entry = block.slice(number, 1).to_pylist()[0]
                    if entry["url"] == url:
                        with store.open_input_file(f"{archive_path}/{entry['file']}") as file:
                            found.append(as_record(file.read_at(entry["length"], entry["offset"])))
        return found

    def find_all(self, urls: DataFrame) -> DataFrame:
        """Records of many URLs (column url): blocks that hold none of their keys are not read."""
        key = F.udf(url_key, "string")
        wanted = urls.select("url", key("url").alias("key")).distinct()
        hit = self.entries().alias("e").join(wanted.alias("w"), (F.col("e.key") == F.col("w.key")) & F.col("e.url").eqNullSafe(F.col("w.url")), "left_semi")
        ordered = hit.repartition("file").sortWithinPartitions("file", "offset").select("file", "offset", "length")
        return ordered.mapInArrow(_reader(f"{self.folder}/archives"), RECORD)


def as_record(member: bytes) -> dict:
    """A record's fields from its gzip member; a response's digest and length are those of the payload read."""
    headers, payload = parse(gzip.decompress(member))
    number = lambda name: int(headers[name]) if name in headers else None
    revisit = headers["WARC-Type"] == "revisit"
    digest = headers["WARC-Payload-Digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest()
    return {
        "page_id": number("X-Page-Id"),
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": number("X-Payload-Length") if revisit else len(payload),
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload": None if revisit else payload,
    }


def _reader(folder: str):
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        file, opened = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            at = 0
            while at < len(places):
                name, start, length = places[at]
                end, upto = start + length, at + 1
                while upto < len(places) and places[upto][0] == name and places[upto][1] - end <= READ_GAP and places[upto][1] - start < 4 << 20:
                    end = places[upto][1] + places[upto][2]
                    upto += 1
                if opened != name:
                    if file is not None:
                        file.close()
                    file, opened = system.open_input_file(f"{path}/{name}"), name
                data = file.read_at(end - start, start)
                found = [as_record(data[o - start : o - start + size]) for _, o, size in places[at:upto]]
                yield _batch([tuple(f[n] for n in names) for f in found], RECORD)
                at = upto
        if file is not None:
            file.close()

    return run
