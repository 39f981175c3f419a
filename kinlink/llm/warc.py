"""WARC archives: writing pages and reading the archives back, one gzip member for each record.

Records with equal payloads of at least ``MIN_REVISIT`` bytes: that with the largest page id is the response, the others are
revisits that refer to it and hold no payload. Files are written by tasks straight into the shared folder, under names no
other attempt uses, and only files whose task finished are listed in the manifest, so a lost or repeated task leaves
nothing that is read. Memory: a writer holds one page, the reader 64 KiB of a record.

A record's id is made from its page's id, so pages that share an id share it too. A revisit holds no payload: its payload's length is
in a header of its own, ``X-Payload-Length`` (which the reader checks on all other records), and its digest in ``WARC-Payload-Digest``;
``unresolved`` lists the revisits whose digest isn't that of a response with the id to which they refer.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import materialize, small_batches

MIN_REVISIT = 1000
FILE_BYTES = 64 << 20
CHUNK = 1 << 16
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
MANIFEST_DDL = "path string, n_records bigint, n_bytes bigint"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    found = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return None if found == "null" else int(found)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record as a gzip member of its own."""
    http = HTTP % len(payload)
    block = http if revisit else http + payload
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE}
    if url is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)
    headers |= {"WARC-Payload-Digest": _sha1(payload), "WARC-Block-Digest": _sha1(block), "X-Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    if revisit:
        headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(refers_to)}
    headers["Content-Length"] = str(len(block))
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Member:
    """The decompressed bytes of one gzip member after the other, 64 KiB at a time."""

    def __init__(self, read: Callable[[int], bytes]) -> None:
        self.read_raw, self.raw, self.out = read, b"", b""
        self.unpack = None

    def begin(self) -> bool:
        """Whether there is another member."""
        self.raw = self.raw or self.read_raw(CHUNK)
        self.unpack, self.out = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        if self.unpack.eof:
            return False
        if not self.raw:
            self.raw = self.read_raw(CHUNK)
            if not self.raw:
                raise ValueError("the archive ends inside a record")
        self.out += self.unpack.decompress(self.raw, CHUNK)
        self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with the first ``mark``."""
        while mark not in self.out:
            if not self.more():
                raise ValueError(f"no {mark!r} in a record's head")
        head, _, self.out = self.out.partition(mark)
        return head + mark

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.out and not self.more():
                raise ValueError("a record is shorter than its Content-Length")
            piece, self.out = self.out[:n], self.out[n:]
            n -= len(piece)
            yield piece

    def end(self) -> None:
        while self.more():
            pass
        if self.out != b"\r\n\r\n":
            raise ValueError("a record doesn't end as its Content-Length says")


def read_records(read: Callable[[int], bytes], keep_payload: bool = False) -> Iterator[tuple[dict[str, str], int, str, bytes | None]]:
    """``(headers, payload_bytes, payload sha1 in hex, payload)`` of each record, in order, with framing and digests verified."""
    member = _Member(read)
    while member.begin():
        first, *lines = member.until(b"\r\n\r\n")[:-4].decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines)
        length = int(headers["Content-Length"])
        block, payload, n, kept, head = hashlib.sha1(), hashlib.sha1(), 0, [], b""
        in_head = headers["Content-Type"].startswith("application/http")
        for piece in member.take(length):
            block.update(piece)
            if in_head:
                head += piece
                if b"\r\n\r\n" not in head:
                    continue
                piece, in_head = head.partition(b"\r\n\r\n")[2], False
            payload.update(piece)
            n += len(piece)
            if keep_payload:
                kept.append(piece)
        member.end()
        b32 = lambda d: "sha1:" + base64.b32encode(d.digest()).decode()
        revisit = headers["WARC-Type"] == "revisit"
        if headers["WARC-Block-Digest"] != b32(block) or not revisit and headers["WARC-Payload-Digest"] != b32(payload):
            raise ValueError(f"wrong digest in record {headers['WARC-Record-ID']}")
        if int(headers["X-Payload-Length"]) != n and not revisit:
            raise ValueError(f"wrong payload length in record {headers['WARC-Record-ID']}")
        yield headers, n, base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex(), b"".join(kept) if keep_payload else None


def with_record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, payload, revisit, refers_to)``: which pages repeat the payload of a page with a larger id."""
    slim = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    own = ["page_id", "url", "payload"]
    # small pages need no partner, so they aren't shuffled
    small = slim.where(F.octet_length("payload") < min_revisit).select(*own, F.lit(False).alias("revisit"), F.lit(None).cast("bigint").alias("refers_to"))
    large = slim.where(F.octet_length("payload") >= min_revisit).withColumn("digest", F.unhex(F.sha1("payload")))
    keepers = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    # written before they are joined, so that the join's sides are plain exchanges and the rows of a very common payload can be split
    met = large.join(materialize(keepers, "warc-keepers"), "digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return met.select(*own, revisit.alias("revisit"), F.when(revisit, F.col("keeper")).alias("refers_to")).unionByName(small)


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as ``*.warc.gz`` below ``folder`` and return the manifest of the files that count.

    Null html is an empty payload; a null url has no target header; null page ids come last among equal payloads; rows that repeat the
    page id and payload of a response are responses too; an empty table writes no file. Other columns are ignored.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        sink, path, files, n, size = None, "", [], 0, 0
        for b in batches:
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if sink is None:
                    path = f"pages-{uuid.uuid4().hex}.warc.gz"
                    sink, n, size = store.open_output_stream(f"{base}/{path}"), 0, 0
                raw = make_record(page_id, url, payload, refers_to, revisit)
                sink.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= file_bytes:
                    sink.close()
                    files.append((path, n, size))
                    sink = None
        if sink is not None:
            sink.close()
            files.append((path, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{f[0]}" for f in files], pa.string()), *(pa.array([f[i] for f in files], pa.int64()) for i in (1, 2))], schema=MANIFEST)

    return materialize(with_record_types(pages, min_revisit).mapInArrow(run, MANIFEST_DDL), "warc-manifest")


RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORDS_DDL = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row for each record of the listed files, each file read from its beginning to its end by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * len(RECORDS)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, RECORDS.types, strict=True)], schema=RECORDS)

        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = pafs.FileSystem.from_uri(path)
                with store.open_input_stream(at) as source:
                    for h, n, digest, _ in read_records(source.read):
                        revisit = h["WARC-Type"] == "revisit"
                        out.append((page_of(h["WARC-Record-ID"]), int(h["X-Payload-Length"]) if revisit else n, digest, h["WARC-Type"], page_of(h["WARC-Refers-To"]) if revisit else None))
                        if len(out) >= 10_000:
                            yield batch()
                            out.clear()
        yield batch()

    files = manifest.count()
    spread = max(1, min(files, 10_000))
    return manifest.select("path").repartition(spread).mapInArrow(run, RECORDS_DDL)


def unresolved(records: DataFrame) -> DataFrame:
    """The revisits among ``records`` (of ``read_archives``) that no response with their digest, length and referred id stands for."""
    stored = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
    return records.where("record_type = 'revisit'").join(stored, ["refers_to", "payload_digest", "payload_bytes"], "left_anti").select(*RECORDS.names)
