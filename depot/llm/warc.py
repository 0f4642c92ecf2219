"""WARC archives: a writer with one gzip member per record and a splittable reader.

Writer: every task writes its own files (a fresh random name each attempt) to
the shared folder and reports them; only files reported by committed attempts
are in the manifest, so lost executors and repeated attempts leave nothing
that is read.  Records whose payload equals that of an earlier response are
revisits, which hold headers only.

Reader: files are cut into byte ranges.  A task looks for gzip magic in its
range, validates a candidate by decoding the member's first bytes (they must
begin a WARC header), and owns the records that start inside the range, also
when they end in the next one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import map_arrow, stored
from depot.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.0\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ, _STEP = 1 << 20, 1 << 13


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit carries no payload."""
    body = b"" if revisit else payload
    uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def mark_revisits(pages: DataFrame, min_bytes: int = 0, salts: int = 16) -> DataFrame:
    """Add ``payload`` (null: empty), ``digest``, ``first_id`` (smallest page_id
    among equal payloads of at least ``min_bytes``; null: the page is alone or
    itself the first).  Only digests that occur more than once are joined, each
    repeated over ``salts`` so that one very common payload is split."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    small = pages.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    groups = (small.where(F.octet_length("payload") >= min_bytes)
              .groupBy(F.sha1("payload").alias("digest")).agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")))
    salt = F.pmod(F.coalesce(F.xxhash64("page_id", "url"), F.lit(0)), F.lit(salts)).cast("int")
    joined = p.withColumn("_salt", salt).join(groups, ["digest", "_salt"], "left").drop("_salt")
    big = F.octet_length("payload") >= min_bytes
    return joined.withColumn("first_id", F.when(big & (F.col("first_id") < F.col("page_id")), F.col("first_id")))


def write_archives(pages: DataFrame, min_bytes: int = 0, file_bytes: int = 128 << 20) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the
    manifest (path, bytes, records).

    Null html: an empty payload; null url: an empty URI; a null page_id is
    kept as null and its record always a response; repeated
    page_ids: a record each (all rows of the smallest id are responses);
    further columns are ignored; an empty table: no file."""
    folder = scratch_path(pages.sparkSession, "warc")
    schema = "path string, bytes long, records long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        sink, path, size, records, done = None, "", 0, 0, []
        for b in batches:
            for pid, url, payload, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "first_id"))):
                if sink is None:
                    system.create_dir(base, recursive=True)
                    path = f"part-{uuid.uuid4().hex}.warc.gz"
                    sink, size, records = system.open_output_stream(f"{base}/{path}", compression=None), 0, 0
                raw = member(pid, url, payload, base32_sha1(payload), first, first is not None)
                sink.write(raw)
                size, records = size + len(raw), records + 1
                if size >= file_bytes:
                    sink.close()
                    done.append((f"{folder}/{path}", size, records))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((f"{folder}/{path}", size, records))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "bytes", "records"])

    return stored(map_arrow(mark_revisits(pages, min_bytes).select("page_id", "url", "payload", "first_id"), run, schema), "warc-manifest")


class _Window:
    """Bytes of a file from an offset on, read in steps; what lies behind is dropped."""

    def __init__(self, source, at: int) -> None:
        self.source, self.base, self.data = source, at, b""
        source.seek(at)

    def more(self) -> bool:
        got = self.source.read(_READ)
        self.data += got
        return bool(got)

    def drop(self, to: int) -> None:
        self.data, self.base = self.data[to - self.base:], to

    def find(self, what: bytes, at: int) -> int:
        """First place of ``what`` from offset ``at`` on, or -1 at the end."""
        while True:
            k = self.data.find(what, at - self.base)
            if k >= 0:
                return self.base + k
            at = max(at, self.base + len(self.data) - len(what) + 1)
            self.drop(at)
            if not self.more():
                return -1


def _is_member(w: _Window, at: int) -> bool:
    """Do the bytes at ``at`` decode to the beginning of a WARC header?"""
    unpack, out, k = zlib.decompressobj(31), b"", at - w.base
    while len(out) < len(VERSION):
        if k >= len(w.data) and not w.more():
            return False
        step = w.data[k:k + 512]
        k += len(step)
        try:
            out += unpack.decompress(step, 64)
        except zlib.error:
            return False
        if unpack.eof and len(out) < len(VERSION):
            return False
        if not out.startswith(VERSION[:len(out)]):
            return False
    return True


def _member(w: _Window, at: int) -> tuple[bytes, int]:
    """The decoded member at ``at`` and where it ends."""
    if at - w.base > 4 * _READ:
        w.drop(at)
    unpack, out, k = zlib.decompressobj(31), [], at - w.base
    while not unpack.eof:
        if k >= len(w.data) and not w.more():
            raise EOFError(f"member at {at} is cut off")
        step = w.data[k:k + _STEP]
        k += len(step)
        out.append(unpack.decompress(step))
    return b"".join(out), w.base + k - len(unpack.unused_data)


def records_of_range(source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload) of the records that start in [start, end)."""
    w, at = _Window(source, start), start
    while True:
        at = w.find(MAGIC, at)
        if at < 0 or at >= end:
            return
        if _is_member(w, at):
            break
        at += 1
    while at < end:
        raw, to = _member(w, at)
        head, _, body = raw.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield at, headers, body[:int(headers["Content-Length"])]
        at = to
        if at - w.base >= len(w.data) and not w.more():
            return


def _id(text: str | None) -> int | None:
    value = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value not in ("", "None") else None


def read_archives(manifest: DataFrame, split_bytes: int = 16 << 20, with_payload: bool = True, ranges_a_task: int = 8) -> DataFrame:
    """Read the records back: ``path``, ``offset``, ``record_type``, ``page_id``,
    ``url``, ``payload_bytes`` and ``payload_digest`` (of the full payload, for a
    revisit as its headers tell), ``refers_to``, and ``payload`` (null for
    revisits).  A response whose payload does not have the digest of its
    header fails the job; an empty manifest has no records.  Ranges are dealt
    over as many tasks as there are, up to four a core, and beyond that
    ``ranges_a_task`` to a task."""
    schema = "path string, offset long, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    columns = [c.split()[0] for c in schema.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    ranges = (manifest.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
              .select("path", "start", (F.col("start") + split_bytes).alias("end")))
    # an explicit number: planned by their few bytes, all ranges would go to one task
    n = ranges.count()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    ranges = ranges.repartition(max(1, min(n, 4 * cores), -(-n // ranges_a_task)), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, end in zip(*(b.column(c).to_pylist() for c in ("path", "start", "end"))):
                system, place = _open(path)
                out, held = [], 0
                with system.open_input_file(place) as source:
                    for at, h, payload in records_of_range(source, start, end):
                        kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (base32_sha1(payload) != digest or len(payload) != int(h["X-Payload-Length"])):
                            raise ValueError(f"{path} at {at}: the payload does not have its digest")
                        url = h["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                        out.append((path, at, kind, _id(h["WARC-Record-ID"]), url, int(h["X-Payload-Length"]), digest, _id(h.get("WARC-Refers-To")),
                                    payload if with_payload and kind == "response" else None))
                        held += len(payload) if with_payload else 0
                        if len(out) >= 4096 or held >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], columns)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], columns)

    return map_arrow(ranges, run, schema)
