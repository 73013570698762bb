"""WARC archives: a writer with revisit records, and a reader that goes on behind damage.

The reader checks every record: gzip member (CRC, length) or version line, header, Content-Length, end of record, block and
payload digest (`DIGESTS`, in base32, hex or base64; other schemes cannot be checked and count as no digest). Where a check fails
it searches on, byte by byte, for the next gzip magic whose member holds a whole valid record, or the next line that starts
with a version and passes the same checks. Bytes in between are quarantined: one gap row with their range and the failed check.
Text inside a payload that only looks like a record never passes, as long as its own record is sound.

A member may hold several records and is searched in the same way: records and gaps inside have the member's range, and their own
range of its unpacked bytes (`inner_start`, `inner_end`). Of a member that breaks off, whole records in front of the end are kept;
of one that fails otherwise only those whose block digest agrees. As such a member has no known end, these have a null `end`; a gap
begins where it begins, and the search goes on behind the last of them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.store import written
from rangehaul.session import scratch_path

ARCHIVE_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
READ_BYTES = 1 << 18
# Unpacked bytes of a member that are held at once; a longer one is unpacked again in pieces to read its records.
MEMBER_BYTES = 32 << 20
DIGESTS = {"md5", "sha1", "sha224", "sha256", "sha384", "sha512"}
DATE = "1970-01-01T00:00:00Z"
ID = "urn:page:"

RECORDS = (
    "path string, start long, end long, inner_start long, inner_end long, failed string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_SCHEMA = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("inner_start", pa.int64()), ("inner_end", pa.int64()), ("failed", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string())]
    + [("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC record. A revisit leaves the payload out, and keeps its length and digest."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"] if kind == "revisit" else []),
        f"WARC-Payload-Digest: sha1:{sha1(payload)}", f"WARC-Block-Digest: sha1:{sha1(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Damaged(Exception):
    """A failed check; the text says which."""


def agrees(digest: str, data: bytes) -> bool | None:
    """Whether a digest (`scheme:value`) is that of the data; null where the scheme is unknown."""
    scheme, _, value = digest.partition(":")
    scheme, value = scheme.strip().lower().replace("-", ""), value.strip().rstrip("=")
    if scheme not in DIGESTS:
        return None
    own = hashlib.new(scheme, data).digest()
    plain = lambda coded: coded.decode().rstrip("=")
    return value.upper() == plain(base64.b32encode(own)) or value.lower() == own.hex() or value in (plain(base64.b64encode(own)), plain(base64.urlsafe_b64encode(own)))


def parsed(data: bytes, at: int = 0, sure: bool = True) -> tuple[dict[str, object], int]:
    """The record that starts at `at`, and the place behind it; with `sure=False` only if its block digest agrees."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at : at + 10]):
        raise Damaged("version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("header")
    header = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header")
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not length.isdecimal() or "warc-type" not in header:
        raise Damaged("header")
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("length")
    block = data[begin:end]
    wanted = header.get("warc-block-digest")
    checked = agrees(wanted, block) if wanted else None
    if checked is False:
        raise Damaged("block digest")
    if not sure and not checked:
        raise Damaged("gzip member")
    http, payload = {}, block
    if header.get("content-type", "").startswith("application/http"):
        head, parted, payload = block.partition(b"\r\n\r\n")
        http = {n.strip().lower(): v.strip() for n, c, v in (line.partition(b":") for line in head.split(b"\r\n")) if c}
    digest = header.get("warc-payload-digest")
    revisit = header["warc-type"] == "revisit"
    if digest and not revisit and agrees(digest, payload) is False:
        raise Damaged("payload digest")
    size = len(payload)
    if revisit:
        size = int(told) if (told := http.get(b"content-length", b"")).isdigit() else None
    bare = lambda x: header[x].strip("<>") if x in header else None
    return {
        "record_type": header["warc-type"], "record_id": bare("warc-record-id"), "target_uri": header.get("warc-target-uri"), "refers_to": bare("warc-refers-to"),
        "payload_digest": digest.removeprefix("sha1:") if digest else None, "payload_bytes": size, "payload": None if revisit else payload,
    }, end + 4


class Pieces:
    """Bytes read in pieces; what lies behind is let go."""

    marks = re.compile(rb"(?<=\n)WARC/1\.")
    size, begin, held = 0, 0, b""

    def read(self, start: int, size: int) -> bytes:
        """`size` bytes or more from `start` on, or fewer at the end."""
        raise NotImplementedError

    def upto(self, start: int, end: int) -> bytes:
        """Bytes from `start` to `end`, or fewer at the end."""
        end = min(end, self.size)
        if start < self.begin or start > self.begin + len(self.held):
            self.begin, self.held = start, b""
        if end > self.begin + len(self.held):
            kept = self.held[start - self.begin :]
            self.begin, self.held = start, kept + self.read(start + len(kept), max(end - start - len(kept), READ_BYTES))
        return self.held[start - self.begin : end - self.begin]

    def plain(self, at: int, sure: bool = True) -> tuple[dict[str, object], int]:
        """The unpacked record at `at`."""
        size = READ_BYTES
        head = self.upto(at, at + size)
        stop = head.find(b"\r\n\r\n")
        while stop < 0 and len(head) == size and re.match(rb"WARC/1\.[01]\r\n", head):
            size *= 2
            head = self.upto(at, at + size)
            stop = head.find(b"\r\n\r\n")
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)\s*\r\n", head[: stop + 2]) if stop >= 0 else None
        if length and at + stop + 8 + int(length[1]) > self.size:
            raise Damaged("length")
        whole = self.upto(at, at + stop + 8 + int(length[1])) if length else head
        found, end = parsed(whole, sure=sure)
        return found, at + end

    def records(self, sure: bool = True) -> Iterator[dict[str, object]]:
        at, gap, failed = 0, None, None
        while at < self.size:
            behind = at + 1
            try:
                items, end = self.found(at, sure)
            except Broken as error:
                gap, failed = (at, str(error)) if gap is None else (gap, failed)
                last = 0
                for item in error.items:
                    yield item
                    last = item["inner_end"]
                at = self.next(max(behind, self.packed(at, last)))
                continue
            except Damaged as error:
                gap, failed = (at, str(error)) if gap is None else (gap, failed)
                at = self.next(behind)
                continue
            if gap is not None:
                yield {"start": gap, "end": at, "failed": failed}
                gap = None
            yield from items
            at = end
        if gap is not None:
            yield {"start": gap, "end": self.size, "failed": failed}

    def found(self, at: int, sure: bool) -> tuple[Iterable[dict[str, object]], int]:
        """What is at `at`, and the place behind it."""
        found, end = self.plain(at, sure)
        return [{"start": at, "end": end, **found}], end

    def next(self, at: int) -> int:
        """The next place, from `at` on, where a record may start."""
        while at < self.size:
            before = max(0, at - 1)
            piece = self.upto(before, before + READ_BYTES)
            for found in self.marks.finditer(piece):
                if before + found.start() >= at:
                    return before + found.start()
            if before + len(piece) >= self.size:
                break
            at = before + len(piece) - 8  # a mark may lie across two pieces
        return self.size


class Broken(Damaged):
    """A member that fails behind whole records."""

    def __init__(self, failed: str, items: Iterable[dict[str, object]]):
        super().__init__(failed)
        self.items = items


class Member(Pieces):
    """The unpacked bytes of the gzip member at `at`: held, or unpacked again."""

    def __init__(self, archive: "Archive", at: int, size: int, held: bytes | None):
        self.archive, self.at, self.size, self.held = archive, at, size, held or b""
        self.place, self.pieces = 0, None

    def read(self, start: int, size: int) -> bytes:
        if self.pieces is None or start < self.place:
            self.place, self.pieces = 0, self.archive.unpacked(self.at)
        out, total = [], 0
        for data, _, _ in self.pieces:
            own = data[max(0, start - self.place) :]
            self.place += len(data)
            out.append(own)
            total += len(own)
            if total >= size:
                break
        return b"".join(out)


class Archive(Pieces):
    """A file of records, packed or not."""

    marks = re.compile(rb"\x1f\x8b\x08|(?<=\n)WARC/1\.")

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()

    def read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def unpacked(self, at: int) -> Iterator[tuple[bytes, int | None, str | None]]:
        """The bytes of the gzip member at `at`; at last the place behind it, or the failed check."""
        unzip, place = zlib.decompressobj(31), at
        while not unzip.eof:
            piece = self.upto(place, place + READ_BYTES)
            if not piece:
                yield b"", None, "gzip end"
                return
            before = unzip.copy() if place > at else zlib.decompressobj(31)
            try:
                data = unzip.decompress(piece)
            except zlib.error:
                # What a failing call had unpacked is lost, so these bytes are given one by one.
                yield b"".join(_single(before, piece)), None, "gzip member"
                return
            place += len(piece)
            yield data, None, None
        yield b"", place - len(unzip.unused_data), None

    def packed(self, at: int, size: int) -> int:
        """The place in the member at `at` where `size` bytes of it are unpacked."""
        unzip, place, total = zlib.decompressobj(31), at, 0
        while piece := self.upto(place, place + READ_BYTES):
            before = unzip.copy()
            try:
                data = unzip.decompress(piece)
            except zlib.error:
                data = None
            if data is not None and total + len(data) < size:
                place += len(piece)
                total += len(data)
                continue
            for data in _single(before, piece):
                place += 1
                total += len(data)
                if total >= size:
                    return place
        return place

    def found(self, at: int, sure: bool) -> tuple[Iterable[dict[str, object]], int]:
        if self.upto(at, at + 2) != b"\x1f\x8b":
            return super().found(at, sure)
        held, size = [], 0
        for data, end, failed in self.unpacked(at):
            size += len(data)
            held = [*held, data] if held is not None and size <= MEMBER_BYTES else None
        whole = b"".join(held) if held is not None else None
        inside = Member(self, at, size, whole).records(sure=failed != "gzip member")
        first, early = None, []
        for first in inside:
            early.append(first)
            if "failed" not in first:
                break
        if first is None or "failed" in first:
            raise Damaged(failed or (early[0]["failed"] if early else "version line"))
        items = chain(early, inside)
        if failed:
            raise Broken(failed, ({**x, "start": at, "end": None, "inner_start": x["start"], "inner_end": x["end"]} for x in items if "failed" not in x))
        if first["start"] == 0 and first["end"] == size:
            return [{**first, "end": end, "start": at}], end
        return ({**x, "start": at, "end": end, "inner_start": x["start"], "inner_end": x["end"]} for x in items), end


def _single(unzip, piece: bytes) -> Iterator[bytes]:
    """What each byte of a piece unpacks, as far as it does."""
    try:
        for k in range(len(piece)):
            yield unzip.decompress(piece[k : k + 1])
    except zlib.error:
        return


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least_bytes: int = 0, level: int = 6) -> DataFrame:
    """Write a record per row into `.warc.gz` files (a gzip member each), and return the manifest: `path`, `records`, `bytes`.

    Of equal payloads of at least `least_bytes` bytes the one with the largest id is written whole, the others as revisits of it.
    A null payload is empty, a null address `urn:page:none`, a null id is always written whole and never revisited; equal rows
    with the largest id are all written whole. Each task names its files anew and the manifest is a written table, so files of a lost or
    repeated task are never read. Other columns are ignored; no rows give no files.
    """
    text = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), text.alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8"))).withColumn("size", F.octet_length("payload"))
    firsts = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
    # Only payloads that occur again; a hot one is split by the skew join, as its other side is a single row.
    again = firsts.where("copies > 1 AND original IS NOT NULL").drop("copies")
    joined = rows.join(again, ["digest", "size"], "left").select("page_id", "url", "payload", F.when(F.col("original") > F.col("page_id"), F.col("original")).alias("original"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        stream, path, count = None, "", 0

        def close() -> pa.RecordBatch:
            size = stream.tell()
            stream.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            for key, url, payload, original in zip(*(batch.column(i) for i in range(4)), strict=True):
                if stream is None:
                    system.create_dir(base, recursive=True)
                    path, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    stream = system.open_output_stream(opened(path)[1], compression=None)
                name = lambda x: f"{ID}{x.as_py() if x.is_valid else 'none'}"
                uri = quote(url.as_py(), safe=":/?#[]@!$&'()*+,;=%~") if url.is_valid and url.as_py() else f"{ID}none"
                whole = record("revisit" if original.is_valid else "response", name(key), uri, payload.as_py().encode(), name(original) if original.is_valid else None)
                packer = zlib.compressobj(level, wbits=31)
                stream.write(packer.compress(whole) + packer.flush())
                count += 1
                if stream.tell() >= ARCHIVE_BYTES:
                    yield close()
                    stream = None
        if stream is not None:
            yield close()

    return written(joined.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives in `path`, packed or not; a task per file, in pieces.

    A gap has `failed` (the check that failed at its start) and its byte range `start`, `end`; a record has null there. Both have
    `inner_start`, `inner_end` inside a member with more than one of them. With
    `payloads=False` payloads are checked but not returned. A null path is skipped; an empty file has no records and no gap.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = opened(path)
                with system.open_input_file(place) as file:
                    for found in Archive(file).records():
                        if not payloads:
                            found["payload"] = None
                        held.append({"path": path, **found})
                        size += 200 + len(found.get("payload") or b"")
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)

    files = manifest.select("path").where("path IS NOT NULL")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write `pages` to fresh archives and read them back."""
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc")), payloads=False)
