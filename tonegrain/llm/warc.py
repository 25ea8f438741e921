"""WARC archives: a writer with revisit records, and a salvage reader.

The writer puts each record into a gzip member of its own, so one damaged record costs no
other.  The reader checks every record (gzip checksum, version line, lengths, block digest);
where a check fails it looks for the next valid member or version line, goes on from there,
and logs the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonegrain.llm.common import cut_lineage, open_folder, pieces, shared_folder, temp_name

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r?\n")
_NOT_IN_URI = re.compile(r"[\x00-\x20\x7f-\x9f\u2028\u2029]")  # controls, space and line ends
_READ = 1 << 18


# ----------------------------------------------------------------------- writing
def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of ``least`` bytes or more, all but the one with
    the largest page_id refer to that one.

    Groups are found on digests alone.  Only groups of two or more are joined back; that table
    is cut off first, so Spark can split the join at a payload that a third of the pages have.
    """
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sum", F.unhex(F.sha2("html", 256)))
    large = slim.where(F.octet_length("html") >= least).select("page_id", "sum")
    groups = large.groupBy("sum").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 and keeper is not null")
    joined = slim.join(cut_lineage(groups.select("sum", "keeper")), "sum", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))


def _record_id(page_id: int | None, *more: object) -> str:
    name = f"page:{page_id}" if page_id is not None else f"page:none:{more}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, url, len(payload))), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _NOT_IN_URI.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (page_id, url, html, refers_to) as archives and return the manifest (file, bytes, records).

    Each attempt of a task writes files of new names; the manifest, written by Spark beside
    them, names those of the attempts that counted, so a lost or repeated task leaves at most
    files that nobody reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        done: list[tuple[str, int, int]] = []
        out = None
        for batch in batches:
            for piece in pieces(batch, "html"):
                for page_id, url, html, refers_to in zip(*(piece.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    if out is None:
                        name, size, count = temp_name("pages", ".warc.gz"), 0, 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip_member(make_record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to, date))
                    out.write(member)
                    size, count = size + len(member), count + 1
                    if size >= file_bytes:
                        out.close()
                        out = None
                        done.append((name, size, count))
        if out is not None:
            out.close()
            done.append((name, size, count))
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "bytes": s, "records": c} for f, s, c in done],
            pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    schema = "file string, bytes long, records long"
    pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, schema).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


# ----------------------------------------------------------------------- reading
class _Damaged(Exception):
    """A check failed."""


def parse_record(record: bytes, exact: bool) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and length of the record at the start of ``record``; raises _Damaged if a check fails.

    ``exact``: nothing may follow it (a gzip member holds one record).
    """
    line = _VERSION_LINE.match(record)
    if not line:
        raise _Damaged("version line")
    end = re.compile(rb"\r?\n\r?\n").search(record, line.end() - 2)
    if not end:
        raise _Damaged("header")
    fields = {}
    head = record[line.end():end.start()]
    for row in re.split(rb"\r?\n", head) if head else ():  # bytes: as text, U+0085 and others end a line too
        name, colon, value = row.decode("utf-8", "replace").partition(":")
        if not colon:
            raise _Damaged("header")
        fields[name.strip().lower()] = value.strip(" \t")
    if not fields.get("content-length", "").isdigit():
        raise _Damaged("content length")
    stop = end.end() + int(fields["content-length"])
    block = record[end.end():stop]
    if len(record) < stop:
        raise _Damaged("truncated")
    after = re.compile(rb"\r?\n\r?\n").match(record, stop)
    if not after or exact and after.end() != len(record):
        raise _Damaged("record end")
    if fields.get("warc-block-digest", "").lower().startswith("sha1:") and fields["warc-block-digest"][5:] != _sha1(block)[5:]:
        raise _Damaged("block digest")
    return fields, block, after.end()


class Salvage:
    """Reads the records of one archive, gzip members and plain records alike, past any damage.

    Only the current record and a window of the file are in memory.
    """

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.gaps: list[tuple[int, int, str]] = []

    def _at(self, start: int, length: int) -> bytes:
        length = min(length, self.size - start)
        return self.source.read_at(length, start) if length > 0 else b""

    def _member(self, start: int) -> tuple[dict[str, str], bytes, int]:
        unpack, at, parts = zlib.decompressobj(31), start, []
        try:
            while not unpack.eof:
                chunk = self._at(at, _READ)
                if not chunk:
                    raise _Damaged("truncated member")
                at += len(chunk)
                parts.append(unpack.decompress(chunk))
                if len(parts) == 1 and not b"WARC/".startswith(parts[0][:5]):
                    raise _Damaged("version line")
        except zlib.error:
            raise _Damaged("gzip member") from None
        fields, block, _ = parse_record(b"".join(parts), exact=True)
        return fields, block, at - len(unpack.unused_data) - start

    def _plain(self, start: int) -> tuple[dict[str, str], bytes, int]:
        head = self._at(start, _READ)
        while True:
            try:
                return parse_record(head, exact=False)
            except _Damaged as bad:
                if start + len(head) >= self.size or str(bad) in ("version line", "content length", "block digest"):
                    raise
                length = re.search(rb"(?i)\ncontent-length:\s*(\d+)", head)
                need = int(length[1]) + len(head) if length and len(length[1]) < 19 else 2 * len(head)
                grown = self._at(start, max(need, 2 * len(head)) if start + need <= self.size else self.size - start)
                if len(grown) == len(head) or str(bad) == "record end" and len(head) > need:
                    raise
                head = grown

    def _next(self, start: int) -> int:
        """The next place from ``start`` on where a member or a version line begins, or the end."""
        at = start
        while at < self.size:
            chunk = self._at(at, _READ + 16)
            line = _VERSION_LINE.search(chunk)
            found = min(i for i in (chunk.find(GZIP_MAGIC), line.start() if line else -1, len(chunk)) if i >= 0)
            if found < min(_READ, len(chunk)):
                return at + found
            at += _READ
        return self.size

    def __iter__(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        """(offset, length, fields, block) of each whole record."""
        at, bad, reason = 0, None, ""
        while at < self.size:
            try:
                read = self._member if self._at(at, 3) == GZIP_MAGIC else self._plain
                fields, block, length = read(at)
            except _Damaged as damage:
                if bad is None:
                    bad, reason = at, str(damage)
                at = self._next(at + 1)
                continue
            if bad is not None:
                self.gaps.append((bad, at - bad, reason))
                bad = None
            yield at, length, fields, block
            at += length
        if bad is not None:
            self.gaps.append((bad, self.size - bad, reason))


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    rows = [r.partition(":") for r in head.decode("utf-8", "replace").split("\r\n")[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in rows}, payload


_RECORD = pa.schema([
    ("kind", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()),
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def read_archives(files: DataFrame, folder: str, with_payload: bool = True, whole: bool = False) -> DataFrame:
    """Records and gaps of the archives in column ``file`` of ``files``, below ``folder``.

    kind 'record': a whole record; its payload digest (hex SHA-1) and size are computed from
    the payload, or taken from the head of a revisit.  kind 'gap': ``length`` quarantined bytes
    from ``offset`` on, with the check that failed first.

    ``whole``: a file of fewer or more records than column ``records`` of ``files`` says is an error.
    """

    def rows(name: str) -> Iterator[dict]:
        system, path = open_folder(folder)
        with system.open_input_file(f"{path}/{name}") as source:
            salvage = Salvage(source, source.size())
            for offset, length, fields, block in salvage:
                http, payload = _http(block)
                revisit = fields.get("warc-type") == "revisit"
                stated = fields.get("warc-payload-digest", "")[5:]
                number = lambda key: int(v) if (v := fields.get(key)) and v.lstrip("-").isdigit() else None
                digest = base64.b32decode(stated).hex() if revisit and stated else hashlib.sha1(payload).hexdigest()
                yield {
                    "kind": "record", "file": name, "offset": offset, "length": length, "page_id": number("x-page-id"),
                    "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"), "refers_to": number("x-refers-to-page-id"),
                    "payload_bytes": int(http.get("content-length", 0)) if revisit else len(payload), "payload_digest": digest,
                    "payload": payload if with_payload and not revisit else None,
                }
            for offset, length, reason in salvage.gaps:
                yield {"kind": "gap", "file": name, "offset": offset, "length": length, "reason": reason}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, stated in zip(*(batch.column(c).to_pylist() for c in ("file", "records"))):
                held, size, count = [], 0, 0
                for row in rows(name):
                    count += row["kind"] == "record"
                    held.append(row)
                    size += len(row.get("payload") or b"") + 200
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, _RECORD)
                        held, size = [], 0
                if whole and count != stated:
                    raise ValueError(f"{name}: {count} records read, {stated} written")
                if held:
                    yield pa.RecordBatch.from_pylist(held, _RECORD)

    return files.select("file", F.col("records") if whole else F.lit(None).cast("long").alias("records")).mapInArrow(run, (
        "kind string, file string, offset long, length long, reason string, page_id long, url string, record_type string, "
        "refers_to long, payload_bytes long, payload_digest string, payload binary"))


def archive_pages(pages: DataFrame, with_payload: bool = True, **options) -> DataFrame:
    """Write ``pages`` (page_id, url, html, ...) as archives in a new shared folder and read them back.

    A null html counts as empty, a null url or page_id leaves its field out; a page without
    page_id is a revisit if an equal payload has one.  Repeated rows become repeated records; an
    empty table gives no record; other columns are not looked at.  Fails if a record that was
    written is not read.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    manifest = write_archives(with_revisits(pages), folder, **options)
    n = max(1, pages.sparkSession.sparkContext.defaultParallelism * 4)
    return read_archives(manifest.repartition(n, "file"), folder, with_payload, whole=True)
