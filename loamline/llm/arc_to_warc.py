"""Converter of legacy ARC archives to WARC.

An ARC file begins with a version block that names its header fields: five in version 1, ten
in version 2. Each record is one header line of those fields and the declared number of
bytes. The converter reads the records by the file's own version, and synthesises what WARC
wants and ARC does not have: a record id from the record's place, an ISO time from the
14-digit one, a record type, block and payload digests, and revisits of equal payloads.

Spark spreads pages and files over tasks; a task handles one record at a time and files of
bounded size. Only files named in a committed manifest are read. Payloads that are equal meet
as digests, in a grouping that combines on the map side, never as bytes.

Null payloads are empty, null addresses are written as ``about:blank``, null page ids are
left out. Of equal payloads the largest page id (null is least; then the last by file and
offset) is the response and the others revisit it; a payload under ``least_bytes`` is always
a response.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import dealt, filesystem, new_file, scratch_uri, text_or_empty, written

# Header fields of both versions of the format, in its order (fixed values).
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-record")
FILE_BYTES = 32_000_000
CRAWLED = "20200101000000"


def sha1_base32(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        inflate, parts, fed = zlib.decompressobj(31), [], at
        while not inflate.eof:
            if fed >= len(view):
                raise ValueError("a member is cut off")
            piece = view[fed : fed + 65536]
            parts.append(inflate.decompress(piece))
            fed += len(piece)
        end = fed - len(inflate.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def member(body: bytes) -> bytes:
    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
    return deflate.compress(body) + deflate.flush()


class ArcRecord(NamedTuple):
    offset: int
    fields: dict[str, str]
    body: bytes


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first; the fields are those it declares."""
    names: tuple[str, ...] = ()
    for offset, _, content in members(data):
        at = 0
        while at < len(content):
            end = content.index(b"\n", at)
            line = content[at:end].decode("utf-8", "replace")
            if not line.strip():
                at = end + 1
                continue
            values = line.split(" ")
            # The version block has version 1 fields whatever the version is.
            wanted = names or ARC_FIELDS[1]
            if len(values) != len(wanted):
                raise ValueError(f"header line with {len(values)} fields, {len(wanted)} declared")
            fields = dict(zip(wanted, values))
            size = int(fields["Archive-length"])
            body = content[end + 1 : end + 1 + size]
            if len(body) != size:
                raise ValueError("a record is shorter than declared")
            if not names:
                version, declared = body.split(b"\n")[:2]
                names = tuple(declared.decode().split(" "))
                if ARC_FIELDS.get(int(version.split(b" ")[0])) != names:
                    raise ValueError("unknown version block")
            yield ArcRecord(offset + at, fields, body)
            at = end + 1 + size


def arc_line(version: int, fields: dict[str, str]) -> bytes:
    return " ".join(fields.get(n) or "-" for n in ARC_FIELDS[version]).encode() + b"\n"


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 origin\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = {
        "URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": CRAWLED,
        "Content-type": "text/plain", "Archive-length": str(len(body)),
    }
    return arc_line(1, head) + body + b"\n"


def http_message(payload: bytes, page_id: int | None) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page_id is not None:
        head += f"X-Page-Id: {page_id}\r\n"
    return f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def http_split(message: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(header fields, header bytes, payload)."""
    head, _, payload = message.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return dict(x.split(": ", 1) for x in lines if ": " in x), head + b"\r\n\r\n", payload


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


class _Writer:
    """Files of bounded size, one after the other."""

    def __init__(self, folder: str, suffix: str, opening):
        self.folder, self.suffix, self.opening = folder, suffix, opening
        self.name, self.stream, self.size, self.files = "", None, 0, []

    def add(self, body: bytes) -> int:
        """Writes a member; its offset in the file ``self.name``."""
        if self.stream is None or self.size >= FILE_BYTES:
            self.close()
            stem = f"part-{TaskContext.get().partitionId():06d}-{len(self.files):04d}"
            self.name, self.stream = new_file(self.folder, stem, self.suffix)
            self.files.append(self.name)
            first = member(self.opening(self.name))
            self.stream.write(first)
            self.size = len(first)
        packed, at = member(body), self.size
        self.stream.write(packed)
        self.size += len(packed)
        return at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def write_arcs(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, str]:
    """(manifest of files, folder): ARC files of the pages, version 1 or 2 by partition."""
    folder = scratch_uri(pages.sparkSession, "arc")

    def write(batches):
        version = 1 + TaskContext.get().partitionId() % 2
        out = _Writer(folder, ".arc.gz", lambda name: arc_version_block(version, name))
        for batch in batches:
            for page, url, html in zip(*(batch.column(i) for i in range(3))):
                payload = html.as_py().encode()
                body = http_message(payload, page.as_py())
                fields = {
                    "URL": re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url.as_py() or "about:blank"),
                    "IP-address": "0.0.0.0", "Archive-date": CRAWLED, "Content-type": "text/html",
                    "Result-code": "200", "Offset": str(out.size), "Filename": out.name,
                    "Archive-length": str(len(body)),
                }
                out.add(arc_line(version, fields) + body + b"\n")
        out.close()
        yield _rows("file string", [(f,) for f in out.files])

    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
        text_or_empty(html_col).alias("html"),
    )
    return written(rows.mapInArrow(write, "file string"), "arc-files"), folder


_INDEX = "file string, offset long, page_id long, payload_bytes long, digest string"


def index_arcs(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a record: file, offset, page_id, payload_bytes, digest."""

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for record in _arc_file(folder, name):
                    # The version block is the file's first record; a page may have such an address.
                    if record.offset == 0:
                        continue
                    head, _, payload = http_split(record.body)
                    page = head.get("X-Page-Id")
                    rows.append((name, record.offset, int(page) if page else None, len(payload), sha1_base32(payload)))
                    if len(rows) >= 4096:
                        yield _rows(_INDEX, rows)
                        rows = []
                yield _rows(_INDEX, rows)

    return written(dealt(manifest, "file").mapInArrow(read, _INDEX), "arc-index")


def _arc_file(folder: str, name: str) -> Iterator[ArcRecord]:
    system, path = filesystem(f"{folder}/{name}")
    with system.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    return read_arc(data)


def decisions(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The index with ``keep_file`` and ``keep_offset`` of the response a record revisits,
    null where the record is a response itself."""
    last = F.max(
        F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page"), F.struct("file", "offset").alias("at"))
    )
    # Of one page id's equal rows the greatest place is as good as the first.
    keep = written(
        index.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
        .agg(last.alias("keep"), F.count("*").alias("n")).where("n > 1")
        .select("digest", "payload_bytes", F.col("keep.at.file").alias("keep_file"), F.col("keep.at.offset").alias("keep_offset")),
        "keep",
    )
    own = (F.col("file") == F.col("keep_file")) & (F.col("offset") == F.col("keep_offset"))
    met = index.join(keep, ["digest", "payload_bytes"], "left")
    return met.select(
        "file", "offset", "page_id", "payload_bytes", "digest",
        F.when(~own, F.col("keep_file")).alias("keep_file"), F.when(~own, F.col("keep_offset")).alias("keep_offset"),
    )


def record_id(file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{file}:{offset}')}>"


def _warc_date(arc: str) -> str:
    d = arc.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [*fields, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _warcinfo(name: str) -> bytes:
    fields = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, 0)), ("WARC-Date", _warc_date(CRAWLED)),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ]
    return _warc_record(fields, b"format: WARC File Format 1.1\r\n")


def convert_record(record: ArcRecord, file: str, keep: tuple[str, int] | None) -> bytes:
    """The WARC record of an ARC record; ``keep`` is the place of the response it revisits."""
    head, head_bytes, payload = http_split(record.body)
    fields = [
        ("WARC-Type", "revisit" if keep else "response"), ("WARC-Record-ID", record_id(file, record.offset)),
        ("WARC-Date", _warc_date(record.fields["Archive-date"])), ("WARC-Target-URI", record.fields["URL"]),
        ("WARC-IP-Address", record.fields["IP-address"]), ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
    ]
    if keep:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(*keep))]
    return _warc_record(fields, head_bytes if keep else record.body)


def convert(decided: DataFrame, folder: str) -> tuple[DataFrame, str]:
    """(manifest, folder) of the WARC files; a task reads each of its ARC files once."""
    target = scratch_uri(decided.sparkSession, "warc")

    def write(batches):
        out = _Writer(target, ".warc.gz", _warcinfo)
        name, records = None, iter(())
        for batch in batches:
            for file, offset, keep_file, keep_offset in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if file != name:
                    name, records = file, _arc_file(folder, file)
                record = next(r for r in records if r.offset == offset)
                out.add(convert_record(record, file, (keep_file, keep_offset) if keep_file else None))
        out.close()
        yield _rows("file string", [(f,) for f in out.files])

    rows = decided.select("file", "offset", "keep_file", "keep_offset")
    # A file has a bounded number of bytes, and so of rows.
    placed = dealt(rows, "file").sortWithinPartitions("file", "offset")
    return written(placed.mapInArrow(write, "file string"), "warc-files"), target


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    for _, _, content in members(data):
        head, _, rest = content.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block = rest[: int(fields["Content-Length"])]
        if fields["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
            raise ValueError("a block differs from its digest")
        yield fields, block


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, record string, refers string"


def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a record of the archives; a revisit's length is its HTTP Content-Length."""

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = filesystem(f"{folder}/{name}")
                with system.open_input_stream(path, compression=None) as stream:
                    data = stream.read()
                rows = []
                for fields, block in read_warc(data):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = http_split(block)
                    page, digest = head.get("X-Page-Id"), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["Content-Length"])
                    if fields["WARC-Type"] == "response" and (len(payload), sha1_base32(payload)) != (size, digest):
                        raise ValueError("a payload differs from its header")
                    rows.append((
                        int(page) if page else None, size, digest, fields["WARC-Type"],
                        fields["WARC-Record-ID"], fields.get("WARC-Refers-To"),
                    ))
                yield _rows(_READ, rows)

    return written(dealt(manifest, "file").mapInArrow(read, _READ), "warc-records")


def archived(pages: DataFrame, least_bytes: int = 0, **columns: str) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the records read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to (page id of the response)."""
    arcs, folder = write_arcs(pages, **columns)
    warcs, target = convert(decisions(index_arcs(arcs, folder), least_bytes), folder)
    records = read_back(warcs, target)
    # Several revisits name one response: its row is the small side, the other may be split.
    named = records.where("refers IS NOT NULL").select(F.col("refers").alias("response")).distinct()
    responses = written(
        records.select(F.col("record").alias("response"), F.col("page_id").alias("refers_to"))
        .join(named, "response"),
        "responses",
    )
    return records.join(responses, F.col("refers") == F.col("response"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
