"""WARC archives as a PySpark Python data source (operator 8).

Reading plans one partition per archive file. Predicates on the record type and
on headers are pushed down: a record's WARC headers are parsed first, and the
payload of a record that fails them is skipped. Records are gzip members of
their own; where a member carries its compressed length (the `sl` extra field
that the writer adds) a skipped record is not even inflated beyond its headers.

Paths are what Arrow's file systems open (local or shared folders, hdfs://, s3://, gs://).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

SCHEMA = ("file string, record_offset bigint, record_type string, record_id string, target_uri string, "
          "warc_date string, refers_to string, payload_digest string, content_length bigint, "
          "headers map<string,string>, http_length bigint, payload binary")
#: What the writer takes; other columns are ignored.
WRITE_SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, "
                "refers_to string, payload_digest string, payload binary, payload_bytes bigint")
MANIFEST = "_committed.json"
_HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
              "warc_date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


def _clean(value: str) -> str:
    """A header value on one line: control characters as percent codes."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record_bytes(record_type: str, record_id: str, target_uri: str | None, warc_date: str, refers_to: str | None,
                 digest: str | None, payload: bytes, payload_bytes: int) -> bytes:
    """One WARC/1.1 record. A revisit's block is the HTTP header alone, whose
    Content-Length still tells the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if record_type == "revisit" else payload if record_type == "warcinfo" else http + payload
    head = [("WARC-Type", record_type), ("WARC-Record-ID", record_id), ("WARC-Date", warc_date),
            ("WARC-Target-URI", target_uri), ("WARC-Payload-Digest", digest and f"sha256:{digest}")]
    if record_type == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", refers_to)]
    kind = "application/warc-fields" if record_type == "warcinfo" else "application/http;msgtype=response"
    head += [("Content-Type", kind), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """`data` as a gzip member whose `sl` extra field has the member's and the data's length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0\0\0\0" + b"\0\xff" + struct.pack("<H", 12)
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _member_lengths(data: memoryview) -> tuple[int, int] | None:
    """(compressed, inflated) length of the gzip member that begins here, if an `sl` field tells them."""
    if len(data) < 24 or not data[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", data, 10)[0]
    while at + 4 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, at + 2)[0]
        if bytes(data[at:at + 2]) == b"sl" and size == 8 and at + 12 <= len(data):
            return struct.unpack_from("<II", data, at + 4)
        at += 4 + size
    return None


class _Stream:
    """A window on an archive: bytes are read ahead in chunks and dropped once used."""

    CHUNK = 1 << 20

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.buffer = file, size, 0, b""

    def at(self, offset: int, want: int) -> memoryview:
        """At least `want` bytes from `offset` on, or all there are."""
        if not (self.start <= offset and min(offset + want, self.size) <= self.start + len(self.buffer)):
            self.start, self.buffer = offset, self.file.read_at(max(want, min(self.CHUNK, self.size - offset)), offset) \
                if offset < self.size else b""
        return memoryview(self.buffer)[offset - self.start:]


class _Member:
    """The bytes of a gzip member, inflated as far as they are asked for, or those of a plain file."""

    def __init__(self, stream: _Stream, offset: int):
        self.stream, self.offset, self.next, self.data = stream, offset, offset, b""
        self.zipped = bytes(stream.at(offset, 2)[:2]) == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if self.zipped else None

    def more(self, want: int = 1 << 14) -> bool:
        """Some more bytes; False at the member's or the file's end."""
        if self.zipped and self.inflate.eof:
            return False
        chunk = bytes(self.stream.at(self.next, want)[:want])
        if not chunk:
            return False
        self.next += len(chunk)
        if not self.zipped:
            self.data += chunk
        else:
            self.data += self.inflate.decompress(chunk)
            if self.inflate.eof:
                self.next -= len(self.inflate.unused_data)
        return True

    def begins(self) -> bool:
        """Whether a record follows, blank lines aside."""
        self.data = self.data.lstrip(b"\r\n")
        while not self.data:
            if not self.more():
                return False
            self.data = self.data.lstrip(b"\r\n")
        return True

    def place(self) -> int:
        """Where the bytes at hand are in the file; those of a gzip member are where it begins."""
        return self.offset if self.zipped else self.next - len(self.data)

    def until(self, mark: bytes, start: int = 0) -> int:
        while (at := self.data.find(mark, start)) < 0:
            if not self.more():
                return -1
        return at

    def upto(self, end: int) -> bytes:
        while len(self.data) < end and self.more(max(1 << 14, (end - len(self.data)) // (4 if self.zipped else 1))):
            pass
        return self.data[:end]

    def skip(self, count: int) -> bool:
        """Leave `count` bytes out; False if there are fewer. A plain file's are not read, nor are
        a gzip member's that hold nothing else and whose length is known."""
        if not self.zipped:
            beyond = max(0, count - len(self.data))
            self.data, self.next = self.data[count:], self.next + beyond
            return self.next <= self.stream.size
        lengths = _member_lengths(self.stream.at(self.offset, 32))
        if lengths and lengths[0] and lengths[1] == (count + 4) & 0xFFFFFFFF and not self.inflate.eof:
            self.data, self.next, self.inflate = b"", self.offset + lengths[0], _Ended
            return self.next <= self.stream.size
        while count > len(self.data):
            count, self.data = count - len(self.data), b""
            if not self.more(1 << 16):
                return False
        self.data = self.data[count:]
        return True


class _Ended:
    eof, unused_data = True, b""


def _headers(block: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    last = ""
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded line continues the one before
            found[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            found[last] = value.strip()
    return found


def read_records(stream: _Stream, wants=lambda headers: True, with_payload=lambda headers: True, name: str = "archive"):
    """(offset, headers, HTTP content length, payload) of the records whose headers
    `wants` accepts; the payload is None, and not decoded, where `with_payload` says no.

    Records follow each other in a plain file, in one gzip member or in a member each; the offset of
    one inside a member is the member's. What is no record, a file that ends inside one and a damaged
    member are errors that name the file and the offset: nothing is passed over in silence.
    """
    offset = 0
    while offset < stream.size:
        member = _Member(stream, offset)
        try:
            while member.begins():
                place = member.place()
                head_end = member.until(b"\r\n\r\n")
                if not member.data.startswith(b"WARC/"):
                    raise ValueError(f"{name}: no WARC record at offset {place}")
                if head_end < 0:
                    raise ValueError(f"{name}: the file ends inside the record at offset {place}")
                headers = _headers(member.data[:head_end])
                said = headers.get("content-length", "0")
                if not said.isdigit():
                    raise ValueError(f"{name}: no content length in the record at offset {place}")
                body, length = head_end + 4, int(said)
                found = None
                if wants(headers):
                    http_length, payload, start = None, None, body
                    if headers.get("content-type", "").startswith("application/http"):
                        http_end = member.until(b"\r\n\r\n", body)
                        if 0 <= http_end < body + length:
                            http, start = _headers(member.data[body:http_end]), http_end + 4
                            http_length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
                    if with_payload(headers) and headers.get("warc-type") != "revisit":
                        payload = member.upto(body + length)[start:]
                    found = place, headers, http_length, payload
                if not member.skip(body + length):
                    raise ValueError(f"{name}: the file ends inside the record at offset {place}")
                if found:
                    yield found
        except zlib.error as e:
            raise ValueError(f"{name}: damaged gzip member at offset {offset}") from e
        if member.zipped and not member.inflate.eof:
            raise ValueError(f"{name}: the file ends inside the gzip member at offset {offset}")
        offset = member.next


@dataclass
class WarcFile(InputPartition):
    uri: str

    def __init__(self, uri: str):
        super().__init__(uri)
        self.uri = uri


def _open(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith(("file:", "/")) else "/" + path)


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload_types: tuple[str, ...] | None):
        self.path, self.payload_types, self.tests = _uri(path), payload_types, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in _HEADER_OF and isinstance(f, EqualTo):
                self.tests.append((_HEADER_OF[column], "in", (f.value,)))
            elif column in _HEADER_OF and isinstance(f, In):
                self.tests.append((_HEADER_OF[column], "in", tuple(f.value)))
            elif column in _HEADER_OF and isinstance(f, StringStartsWith):
                self.tests.append((_HEADER_OF[column], "starts", f.value))
            elif column in _HEADER_OF and isinstance(f, IsNotNull):
                self.tests.append((_HEADER_OF[column], "some", None))
            else:
                yield f  # Spark applies it

    def partitions(self):
        fs, path = _open(self.path)
        scheme = self.path.partition("://")[0] + "://" if "://" in self.path else ""
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [WarcFile(self.path)]
        names = fs.get_file_info(pafs.FileSelector(path))
        files = sorted(f.path for f in names if f.base_name.endswith((".warc", ".warc.gz")))
        listed = [f.path for f in names if f.base_name == MANIFEST]
        if listed:  # only what was committed: a lost task's leftovers don't count
            with fs.open_input_file(listed[0]) as f:
                good = set(json.loads(f.read()))
            files = [f for f in files if f.rpartition("/")[2] in good]
        host = self.path[len(scheme):].partition("/")[0] if scheme == "hdfs://" else ""
        return [WarcFile(scheme + host + f) for f in files]

    def _wants(self, headers: dict[str, str]) -> bool:
        for name, how, value in self.tests:
            own = headers.get(name)
            if own is None or how == "in" and own not in value or how == "starts" and not own.startswith(value):
                return False
        return True

    def read(self, partition: WarcFile):
        if partition is None:  # an archive without files
            return
        schema = pa.schema([("file", pa.string()), ("record_offset", pa.int64()), *((k, pa.string()) for k in _HEADER_OF),
                            ("content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
                            ("http_length", pa.int64()), ("payload", pa.binary())])
        fs, path = _open(partition.uri)
        types = self.payload_types
        with fs.open_input_file(path) as file:
            stream = _Stream(file, file.size())
            rows, held = [], 0
            for offset, headers, http_length, payload in read_records(
                    stream, self._wants, lambda h: types is None or h.get("warc-type") in types, path):
                rows.append([path, offset, *(headers.get(h) for h in _HEADER_OF.values()),
                             int(headers.get("content-length") or 0), list(headers.items()), http_length, payload])
                held += len(payload or b"") + 1000
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceWriter):
    """One archive file per task attempt; commit lists the files that count."""

    def __init__(self, path: str, names: list[str], overwrite: bool):
        self.path, self.names, self.overwrite = _uri(path), names, overwrite

    def write(self, iterator):
        fs, path = _open(self.path)
        at = {n: self.names.index(n) for n in ("record_type", "record_id", "target_uri", "warc_date", "refers_to",
                                               "payload_digest", "payload", "payload_bytes")}
        name, out = None, None
        try:
            for row in iterator:
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(gzip_member(record_bytes("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", None, "1970-01-01T00:00:00Z",
                                                       None, None, b"format: WARC File Format 1.1\r\n", 0)))
                v = {k: row[i] for k, i in at.items()}
                out.write(gzip_member(record_bytes(v["record_type"], v["record_id"], v["target_uri"],
                                                   v["warc_date"] or "1970-01-01T00:00:00Z", v["refers_to"],
                                                   v["payload_digest"], bytes(v["payload"] or b""), v["payload_bytes"])))
        finally:
            if out is not None:
                out.close()
        return _Written(name)

    def commit(self, messages):
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        names, listed = [m.name for m in messages if m is not None and m.name], f"{path}/{MANIFEST}"
        if not self.overwrite and fs.get_file_info(listed).type == pafs.FileType.File:
            with fs.open_input_file(listed) as f:
                names = json.loads(f.read()) + names
        with fs.open_output_stream(listed) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, path = _open(self.path)
        for m in messages:
            if m is not None and m.name:
                fs.delete_file(f"{path}/{m.name}")


class WarcDataSource(DataSource):
    """`spark.read.format("warc").load(path)` and `df.write.format("warc").save(path)`.

    Option `payload` (read): record types whose payload is decoded, comma-joined
    ("none" for no payloads; default all). Set `spark.sql.python.filterPushdown.enabled` for the pushdown.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        types = self.options.get("payload")
        return WarcReader(self.options["path"], tuple(types.split(",")) if types else None)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema.names, overwrite)
