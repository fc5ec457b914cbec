"""WARC archives with a two-level capture index: sorted URL keys in compressed blocks, and a directory of blocks.

Archive and index files lie in one folder that the driver and all executors share; they are opened through
``pyarrow.fs``, by the folder's URI. A file is written under a name of its own attempt and counts only if the
task that wrote it succeeded, so lost executors and second attempts leave no trace in the index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import os
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tools import materialise, scratch_path

BLOCK_LINES = 512  # captures in one compressed block of the index
ARCHIVE_BYTES = 256 << 20  # an archive file is closed behind the record that passes this size
CACHED_BLOCKS = 8
DATE = "1970-01-01T00:00:00Z"


def surt(url: str | None) -> str:
    """Sort-friendly key: host labels reversed and joined by commas, then path and query; scheme, user and www go.

    A null or empty URL has the empty key; what cannot be split keeps its lower-cased text.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip() if "//" in url else "//" + url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "") + ")" + tail


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, url: str | None, page_id: int | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, without compression. A revisit keeps the length and digest of its payload, not the bytes."""
    # a line end would close the header line
    safe = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    body = payload if kind == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {safe}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and payload of one record; the length and digest of a response are taken from its bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))

    def page(name):
        number = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    whole = fields["WARC-Type"] == "response"
    if whole and len(payload) != length:
        raise ValueError("a record is cut")
    return {"page_id": page("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "type": fields["WARC-Type"], "payload": payload if whole else None,
            "payload_bytes": length, "digest": digest(payload) if whole else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "refers_to": page("WARC-Refers-To") if not whole else None}


class Files:
    """Files of one shared folder, given by URI or path."""

    def __init__(self, folder: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        self.opened: dict[str, pa.NativeFile] = {}

    def create(self, name: str):
        self.fs.create_dir(self.root, recursive=True)
        return self.fs.open_output_stream(f"{self.root}/{name}", compression=None)

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.opened:
            if len(self.opened) >= 32:
                self.opened.pop(next(iter(self.opened))).close()
            self.opened[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return self.opened[name].read_at(length, offset)


NO_ID, LAST_ID = -(1 << 63), (1 << 63) - 1


def _number(id_col: str) -> F.Column:
    """The id in the order of the index, where a null comes first."""
    return F.coalesce(F.col(id_col), F.lit(NO_ID))


def _folder(path: str) -> str:
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write a record per row; give the captures: (key, page_id, file, offset, length).

    Of rows whose payload of at least ``least`` bytes is the same, that of the smallest id is a response and
    the others revisit it; smaller payloads are all responses. A null html is an empty payload. Rows that repeat
    the smallest id are responses too; a null id is never the smallest, and is a response if no id has its payload.
    Records are gzip members of their own, so each can be read by its offset alone.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"), F.sha1(body).alias("sha1"))
    # one row per payload and task before the shuffle; only payloads that have several pages travel on
    first = rows.filter(F.length("body") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("sha1").alias("n")) \
        .filter("n > 1 and first is not null")
    revisit = rows.select("page_id", "sha1", F.length("body").alias("size")).filter(f"size >= {least}").join(first, "sha1") \
        .filter("page_id is null or page_id <> first").select("sha1", _number("page_id").alias("_k"), "first").distinct()
    # the decision comes to the page; the key holds the id, so copies of one payload are spread
    decided = rows.withColumn("_k", _number("page_id")).join(revisit, ["sha1", "_k"], "left")

    def write(batches):
        files, out, name, size, stream = Files(folder), [], "", 0, None
        for batch in batches:
            for page_id, link, data, to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "body", "first")), strict=True):
                if stream is None:
                    name, size = f"pages-{os.urandom(8).hex()}.warc.gz", 0
                    stream = files.create(name)
                member = gzip.compress(record("response" if to is None else "revisit", link, page_id, data, digest(data), to), 6, mtime=0)
                stream.write(member)
                out.append((surt(link), page_id, name, size, len(member)))
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    stream.close()
                    stream = None
            yield _batch(out, CAPTURE)
            out = []
        if stream is not None:
            stream.close()

    return materialise(decided.select("page_id", "url", "body", "first").mapInArrow(write, "key string, page_id long, file string, offset long, length long"))


CAPTURE = [("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def write_index(captures: DataFrame, folder: str) -> list[dict]:
    """Sort captures by key and write them as compressed blocks, with a directory of the blocks behind each file's blocks.

    Returned is one entry per file: its name, its least key, and where its directory lies. Files are as many as
    range partitions, so this list does not grow with the number of captures in a partition.
    """
    order = [F.col("key"), F.col("number"), F.col("file"), F.col("offset")]
    ranged = captures.withColumn("number", _number("page_id")).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        files, lines, stream, at, directory, name = Files(folder), [], None, 0, [], f"index-{os.urandom(8).hex()}.gz"

        def close_block():
            nonlocal at, lines
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            stream.write(data)
            directory.append((*lines[0][:2], at, len(data)))
            at, lines = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stream = stream or files.create(name)
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    close_block()
        if stream:
            if lines:
                close_block()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            stream.write(data)
            stream.close()
            yield _batch([(name, *directory[0][:2], at, len(data))], INDEX)

    made = materialise(ranged.select("key", "number", "file", "offset", "length").mapInArrow(write, "file string, least string, least_id long, offset long, length long"))
    return [r.asDict() for r in made.orderBy("least", "least_id", "file").collect()]


INDEX = [("file", pa.string()), ("least", pa.string()), ("least_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]


class CaptureIndex:
    """Looks keys up: the file by its least key, the block by the file's directory, the line within the block."""

    def __init__(self, folder: str, top: list[dict]):
        self.files, self.top = Files(folder), top
        self.least = [(f["least"], f["least_id"]) for f in top]
        self.directories: dict[str, list] = {}
        self.blocks: dict[tuple[str, int], tuple[list, list]] = {}

    def _directory(self, f: dict) -> list:
        if f["file"] not in self.directories:
            if len(self.directories) >= CACHED_BLOCKS:
                self.directories.clear()
            self.directories[f["file"]] = json.loads(zlib.decompress(self.files.read(f["file"], f["offset"], f["length"])))
        return self.directories[f["file"]]

    def _block(self, name: str, offset: int, length: int) -> tuple[list, list]:
        if (name, offset) not in self.blocks:
            if len(self.blocks) >= CACHED_BLOCKS:
                self.blocks.pop(next(iter(self.blocks)))
            lines = [json.loads(x) for x in zlib.decompress(self.files.read(name, offset, length)).decode().split("\n")]
            self.blocks[name, offset] = lines, [(x[0], x[1]) for x in lines]
        return self.blocks[name, offset]

    def find(self, key: str, page_id: int | None = None):
        """Captures of a key, or of one page of it, in the order of the index; they may run over blocks and files."""
        low, high = (key, NO_ID if page_id is None else page_id), (key, LAST_ID if page_id is None else page_id)
        at = max(0, bisect_left(self.least, low) - 1)
        for f in self.top[at:bisect_right(self.least, high)]:
            directory = self._directory(f)
            least = [(b[0], b[1]) for b in directory]
            for _, _, offset, length in directory[max(0, bisect_left(least, low) - 1):bisect_right(least, high)]:
                lines, keys = self._block(f["file"], offset, length)
                yield from lines[bisect_left(keys, low):bisect_right(keys, high)]

    def read(self, capture: list) -> dict:
        return parse(gzip.decompress(self.files.read(capture[2], capture[3], capture[4])))


def read_captures(wanted: DataFrame, folder: str, top: list[dict], payload: bool = False) -> DataFrame:
    """The captures of the wanted pages: (key, page_id, url, payload_bytes, payload_digest, record_type, refers_to).

    ``wanted`` has key and page_id (null: the page without id) and no repetitions. Rows are dealt by range, as the
    index is, so a task stays within neighbouring blocks and a key of very many pages is spread.
    """
    shared = wanted.sparkSession.sparkContext.broadcast(top)
    fields = [("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if payload else [])

    def look_up(batches):
        index, out = CaptureIndex(folder, shared.value), []
        for batch in batches:
            for key, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for capture in index.find(key, number):
                    r = index.read(capture)
                    out.append((key, r["page_id"], r["url"], r["payload_bytes"], r["digest"], r["type"], r["refers_to"], *([r["payload"]] if payload else [])))
                    if len(out) >= 256:
                        yield _batch(out, fields)
                        out = []
        yield _batch(out, fields)

    kind = "key string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payload else "")
    ordered = wanted.select("key", _number("page_id").alias("number")).repartitionByRange("key", "number").sortWithinPartitions("key", "number")
    return ordered.mapInArrow(look_up, kind)


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write pages as archives with an index, then read every capture back through the index.

    One row per row of ``pages``, repeated rows and null ids included; an empty table gives no file and no row.
    """
    folder = _folder(folder or scratch_path(pages.sparkSession, "warc"))
    captures = write_archives(pages, folder, id_col, url, html, least)
    top = write_index(captures, folder)
    return read_captures(captures.select("key", "page_id").distinct(), folder, top)
