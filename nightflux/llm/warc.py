"""WARC archives: whole-file gzip streams, their normalisation to one member a record, and a sidecar index."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.llm.common import batches
from nightflux.llm.files import Target, opened
from nightflux.session import cut

END = b"\r\n"
#: Payloads shorter than this are always written whole.
LEAST = 100
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL, FILE_BYTES, PIECE = 3, 64 << 20, 1 << 20


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; without payload a revisit, which names the response that holds it."""
    name = "" if page_id is None else str(page_id)
    head = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url:
        head.append(("WARC-Target-URI", "".join(url.split())))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size))]
    block = b""
    if payload is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    else:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + END + block + END + END


def header(data: bytes) -> dict[str, str]:
    """Fields of a record's head, names in lower case; lines that start with white space go on the line before."""
    lines = data.decode("utf-8", "replace").replace("\r\n ", " ").replace("\r\n\t", " ").split("\r\n")
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}


def records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, dict[str, str], int]]:
    """Each record of an inflated stream: its bytes, its head's fields and where its block starts; holds one record at a time."""
    held = bytearray()
    ended = False

    def fill(upto: int) -> bool:
        nonlocal ended
        while len(held) < upto and not ended:
            piece = next(pieces, None)
            if piece is None:
                ended = True
            else:
                held.extend(piece)
        return len(held) >= upto

    while True:
        while fill(1) and held[:1] in (b"\r", b"\n"):
            del held[:1]
        if not held:
            return
        seen = 0
        while (at := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError("the archive ends inside a record's head")
        fields = header(bytes(held[:at]))
        size = at + 4 + int(fields["content-length"])
        if not fill(size):
            raise ValueError("the archive ends inside a record's block")
        yield bytes(held[:size]), fields, at + 4
        del held[:size]


def inflated(source) -> Iterator[bytes]:
    """A file's content, whatever members it was compressed as, in pieces and in one pass."""
    machine = zlib.decompressobj(31)
    while data := source.read(PIECE):
        while data:
            yield machine.decompress(data, PIECE)
            data = machine.unconsumed_tail
            if machine.eof:
                data, machine = machine.unused_data or data, zlib.decompressobj(31)


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """Whole-file gzip archives with a record for each row of ``page_id, url, payload, digest, size, refers_to``; returns their names."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, target, machine, size = [], None, None, 0

        def close() -> None:
            nonlocal target
            if target:
                target.write(machine.flush())
                target.__exit__()
                made.append(target.name)
                target = None

        for batch in batches(stream):
            for row in zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "payload", "digest", "size", "refers_to")), strict=True):
                if target is None:
                    target, machine, size = Target(folder, "whole"), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                data = record(*row)
                target.write(machine.compress(data))
                size += len(data)
                if size >= FILE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["file"])

    return cut(pages.mapInArrow(run, "file string"))


def normalise(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites archives with one gzip member a record, and an index beside each.

    Every archive of ``manifest`` (``file``, in folder ``source``) is inflated once, in pieces.  The index has a
    line for each record: offset, length, type and record id, tab-separated.  Returns ``file`` and ``index`` names
    in folder ``target``, and the number of ``records``.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name in batch.column("file").to_pylist():
                at = n = 0
                with opened(source, name) as f, Target(target, "members") as out, Target(target, "index") as index:
                    for data, fields, _ in records(inflated(f)):
                        machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = machine.compress(data + END + END) + machine.flush()
                        out.write(member)
                        index.write(f"{at}\t{len(member)}\t{fields.get('warc-type', '')}\t{fields.get('warc-record-id', '')}\n".encode())
                        at, n = at + len(member), n + 1
                yield pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([index.name]), pa.array([n], pa.int64())], ["file", "index", "records"])

    return cut(manifest.repartition(max(1, manifest.count()), "file").mapInArrow(run, "file string, index string, records long"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record, found through the index: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    The digest of a response is taken from the payload that is read; that of a revisit, and its size, stand in its head.
    """

    def number(field: str | None) -> int | None:
        text = (field or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, index in zip(batch.column("file").to_pylist(), batch.column("index").to_pylist(), strict=True):
                with opened(folder, index) as f:
                    lines = f.read().decode().splitlines()
                with opened(folder, name) as f:
                    for start in range(0, len(lines), 200):
                        rows = []
                        for line in lines[start : start + 200]:
                            offset, length = map(int, line.split("\t")[:2])
                            f.seek(offset)
                            data, fields, at = next(records(iter([zlib.decompress(f.read(length), 31)])))
                            payload, size = None, int(fields["x-payload-length"])
                            digest = fields["warc-payload-digest"].removeprefix("sha256:")
                            if fields["warc-type"] == "response":
                                payload = data[data.index(b"\r\n\r\n", at) + 4 :]
                                if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                                    raise ValueError(f"{name}: the payload at {offset} is not what its head says")
                            rows.append((number(fields["warc-record-id"]), size, digest, fields["warc-type"], number(fields.get("warc-refers-to")), payload))
                        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return manifest.repartition(max(1, manifest.count()), "file").mapInArrow(run, schema)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Rows for the writer from ``page_id, url, html``: of equal payloads of LEAST bytes or more only the smallest id keeps its payload.

    A null html is an empty payload.  Rows that repeat the smallest id are responses too; rows
    without id are revisits if another row has the payload, else responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    twice = rows.where(F.col("size") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    rows = rows.join(cut(twice.select("digest", "first")), "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", F.when(~other, F.col("payload")).alias("payload"), "digest", "size", F.when(other, F.col("first")).alias("refers_to"))
