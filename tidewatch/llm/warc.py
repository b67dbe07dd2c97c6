"""Monolithic gzip archives normalised to one member a record, with a sidecar index (operator 9).

Pages are written, where they are read, as WARC response records into whole-file gzip streams. Digests alone are compared:
of pages with equal payloads that with the largest id stays a response, the others become revisit records, which refer to it
and hold only the HTTP header. The normaliser inflates each stream once, from start to end in bounded pieces, writes every
record, or the revisit in its place, as a gzip member of its own, and a sidecar with offset and length of each, so that a
record can be read alone. No page is shuffled; the streams are removed once the index is written.

Defined results: a null html is an empty payload; rows that share the largest id of a payload are all responses; a null id
is written without an id field and is the smallest; an empty table writes nothing; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import groups_for, open_folder, shuffle_partitions, staged, write_whole
from tidewatch.session import remove_shared_folder, shared_folder

#: Bytes of records in one archive, about.
ARCHIVE_BYTES = 16_000_000
PIECE = 1 << 20
#: Pages of one batch that are Python objects at once.
ROWS = 256
WRITTEN = "file string, place int, page_id long, sha1 binary, size long"
INDEX = "archive string, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
ID_FIELD = "<urn:x-page:{}>"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _joined(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes) -> bytes:
    """One response record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response")]
    if page_id is not None:
        fields.append(("WARC-Record-ID", ID_FIELD.format(page_id)))
    fields += [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", "".join(" " if c in "\r\n" else c for c in url or ""))]
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()), ("Content-Type", "application/http;msgtype=response")]
    return _joined(fields, http + payload)


def revisit(data: bytes, refers_to: int) -> bytes:
    """The revisit record in place of a response: its payload is left out, its HTTP header still tells the length."""
    fields, start = read_head(data)
    fields.pop("Content-Length")
    fields["WARC-Type"] = "revisit"
    fields |= {"WARC-Refers-To": ID_FIELD.format(refers_to), "WARC-Profile": PROFILE}
    return _joined(list(fields.items()), data[start : data.index(b"\r\n\r\n", start) + 4])


def read_head(data) -> tuple[dict[str, str], int]:
    """Fields of the record that ``data`` starts with, and where its block starts (0 if the head is not complete)."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return {}, 0
    lines = bytes(data[:end]).decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:]), end + 4


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of a stream of bytes; holds one record at a time."""
    held = bytearray()
    need = 0
    for piece in pieces:
        held += piece
        while held:
            if not need:
                fields, start = read_head(held)
                if not start:
                    break
                need = start + int(fields["Content-Length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("an archive ends inside a record")


def inflated(file) -> Iterator[bytes]:
    """A gzip stream, inflated once in bounded pieces; further members, if any, follow on."""
    stream = zlib.decompressobj(31)
    while chunk := file.read(PIECE):
        while chunk:
            yield stream.decompress(chunk, PIECE)
            chunk = stream.unconsumed_tail
            if stream.eof:
                chunk, stream = stream.unused_data, zlib.decompressobj(31)


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """One gzip stream a file over many records; returns what was written where (``WRITTEN``), written once."""

    def write(batches):
        held, size, made = [], 0, []

        def flush() -> pa.RecordBatch:
            packer = zlib.compressobj(1, zlib.DEFLATED, 31)
            name = write_whole(folder, "mono.warc.gz", chain((packer.compress(data) for data in held), (packer.flush() for _ in range(1))))
            columns = [[name] * len(made), range(len(made)), *zip(*made, strict=True)]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "place", "page_id", "sha1", "size"])
            held.clear(), made.clear()
            return out

        kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns), strict=True):
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    sha1 = hashlib.sha1(payload).digest()
                    held.append(record(page_id, url, payload, sha1))
                    made.append((page_id, sha1, len(payload)))
                    size += len(held[-1])
                    if size > ARCHIVE_BYTES:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return staged(rows.mapInArrow(write, WRITTEN), "warc-records")


def revisits(written: DataFrame) -> DataFrame:
    """``file``, ``place`` and ``refers_to`` of the records that another page's response stands for."""
    first = written.groupBy("sha1", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL").drop("n")
    return written.join(first, ["sha1", "size"]).where("page_id IS NULL OR page_id <> refers_to").select("file", "place", "refers_to")


def normalise(written: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each stream with a member for every record, and its sidecar; returns the index (``INDEX``), written once."""

    def rewrite(batches):
        for batch in batches:
            for name, changed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = open_folder(source)
                roles, entries = {c["place"]: c["refers_to"] for c in changed or []}, []

                def members(file, roles=roles, entries=entries):
                    at = 0
                    for place, data in enumerate(split_records(inflated(file))):
                        packed = member(revisit(data, roles[place]) if place in roles else data)
                        entries.append((at, len(packed)))
                        at += len(packed)
                        yield packed

                with system.open_input_stream(f"{path}/{name}", compression=None) as file:
                    archive = write_whole(target, "archive.warc.gz", members(file))
                write_whole(target, f"{archive}.idx", [struct.pack("<QQ", *e) for e in entries])
                columns = [pa.array([archive] * len(entries), pa.string()), pa.array([e[0] for e in entries], pa.int64()), pa.array([e[1] for e in entries], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["archive", "offset", "length"])

    spark = written.sparkSession
    total = written.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    changed = revisits(written).groupBy("file").agg(F.collect_list(F.struct("place", "refers_to")).alias("revisits"))  # of one archive
    files = written.groupBy("file").agg(F.count("*").alias("records")).join(changed, "file", "left").select("file", "revisits")
    tasks = groups_for(total, 4 * ARCHIVE_BYTES, shuffle_partitions(spark))
    spread = files.repartition(tasks, F.xxhash64("file"))  # by another key than the join's, or it is left out as needless
    return staged(spread.mapInArrow(rewrite, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every indexed record, read alone by its offset (``RECORDS``)."""

    def read(batches):
        for batch in batches:
            made, name, file = [], None, None
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    system, path = open_folder(folder)
                    name, file = archive, system.open_input_file(f"{path}/{archive}")
                file.seek(offset)
                data = zlib.decompress(file.read(length), 31)
                fields, start = read_head(data)
                http = data[start : data.index(b"\r\n\r\n", start)].decode()
                size = int(next(x for x in http.split("\r\n") if x.startswith("Content-Length: "))[16:])
                ids = [fields[k][len("<urn:x-page:") : -1] if k in fields else None for k in ("WARC-Record-ID", "WARC-Refers-To")]
                made.append((ids[0] and int(ids[0]), size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], ids[1] and int(ids[1])))
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return index.mapInArrow(read, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages, normalise the archives and return what reading them back gives."""
    spark = pages.sparkSession
    source, target = shared_folder(spark, "warc-monolithic"), shared_folder(spark, "warc")
    index = normalise(write_monolithic(pages, source), source, target)
    remove_shared_folder(spark, source)
    return read_records(index, target)
