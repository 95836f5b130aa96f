"""WARC archives of pages: written as whole-file gzip streams, then normalised to one member per record with an index.

A crawler's archive is often one gzip stream, which can't be read from the middle. The normaliser inflates each stream
once, from front to back, writes every record as a gzip member of its own, and keeps offset and length of each member in
a sidecar file, so that any record can be read by its range. Records whose payload occurs with a smaller page_id become
revisits on the way. Bodies stay in the files of the shared folder: what Spark shuffles are digests.
"""

import base64
import hashlib
import io
import json
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..materialize import fresh_file_root, snapshot
from ..sources.files import new_file, open_root
from .common import table, utf8

ARCHIVE_BYTES, ARCHIVE_RECORDS = 8 << 20, 20_000    # payload and records of an archive, beyond which a new one begins
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20
RECORDS = "archive string, number int, page_id bigint, payload_bytes bigint, sha1 binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{number}')}>"


def record(archive, number, page_id, url, payload, digest, refers=None) -> bytes:
    """One record. ``refers`` is (record id, page_id) of the response that a revisit has the payload of."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if refers else http + payload
    fields = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(archive, number)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{base32(digest)}")]
    if url:
        fields.append(("WARC-Target-URI", "".join(url.split())))
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if refers:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers[0])]
        if refers[1] is not None:
            fields.append(("X-Refers-To-Page-ID", refers[1]))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def read_record(stream):
    """(fields, block) of the next record of a file-like object, or None at its end."""
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a record: {line[:40]!r}")
    fields = {}
    for line in iter(stream.readline, b"\r\n"):
        if not line:
            raise EOFError("a record ends in its header")
        name, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(": ")
        fields[name] = value
    size = int(fields["Content-Length"])
    block = stream.read(size)
    if len(block) < size or stream.read(4) != b"\r\n\r\n":
        raise EOFError("a record is cut off")
    return fields, block


def payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4:]


class Inflated(io.RawIOBase):
    """Inflates a gzip stream of any number of members from front to back, in bounded pieces."""

    def __init__(self, source):
        self.source, self.inflate, self.rest = source, zlib.decompressobj(31), b""

    def readable(self):
        return True

    def readinto(self, room):
        while True:
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            if not self.rest:
                self.rest = self.source.read(PIECE)
                if not self.rest:
                    return 0
            out = self.inflate.decompress(self.rest, len(room))
            self.rest = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                room[:len(out)] = out
                return len(out)


def write_archives(pages: DataFrame, root: str, run_id: str) -> DataFrame:
    """Writes ``pages(page_id, url, payload)`` below ``root`` as archives that are one gzip stream each.

    One row per record. An archive's name is made of the partition and a count, and its file appears when it is
    complete, so a task that runs again writes the same.
    """
    def read(batches):
        task, count, open_ = TaskContext.get().partitionId(), 0, None
        rows = []

        def begin():
            name = f"{task:06d}-{count:06d}.warc.gz"
            holder = new_file(root, f"stream/{name}", run_id)
            return {"name": name, "file": holder, "out": holder.__enter__(), "deflate": zlib.compressobj(4, zlib.DEFLATED, 31),
                    "bytes": 0, "records": 0}

        def end(archive):
            archive["out"].write(archive["deflate"].flush())
            archive["out"].keep = True
            archive["file"].__exit__(None, None, None)

        for batch in batches:
            for page_id, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None:
                    open_ = begin()
                digest = hashlib.sha1(payload).digest()
                text = record(open_["name"], open_["records"], page_id, (url or b"").decode("utf-8", "surrogateescape"), payload, digest)
                for i in range(0, len(text), PIECE):
                    open_["out"].write(open_["deflate"].compress(text[i:i + PIECE]))
                rows.append((open_["name"], open_["records"], page_id, len(payload), digest))
                open_["bytes"] += len(payload)
                open_["records"] += 1
                if open_["bytes"] >= ARCHIVE_BYTES or open_["records"] >= ARCHIVE_RECORDS:
                    end(open_)
                    open_, count = None, count + 1
            if rows:
                yield _arrow(rows, [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()], RECORDS)
                rows = []
        if open_ is not None:
            end(open_)
    return snapshot(pages.mapInArrow(read, RECORDS), "warc-records")


def _arrow(rows, types, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=[c.split()[0] for c in schema.split(", ")])


def first_payloads(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(archive, number, first)``: the record that has the same payload first, by page_id; null for a record that is
    the first, and for payloads below ``least_bytes``. Digests are grouped on the map side; a payload that very many
    pages share is one row of the small side of a join that adaptive execution splits."""
    place = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "archive", "number")
    firsts = records.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first")
    joined = records.select("sha1", "archive", "number", "payload_bytes").join(firsts, "sha1", "left")
    own = (F.col("first.archive") == F.col("archive")) & (F.col("first.number") == F.col("number"))
    return joined.select("archive", "number", F.when(~own & (F.col("payload_bytes") >= least_bytes), F.col("first")).alias("first"))


def normalise(firsts: DataFrame, root: str, run_id: str, tasks: int = None) -> DataFrame:
    """Inflates each stream once and writes its records as members of their own, with a sidecar of their ranges.

    A task's work is the bytes of its archives and not the few bytes of ``firsts``, so the number of ``tasks`` is given, as
    many as there are archives, and they aren't put together.

    Returns ``(archive, n_records)``. The sidecar has a JSON line per record: its number, offset, length and kind.
    """
    def rewrite(part: pa.Table) -> pa.Table:
        archive = part.column("archive")[0].as_py()
        refers = {n: f for n, f in zip(part.column("number").to_pylist(), part.column("first").to_pylist()) if f}
        fs, path = open_root(root)
        at, number = 0, 0
        with fs.open_input_stream(f"{path}/stream/{archive}", compression=None) as source, \
                new_file(root, f"members/{archive}", run_id) as members, new_file(root, f"members/{archive}.idx", run_id) as index:
            stream = io.BufferedReader(Inflated(source), PIECE)
            while (found := read_record(stream)) is not None:
                fields, block = found
                first = refers.get(number)
                page_id = fields.get("X-Page-ID")
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                text = record(archive, number, page_id, fields.get("WARC-Target-URI"), payload_of(block), digest,
                              first and (record_id(first["archive"], first["number"]), first["page_id"]))
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = deflate.compress(text) + deflate.flush()
                members.write(member)
                index.write(json.dumps({"number": number, "offset": at, "length": len(member),
                                        "kind": "revisit" if first else "response"}).encode() + b"\n")
                at += len(member)
                number += 1
            members.keep = index.keep = True
        return pa.table([[archive], [number]], names=["archive", "n_records"])
    dealt = firsts.repartition(tasks, "archive") if tasks else firsts
    return snapshot(dealt.groupBy("archive").applyInArrow(rewrite, "archive string, n_records bigint"), "warc-members")


READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(archives: DataFrame, root: str) -> DataFrame:
    """One row per record of ``archives(archive)``, each read by its range. A response's payload is hashed anew; a digest
    that differs raises."""
    def read(batches):
        fs, path = open_root(root)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/members/{archive}.idx", compression=None) as lines:
                    index = [json.loads(x) for x in lines.read().splitlines()]
                rows = []
                with fs.open_input_file(f"{path}/members/{archive}") as source:
                    for entry in index:
                        member = zlib.decompress(source.read_at(entry["length"], entry["offset"]), 31)
                        fields, block = read_record(io.BytesIO(member))
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(block[:block.index(b"\r\n\r\n")].rpartition(b"Content-Length: ")[2])
                        if fields["WARC-Type"] == "response" and (base32(hashlib.sha1(payload_of(block)).digest()) != digest
                                                                  or len(payload_of(block)) != size):
                            raise ValueError(f"{archive}, record {entry['number']}: its payload isn't what was written")
                        rows.append((_id(fields.get("X-Page-ID")), fields.get("WARC-Target-URI"), size, digest,
                                     fields["WARC-Type"], _id(fields.get("X-Refers-To-Page-ID"))))
                if rows:
                    yield _arrow(rows, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()], READ)
    return archives.select("archive").mapInArrow(read, READ)


def _id(text):
    return None if text is None else int(text)


def archive_pages(pages: DataFrame, root: str = None, least_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes ``pages(page_id, url, html)`` as archives below ``root`` (a new folder of the shared one by default):
    (``archive, n_records``, root). A null html is an empty payload, a null page_id is written without one and comes after
    all others; repeated rows are records of their own, of which the first is the response. No pages make no archive."""
    root, run_id = root or fresh_file_root(pages.sparkSession, "warc"), uuid.uuid4().hex
    records = write_archives(pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("binary"), utf8("html").alias("payload")),
                             root, run_id)
    tasks = max(1, min(100_000, records.select("archive").distinct().count()))
    return normalise(first_payloads(records, least_bytes), root, run_id, tasks), root


def op2_warc(spark, sf_dir):
    archives, root = archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read_archives(archives.repartition(max(1, min(100_000, archives.count()))), root).drop("url")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, CAST(CAST(from_hex(sha1(b)) AS BIT) AS VARCHAR) AS bits,
      min(page_id) OVER (PARTITION BY b) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to FROM d
"""
