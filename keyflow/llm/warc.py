"""WARC archives: a writer with payload revisits and a splittable reader.

Writer: every page is one WARC record in a gzip member of its own, and a file is
its members one after the other, as archive tools expect. They are written through
Spark's text writer, so any file system that Spark writes to will do, and the
commit protocol drops the files of lost tasks. That writer puts a separator behind
every row: a zero byte, which is each member's own last byte (the top byte of its
length; a longer record than 16 MB is followed by an empty member), so the rows
come without it and no byte stands between members.

Reader: files are cut into byte ranges. A task looks for the gzip magic in its
range, accepts a member only if its first bytes inflate to a WARC header, reads
the record even where it runs past the range, and goes on behind it. It owns
the records that start inside its range, so each is read exactly once.

Defined results: a null html is an empty payload; a payload of any length is one
record, which a task holds whole while it writes or reads it; a null url is written as
``about:blank``. Of equal payloads of at least ``min_revisit`` bytes the largest
page_id is the response (null ids last); rows repeated with that id are
responses too. An empty table gives no records. Only page_id, url and html are
read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import default_parallelism, scratch_dir

from .common import materialize

GZIP_LEVEL = 6
RANGE_BYTES = 4 << 20
#: bytes inflated to tell whether a candidate is a record
PROBE = 512
#: compressed bytes inflated at a time
STEP = 16 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, response: bool, level: int) -> bytes:
    """One gzip member holding one record."""
    http = HTTP.format(len(payload)).encode()
    block = http + payload if response else http
    uri = quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")
    head = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-Id: {'' if page_id is None else page_id}",
            f"X-Payload-Length: {len(payload)}"]
    if not response:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {'' if refers_to is None else refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


#: a gzip member of nothing
EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def as_row(data: bytes) -> bytes:
    """A member without its last byte, zero, which the row separator adds again."""
    return data[:-1] if data.endswith(b"\0") else data + EMPTY[:-1]


def write_warc(pages: DataFrame, path: str, min_revisit: int = 0,
               level: int = GZIP_LEVEL) -> None:
    """Write every page of ``pages`` as a record below ``path``."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    keepers = (rows.filter(F.octet_length("payload") >= min_revisit).groupBy("sha")
               .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select("sha", "keeper"))
    # written, so that the join shuffles both sides itself and a hot payload is split
    keepers = materialize(keepers, "warc-keepers")
    rows = (rows.join(keepers.withColumn("shared", F.lit(True)), "sha", "left")
            .select("page_id", "url", "payload", "sha", "keeper",
                    (F.col("shared").isNull() | F.col("page_id").eqNullSafe(F.col("keeper")))
                    .alias("response")))

    def members(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 64):
                out = [as_row(member(i, url, data, base64.b32encode(bytes.fromhex(sha)).decode(),
                                     keeper, response, level))
                       for i, url, data, sha, keeper, response in
                       zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    (rows.mapInArrow(members, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("compression", "none").text(path))


def _open(path: str):
    """The file behind a path as Spark lists it, on any store pyarrow reaches."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path).replace("s3a://", "s3://")
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


class _Range:
    """Bytes of a file from ``start`` on, read further as they are needed."""

    def __init__(self, file, start: int, n: int, step: int = 1 << 20):
        self.file, self.start, self.step = file, start, step
        file.seek(start)
        self.data = bytearray(file.read(n))  # grows in place

    def more(self) -> bool:
        self.file.seek(self.start + len(self.data))
        new = self.file.read(self.step)
        self.data += new
        return bool(new)


def _inflate(r: _Range, at: int, most: int = 0) -> tuple[bytes, int] | None:
    """What the member at ``at`` holds (its first ``most`` bytes) and where it ends."""
    z = zlib.decompressobj(31)
    out, pos = [], at
    try:
        while not z.eof:
            if pos >= len(r.data) and not r.more():
                return None
            # a small step at a time: what is left over of it is copied
            chunk = bytes(r.data[pos:pos + (PROBE if most else STEP)])
            out.append(z.decompress(chunk, most))
            pos += len(chunk)
            if most and sum(map(len, out)) >= len(b"WARC/1."):
                break  # else the range ends within the member's first bytes
    except zlib.error:
        return None
    return b"".join(out), pos - len(z.unused_data)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode("utf-8").split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def records_in(path: str, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records whose member starts at ``start`` or later and before ``end``."""
    with _open(path) as file:
        r = _Range(file, start, end - start + 3)
        at = 0
        while True:
            at = r.data.find(b"\x1f\x8b\x08", at)
            if at < 0 or start + at >= end:
                return
            probe = _inflate(r, at, PROBE)
            whole = _inflate(r, at) if probe and probe[0].startswith(b"WARC/1.") else None
            if whole is None:
                at += 1
                continue
            yield parse_record(whole[0])
            at = whole[1]


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES,
              with_payload: bool = True) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to
    of every record below ``path``; the digest of a response is taken anew."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    step = F.lit(range_bytes).cast("long")
    ranges = (files.select("path", "length",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step))
                           .alias("begin"))
              .select("path", "begin", F.least(F.col("begin") + step, F.col("length")).alias("end")))
    # a task for each range, up to some for each core: they are few rows, but much work
    tasks = min(max(1, ranges.count()), 16 * default_parallelism(spark))
    ranges = ranges.repartition(tasks)
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema([k for k in kinds if with_payload or k[0] != "payload"])

    def number(x: str) -> int | None:
        return int(x) if x else None

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for head, block in records_in(name, begin, end):
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].split(":")[1]
                    payload = None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if own != digest:
                            raise ValueError(f"payload digest of {head['WARC-Record-ID']} differs")
                    rows.append({"page_id": number(head["X-Page-Id"]),
                                 "url": head["WARC-Target-URI"], "payload": payload,
                                 "payload_bytes": len(payload) if payload is not None
                                 else int(head["X-Payload-Length"]),
                                 "payload_digest": digest, "record_type": kind,
                                 "refers_to": number(head.get("X-Refers-To-Page", ""))})
                    held += len(payload or b"") if with_payload else 0
                    if len(rows) >= 1000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    out = ", ".join(f"{f.name} {'binary' if f.name == 'payload' else 'long' if f.type == pa.int64() else 'string'}"
                    for f in schema)
    return ranges.mapInArrow(read, out)


def round_trip(pages: DataFrame, min_revisit: int = 0, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` to a fresh folder of the shared area and read it back."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_warc(pages, path, min_revisit)
    return read_warc(pages.sparkSession, path, with_payload=with_payload)
