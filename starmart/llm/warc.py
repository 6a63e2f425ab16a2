"""WARC archives: a writer with revisit records, and a splittable reader.

Writer: every record is one gzip member of a ``.warc.gz`` file, written by the task that holds the
rows, straight to the shared folder.  Of records with equal payloads of at least ``revisit_bytes``
the one with the largest id is a response, the others are revisit records that refer to it and carry
no payload; smaller ones are always responses.  File names are unique to the attempt and only those
the finished task reports count, so a task that runs again leaves no double records.

Reader: files are cut into byte ranges.  A task scans its range for the gzip magic, checks each
candidate by decoding it (header flags, a WARC header, the announced length and the member's CRC),
and owns the records that start inside its range, reading past its end to finish the last one.
Bytes that do not decode to a record are passed over.

Defined results: a null payload counts as empty; a null id, and a null URL, come back as null; rows
that share the largest id of a payload are all responses; payloads of any length are kept whole; an
empty table gives no record; columns other than those named are not read, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import quoted, text_or_empty

MAGIC = b"\x1f\x8b\x08"
SLACK = 64 << 10
URN = "urn:record:"
#: fixed values of the WARC 1.1 format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URI_SAFE = "!#$%&'()*+,/:;=?@[]~"

RECORD = ("record_id string, url string, record_type string, refers_to string, "
          "payload_bytes long, payload_digest string, digest_ok boolean")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[6:].lstrip("/")
    return fs.FileSystem.from_uri(path)


# ------------------------------------------------------------------------------------- writing

def encode_record(record_id: str | None, url: str | None, kind: str, refers_to: str | None,
                  n_bytes: int, sha1: str, payload: bytes, date: str) -> bytes:
    """One WARC record; a revisit's HTTP header still tells the length of the full payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {n_bytes}\r\n\r\n").encode()
    block = head + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}"]
    if record_id is not None:
        lines.append(f"WARC-Record-ID: <{URN}{record_id}>")
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URI_SAFE)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                  revisit_bytes: int) -> DataFrame:
    """(record_id, url, kind, refers_to, n_bytes, sha1, payload) per row; all ids as text."""
    rows = (pages.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).cast("string").alias("url"),
                         text_or_empty(F.col(quoted(payload_col))).cast("binary").alias("payload"))
            .withColumn("n_bytes", F.octet_length("payload").cast("long"))
            .withColumn("sha1", F.sha1("payload")).withColumn("sha2", F.sha2("payload", 256)))
    # only payloads that occur again; the counts are combined map-side
    again = (rows.where(F.col("n_bytes") >= revisit_bytes).groupBy("sha1", "sha2")
             .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    return (rows.join(again, ["sha1", "sha2"], "left")
            .select(F.col("id").cast("string").alias("record_id"), "url",
                    F.when(revisit, "revisit").otherwise("response").alias("kind"),
                    F.when(revisit, F.col("keep").cast("string")).alias("refers_to"),
                    "n_bytes", "sha1", F.when(~revisit, F.col("payload")).alias("payload")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", revisit_bytes: int = 1000, roll_bytes: int = 1 << 30,
                   level: int = 6, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the rows as archives under ``folder`` (shared); returns the files: path, length, records."""
    spark = pages.sparkSession
    records = with_revisits(pages, id_col, url_col, payload_col, revisit_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"path": [path], "length": pa.array([size], pa.int64()), "records": pa.array([n], pa.int64())})

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    path, size, n = f"{folder}/{name}", 0, 0
                    system, inside = _open(path)
                    system.create_dir(inside.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(inside, compression=None)
                member = gzip.compress(
                    encode_record(r["record_id"], r["url"], r["kind"], r["refers_to"], r["n_bytes"],
                                  r["sha1"], r["payload"] or b"", date), level, mtime=0)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= roll_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    # stored, so that the archives are written once however often the list is read
    manifest = f"{folder}/manifest"
    records.mapInArrow(run, "path string, length long, records long").write.parquet(manifest)
    return spark.read.schema("path string, length long, records long").parquet(manifest)


# ------------------------------------------------------------------------------------- reading

def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and length of the archives in a folder (the contents are not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz")
            .option("recursiveFileLookup", "true").load(folder).select("path", "length"))


def parse_record(data: bytes) -> dict | None:
    """The fields of one decoded member, or None if it is not a whole WARC record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        return None
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    kind = fields.get("warc-type", "")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    told = base64.b32decode(digest).hex() if algorithm == "sha1" and len(digest) == 32 else None
    if kind == "revisit":
        n = next((int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n"))
                  if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
        sha1, ok = told, told is not None
    else:
        n, sha1 = len(payload), hashlib.sha1(payload).hexdigest()
        ok = told is None or told == sha1

    def name(field: str) -> str | None:
        text = fields.get(field, "").strip("<>")
        return text.removeprefix(URN) if text else None

    return {"record_id": name("warc-record-id"), "url": fields.get("warc-target-uri"),
            "record_type": kind, "refers_to": name("warc-refers-to"), "payload_bytes": n,
            "payload_digest": sha1, "digest_ok": ok, "payload": payload if kind == "response" else None}


def _member(read, at: int, buffer: bytes, offset: int) -> tuple[bytes, int] | None:
    """(decoded member, its size) for a member at file position ``at``; None if it is not one.

    ``buffer[offset:]`` are the bytes from ``at`` that are at hand; more are read as needed.
    """
    if buffer[offset + 3] & 0xE0:
        return None
    decoder, parts, used, first = zlib.decompressobj(31), [], 0, True
    chunk = buffer[offset:offset + SLACK]
    taken = len(chunk)
    try:
        while chunk:
            parts.append(decoder.decompress(chunk))
            used += len(chunk)
            if first and len(parts[0]) >= 7:
                if not parts[0].startswith(b"WARC/1."):
                    return None
                first = False
            if decoder.eof:
                return b"".join(parts), used - len(decoder.unused_data)
            chunk = buffer[offset + taken:offset + taken + SLACK] or read(at + taken, SLACK)
            taken += len(chunk)
    except zlib.error:
        pass
    return None


def records_in(read, start: int, end: int) -> Iterator[dict]:
    """The records whose members start in [start, end); ``read(position, size)`` gives bytes."""
    buffer = read(start, end - start + 18)
    at = 0
    while (at := buffer.find(MAGIC, at)) >= 0 and at < end - start and at + 3 < len(buffer):
        found = _member(read, start + at, buffer, at)
        record = parse_record(found[0]) if found else None
        if record is None:
            at += 1
        else:
            yield record
            at += found[1]


def read_archives(files: DataFrame, split_bytes: int = 32 << 20, with_payload: bool = True) -> DataFrame:
    """One row per record of ``files`` (path, length): ``RECORD`` and, if wanted, the payload."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)).cast("long"),
                        F.lit(split_bytes).cast("long"))
    splits = (files.select("path", "length", F.explode(starts).alias("start"))
              .select("path", "start", F.least("length", F.col("start") + split_bytes).alias("end")))
    # a task takes a few ranges one after the other once there are many
    tasks = max(1, min(splits.count(), files.sparkSession.sparkContext.defaultParallelism * 64))
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64() if n == "payload_bytes" else pa.bool_() if n == "digest_ok"
             else pa.binary() if n == "payload" else pa.string() for n in names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], type=k) for n, k in zip(names, kinds)], names=names)

        for batch in batches:
            for split in batch.to_pylist():
                system, inside = _open(split["path"])
                rows, size = [], 0
                with system.open_input_file(inside) as file:
                    def read(position: int, n: int) -> bytes:
                        return file.read_at(n, position)

                    for record in records_in(read, split["start"], split["end"]):
                        rows.append(record)
                        size += record["payload_bytes"] or 0
                        if with_payload and size >= 8 << 20 or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return splits.repartition(tasks).mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` as archives in the shared scratch folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    files = write_archives(pages, folder, id_col, **options)
    kind = pages.schema[id_col].dataType
    return read_archives(files, with_payload=False).select(
        F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "url", "digest_ok")
