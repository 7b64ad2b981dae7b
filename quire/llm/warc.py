"""WARC archives: writing captures with revisits, and reading them by transaction.

Written: one gzip member per record and, for each page, a request, a response
(or a revisit when an equal payload is stored elsewhere) and a metadata record;
request and metadata name the response through WARC-Concurrent-To, a revisit
names the response that holds its payload through WARC-Refers-To.

Read: records are parsed as a stream into a staged table, and a transaction is
assembled by joins on concurrent-to identifiers: records that name a response,
records that a response names, and records that name one of those (metadata of a
request). The result has one nested row per capture: the response or revisit
with its requests and metadata.

Which page keeps a payload is decided by an aggregation over SHA-1 digests (the
smallest page_id, a null one last; among rows that repeat it, one row), so a
payload that many pages share is never gathered in one task.

A null html is an empty payload; a null url has no WARC-Target-URI; a null
page_id is kept. Repeated rows are captures of their own. An empty table gives
no archives and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import AtomicFile, open_fs, shared_folder, stage, with_uid

DATE = "2024-01-01T00:00:00Z"
_MANIFEST = "path string, records long, bytes long"
_RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
           "payload_bytes long, payload_digest string, fields map<string,string>")
CAPTURES = ("response", "revisit", "resource")


def record_id(archive: str, uid: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{archive}:{uid}:{kind}'.encode()).digest())}>"


def _field(value: str) -> str:
    """A header value on one line."""
    return "".join(c if " " <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    lines = [f"{k}: {_field(v)}" for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write `pages` (page_id, url, html) to `folder`; equal payloads of at least
    `min_bytes` are stored once. Returns the manifest, one row per archive."""
    archive = uuid.uuid4().hex
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = with_uid(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")),
                    ["page_id", "url", "html"]) \
        .select("uid", "page_id", "url", payload.alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "uid")
    shared = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest") \
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first.uid") \
        .withColumnRenamed("uid", "holder")
    known = rows.join(shared, "digest", "left").select("uid", "page_id", "url", "html", "digest", "holder")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, path = None, 0, f"{folder}/archive-{TaskContext.get().partitionId():07d}.warc.gz"
        for part in parts:
            for uid, page_id, url, html, digest, holder in zip(*(c.to_pylist() for c in part.columns)):
                if out is None:
                    out = AtomicFile(path)
                    out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(archive, uid, "info")),
                                      ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                data = html.encode()
                sha = base64.b32encode(bytes.fromhex(digest)).decode()
                own = record_id(archive, uid, "response")
                revisit = holder is not None and holder != uid
                host = (url or "").partition("://")[2].partition("/")
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode()
                common = [("WARC-Target-URI", url), ("WARC-Date", DATE)]
                out.write(record([("WARC-Type", "request"), ("WARC-Record-ID", record_id(archive, uid, "request")),
                                  ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/http; msgtype=request")],
                                 f"GET /{_field(host[2])} HTTP/1.1\r\nHost: {_field(host[0])}\r\n\r\n".encode()))
                out.write(record([("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own),
                                  ("WARC-Refers-To", record_id(archive, holder, "response") if revisit else None),
                                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
                                  *common, ("WARC-Payload-Digest", f"sha1:{sha}"),
                                  ("Content-Type", "application/http; msgtype=response")], http if revisit else http + data))
                out.write(record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(archive, uid, "metadata")),
                                  ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/warc-fields")],
                                 b"" if page_id is None else f"page-id: {page_id}\r\n".encode()))
                n += 3
        if out is not None:
            size = out.tell()
            out.commit()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return stage(known.mapInArrow(write, _MANIFEST), "warc-manifest")


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a decompressed archive."""
    while line := stream.readline():
        if line.strip():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            headers = _headers(stream)
            yield headers, stream.read(int(headers.get("content-length", 0)))


def describe(headers: dict[str, str], block: bytes) -> dict:
    """The _RECORD columns (and `payload`) of one record."""
    kind, fields, payload, size = headers.get("warc-type"), {}, None, None
    digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
    if kind == "metadata":
        pairs = (x.partition(":") for x in block.decode("utf-8", "replace").splitlines())
        fields = {k.strip(): v.strip() for k, sep, v in pairs if sep}
    elif kind in CAPTURES:
        head, sep, body = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
        if kind == "revisit":
            pairs = (x.partition(b":") for x in head.splitlines())
            size = next((int(v) for k, _, v in pairs if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
        else:
            payload, size = body, len(body)
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return {"record_id": headers.get("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
            "payload_bytes": size, "payload_digest": digest, "fields": list(fields.items()), "payload": payload}


def read_records(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives named by `manifest` (path); one task per
    archive at a time, one record in memory. `payloads` adds the payload bytes."""
    text = pa.string()
    schema = pa.schema([("record_id", text), ("type", text), ("concurrent_to", text), ("refers_to", text), ("target_uri", text),
                        ("date", text), ("payload_bytes", pa.int64()), ("payload_digest", text), ("fields", pa.map_(text, text))]
                       + [("payload", pa.binary())] * payloads)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path in part.column(0).to_pylist():
                fs, name = open_fs(path)
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for headers, block in parse_records(stream):
                        rows.append(describe(headers, block))
                        held += len(block) if payloads else 0
                        if len(rows) >= 5000 or held > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return manifest.select("path").repartition(max(1, manifest.count()), "path") \
        .mapInArrow(read, _RECORD + ", payload binary" * payloads)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture from a table of records: the capture's columns,
    `requests` and `metadata` (arrays of their records)."""
    captures = records.where(F.col("type").isin(*CAPTURES))
    others = records.where(F.col("type").isin("request", "metadata"))
    ids = captures.select(F.col("record_id").alias("capture"))
    links = others.where("concurrent_to IS NOT NULL").select(F.col("record_id").alias("id"), F.col("concurrent_to").alias("to"))
    direct = links.join(ids, links["to"] == ids["capture"]).select("id", "capture") \
        .unionByName(captures.where("concurrent_to IS NOT NULL").select(F.col("concurrent_to").alias("id"), F.col("record_id").alias("capture")))
    through = direct.select(F.col("id").alias("to"), "capture")
    attached = direct.unionByName(links.join(through, "to").select("id", "capture")).distinct()
    shown = [c for c in ("record_id", "type", "target_uri", "date", "fields")]
    joined = others.select(*shown).join(attached.withColumnRenamed("id", "record_id"), "record_id")
    one = F.struct(*shown)
    parts = joined.groupBy("capture").agg(  # a capture's own few records
        F.collect_list(F.when(F.col("type") == "request", one)).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", one)).alias("metadata"))
    return captures.drop("fields", "concurrent_to").join(parts.withColumnRenamed("capture", "record_id"), "record_id", "left")


def page_captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `pages`, read the archives back and assemble: per capture page_id,
    payload_bytes, payload_digest, record_type and refers_to (a page_id)."""
    spark = pages.sparkSession
    manifest = write_archives(pages, shared_folder(spark, "warc"), min_bytes)
    nested = assemble(stage(read_records(spark, manifest), "warc-records"))
    flat = nested.select("record_id", "type", "refers_to", "payload_bytes", "payload_digest",
                         F.col("metadata")[0]["fields"]["page-id"].cast("long").alias("page_id"))
    target = flat.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("holder"))
    return flat.join(target, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("holder").alias("refers_to"))
