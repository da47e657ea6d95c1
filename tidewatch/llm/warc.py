"""WARC archives of pages, and a two-level capture index over them.

``write_archives`` writes one gzip member per record: the first page of each payload as a response, the others as revisits of it.
``build_index`` sorts the captures by reversed-host key, packs them into compressed blocks and keeps a sparse directory: for
each sorted range the first key of every block. ``lookup`` finds the range of a key among the first keys of the ranges (one a
partition), the block by binary search in the directory of that range, the capture by binary search in the block, and reads the
record as a byte range. ``read_captures`` goes through all blocks and range-reads every record.

Archives lie in the shared folder and are reached through ``pyarrow.fs``, so the folder may be a local mount or an object
store. An attempt of a task writes a file of its own name, and only rows of successful attempts name files, so lost executors and
repeated attempts do no harm.

Defined results: null html is an empty payload, a null url an empty key. A response is the smallest page_id of its payload (a
null page_id comes after all others); equal page ids give a record each.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices
from tidewatch.session import materialize, shared_dir

BLOCK_CAPTURES = 3000
RECORD_DATE = "2026-01-01T00:00:00Z"
CAPTURE = "_key string, page_id long, url string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string"


def host_key(url: str | None) -> str:
    """``https://www.a.org/x?y`` as ``org,a,www)/x?y``: captures of a domain and its subdomains are neighbours."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:  # not a url
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){rest}"


def _header(fields: list[tuple[str, str]]) -> bytes:
    clean = (f"{k}: {' '.join(v.split())}" for k, v in fields)
    return ("WARC/1.1\r\n" + "\r\n".join(clean) + "\r\n\r\n").encode()


def _record(url: str | None, page_id: int | None, kind: str, refers_to: int | None, payload: bytes, digest: str, number: str) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", RECORD_DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return gzip.compress(_header(fields) + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> dict:
    """The fields of one record; payload is None for a revisit."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {
        "page_id": int(page) if page else None, "url": fields.get("WARC-Target-URI"), "record_type": kind, "refers_to": int(refers) if refers else None,
        "payload_bytes": size, "payload_digest": digest, "payload": body.decode() if kind == "response" else None,
    }


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _file_system(folder)
        out = name = None
        offset = 0
        try:
            for batch, texts in slices(batches, "_html"):
                rows = []
                for row, html in zip(batch.drop_columns(["_html"]).to_pylist(), texts, strict=True):
                    if out is None:
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(posixpath.join(path, name), compression=None)
                    payload = (html or "").encode()
                    record = _record(row["url"], row["page_id"], row["_type"], row["_refers"], payload, row["_digest"], str(uuid.uuid4()))
                    out.write(record)
                    rows.append({"_key": host_key(row["url"]), "page_id": row["page_id"], "url": row["url"], "record_type": row["_type"], "refers_to": row["_refers"], "file": name, "offset": offset, "length": len(record)})
                    offset += len(record)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=CAPTURE_TYPE)
        finally:
            if out is not None:
                out.close()

    return run


CAPTURE_TYPE = pa.schema(
    [("_key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
RECORD_TYPE = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string())]
)


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 100) -> DataFrame:
    """Write the records of ``pages`` (page_id, url, html) into ``folder``; one row per record with its place."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("_html")).withColumn("_digest", F.sha2("_html", 256))
    store, path = _file_system(folder)
    store.create_dir(path, recursive=True)
    first = (
        rows.where(F.octet_length("_html") >= min_revisit_bytes).groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest", "_first")
    )
    known = rows.join(first, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    placed = known.select(
        "page_id", "url", "_html", "_digest", F.when(revisit, "revisit").otherwise("response").alias("_type"), F.when(revisit, F.col("_first")).alias("_refers")
    )
    return materialize(placed.mapInArrow(_write(folder), CAPTURE), "captures")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted captures of a partition, and last its row of the directory."""
    part = uuid.uuid4().hex
    keys: list[str] = []
    pending: list[dict] = []

    def block() -> pa.RecordBatch:
        keys.append(pending[0]["_key"])
        data = zlib.compress("\n".join(json.dumps(x) for x in pending).encode(), 6)
        return pa.RecordBatch.from_pylist([{"part": part, "block": len(keys) - 1, "first_key": pending[0]["_key"], "data": data, "directory": None}], schema=BLOCK_TYPE)

    for batch in batches:
        for row in batch.to_pylist():
            pending.append(row)
            if len(pending) == BLOCK_CAPTURES:
                yield block()
                pending = []
    if pending:
        yield block()
    if keys:
        yield pa.RecordBatch.from_pylist([{"part": part, "block": None, "first_key": keys[0], "data": None, "directory": keys}], schema=BLOCK_TYPE)


BLOCK_TYPE = pa.schema([("part", pa.string()), ("block", pa.int32()), ("first_key", pa.string()), ("data", pa.binary()), ("directory", pa.list_(pa.string()))])


def build_index(captures: DataFrame) -> DataFrame:
    """Rows of blocks (``data``) and of the sparse directory (``directory``, one a range)."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "_key", F.xxhash64("page_id", "file", "offset")).sortWithinPartitions("_key", "page_id", "file", "offset")
    return materialize(ordered.mapInArrow(_pack, "part string, block int, first_key string, data binary, directory array<string>"), "index")


def _captures_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            yield pa.RecordBatch.from_pylist([json.loads(x) for x in zlib.decompress(data).decode().split("\n")], schema=CAPTURE_TYPE)


def _range_reads(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _file_system(folder)
        name, source = None, None
        try:
            for batch in batches:
                out, size = [], 0
                for row in batch.select(["file", "offset", "length"]).to_pylist():
                    if row["file"] != name:
                        if source:
                            source.close()
                        name, source = row["file"], store.open_input_file(posixpath.join(path, row["file"]))
                    source.seek(row["offset"])
                    out.append(parse_record(source.read(row["length"])))
                    size += out[-1]["payload_bytes"]
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema=RECORD_TYPE)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=RECORD_TYPE)
        finally:
            if source:
                source.close()

    return run


def read_captures(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Every record of the archives, by the places in the index; digests are checked on reading."""
    captures = index.where("data IS NOT NULL").select("data").mapInArrow(_captures_of, CAPTURE)
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    records = near.mapInArrow(_range_reads(folder), RECORD)
    return records if payload else records.drop("payload")


def lookup(index: DataFrame, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of the captures of ``urls``; equal and null urls are asked once."""
    spark = index.sparkSession
    parts = index.where("directory IS NOT NULL").select("part", "first_key").orderBy("first_key", "part").collect()  # one row a partition of the index
    firsts, names = [r["first_key"] for r in parts], [r["part"] for r in parts]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column(0).to_pylist():
                key = host_key(url)
                # a key may begin in any of the ranges with the last first key before it, and go over into those that begin with it
                low, high = bisect.bisect_left(firsts, key), bisect.bisect_right(firsts, key)
                low = bisect.bisect_left(firsts, firsts[low - 1]) if low else 0
                rows += [{"part": names[k], "_asked": key} for k in range(low, high)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.string()), ("_asked", pa.string())]))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                firsts, key = row["directory"], row["_asked"]
                low, high = max(bisect.bisect_left(firsts, key) - 1, 0), bisect.bisect_right(firsts, key)
                rows += [{"part": row["part"], "block": k, "_asked": key} for k in range(low, high)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.string()), ("block", pa.int32()), ("_asked", pa.string())]))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = [json.loads(x) for x in zlib.decompress(row["data"]).decode().split("\n")]
                keys = [x["_key"] for x in own]
                yield pa.RecordBatch.from_pylist(own[bisect.bisect_left(keys, row["_asked"]) : bisect.bisect_right(keys, row["_asked"])], schema=CAPTURE_TYPE)

    asked = urls.select(url_col).distinct().mapInArrow(ranges, "part string, _asked string").distinct()
    directory = index.where("directory IS NOT NULL").select("part", "directory")
    wanted = asked.join(directory, "part").mapInArrow(blocks, "part string, block int, _asked string")
    found = wanted.join(index.where("data IS NOT NULL").select("part", "block", "data"), ["part", "block"]).mapInArrow(entries, CAPTURE)
    parts_n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = found.select("file", "offset", "length").repartitionByRange(parts_n, "file", "offset").sortWithinPartitions("file", "offset")
    return near.mapInArrow(_range_reads(folder), RECORD)


def archive_folder(pages: DataFrame) -> str:
    spark = pages.sparkSession
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
