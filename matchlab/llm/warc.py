"""WARC archives with an index first: one record per page, written per task, indexed by file, offset, length, URL and
digest, and read back by coalesced byte ranges in file order.

Of records with equal payloads of at least `min_bytes`, the one with the largest page_id is the response and the others
revisit it. Records are gzip members, so any of them can be read alone.

Edge cases: null html is an empty payload; a null page_id is smaller than any other; rows that repeat the largest
page_id with the same payload are all responses; a null url is written as an empty one; an empty table gives no files;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, scratch, staged, text_chunks

INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string())])
FIXED_DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, page_id, url: str, payload: bytes, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {FIXED_DATE}",
        "WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"), f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields, HTTP head, payload) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def with_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to (null for a response)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload", F.sha1("html"))
    # ids and hashes meet by payload; bodies move by page, so a payload of a third of the rows is no hot key of theirs
    pairs = rows.select("page_id", "payload").distinct()
    best = pairs.groupBy("payload").agg(F.max("page_id").alias("best"))
    pairs = pairs.join(best, "payload").select(F.col("page_id").alias("of_page"), F.col("payload").alias("of_payload"), "best")
    rows = rows.join(pairs, rows["page_id"].eqNullSafe(pairs["of_page"]) & (rows["payload"] == pairs["of_payload"]))
    other = F.coalesce(F.col("page_id") < F.col("best"), F.col("page_id").isNull() & F.col("best").isNotNull()) & (F.octet_length("html") >= min_bytes)
    return rows.select("page_id", "url", "html", F.when(other, F.col("best")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write the archives below `path`; returns their index. A file's name carries the attempt that wrote it."""

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        out, name, at = None, "", 0
        for b, texts in text_chunks(batches, column="html"):
            rows = []
            for page_id, url, refers, payload in zip(*(column(b, c).to_pylist() for c in ("page_id", "url", "refers_to")), texts):
                kind = "response" if refers is None else "revisit"
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out = fs.open_output_stream(name, compression=None)
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = z.compress(_record(kind, page_id, url, payload, refers)) + z.flush()
                out.write(data)
                rows.append({"file": name, "offset": at, "length": len(data), "page_id": page_id, "url": url, "payload_digest": digest(payload), "record_type": kind})
                at += len(data)
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
        if out is not None:
            out.close()

    return staged(with_types(pages, min_bytes).mapInArrow(write, INDEX), "op3-index")


def read_records(index: DataFrame, path: str, gap: int = 64 * 1024, most: int = 8 << 20) -> DataFrame:
    """Read the records that the index rows name. Rows are ordered by file and offset; neighbouring ranges with holes
    of at most `gap` bytes become one read of at most `most` bytes (a longer record is read alone)."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(uri: str):
        x = uri.strip("<>").rsplit(":", 1)[1]
        return None if x == "null" else int(x)

    def fetch(batches):
        fs, _ = pafs.FileSystem.from_uri(path)
        for b in batches:
            runs, last = [], None
            for f, o, k in zip(*(column(b, c).to_pylist() for c in ("file", "offset", "length"))):
                if last and last[0] == f and o - last[2] <= gap and o + k - last[1] <= most:
                    last[2] = max(last[2], o + k)
                    last[3].append((o, k))
                else:
                    last = [f, o, o + k, [(o, k)]]
                    runs.append(last)
            for f, lo, hi, wanted in runs:
                with fs.open_input_file(f) as src:
                    data = src.read_at(hi - lo, lo)
                out = []
                for o, k in wanted:
                    fields, http, payload = parse(zlib.decompress(data[o - lo : o - lo + k], 31))
                    sha = fields["WARC-Payload-Digest"].split(":", 1)[1]
                    if fields["WARC-Type"] == "response" and digest(payload) != sha:
                        raise ValueError(f"damaged record at {f}:{o}")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                    refers = fields.get("WARC-Refers-To")
                    out.append({"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": sha, "record_type": fields["WARC-Type"], "refers_to": refers and number(refers)})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    path = scratch(pages.sparkSession, "op3-files")
    return read_records(write_archives(pages, path, min_bytes), path)
