"""WARC archives, index first.

Writing emits one index row per record (file, offset, length, URL, digest);
reading sorts the rows of the wanted records, coalesces neighbouring byte ranges
into larger reads and parses the records out of them.  Every record is a gzip
member of its own, so any range of whole records can be read alone.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch_path


@dataclass(frozen=True)
class WarcParams:
    """min_shared_bytes: smaller payloads are always responses.  max_file_bytes starts a new file.

    max_gap_bytes and max_read_bytes bound what one coalesced read skips and
    holds; a reading task gets about task_bytes at most.
    """

    min_shared_bytes: int = 100
    max_file_bytes: int = 1 << 30
    max_gap_bytes: int = 64 << 10
    max_read_bytes: int = 8 << 20
    task_bytes: int = 128 << 20
    level: int = 3


# --- storage -----------------------------------------------------------------------------------------------------


def _filesystem(uri: str):
    """(file system, path) of a URI; None for local paths and file URIs."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return None, unquote(parts.path) if parts.scheme else uri
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    files, path = _filesystem(uri)
    if files is not None:
        return files.open_output_stream(path)
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    return open(path, "wb")  # noqa: SIM115


def open_input(uri: str):
    files, path = _filesystem(uri)
    return files.open_input_file(path) if files is not None else open(path, "rb")  # noqa: SIM115


# --- records -----------------------------------------------------------------------------------------------------


def _urn(page_id) -> str:
    return "<urn:x-no-page:0>" if page_id is None else f"<urn:x-page:{quote(str(page_id))}>"


def _page(urn: str | None) -> str | None:
    return unquote(urn[len("<urn:x-page:") : -1]) if urn and urn.startswith("<urn:x-page:") else None


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "!#$%&'()*+,-./:;=?@[]_~"


def parse_record(data: bytes) -> dict:
    """Headers in lower case, record type, page and refers_to as texts, payload (None for revisits) and its length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record must end with two line breaks")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    return {"type": fields["warc-type"], "page": _page(fields["warc-record-id"]), "refers_to": _page(fields.get("warc-refers-to")), "digest": fields["warc-payload-digest"].removeprefix("sha256:"), "url": fields.get("warc-target-uri"), "payload_bytes": length, "payload": payload if fields["warc-type"] == "response" else None}


# --- writing -----------------------------------------------------------------------------------------------------


def _digested(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    data = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    return pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), data.alias("_data")).withColumn("_digest", F.sha2("_data", 256))


def revisits(pages: DataFrame, p: WarcParams, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(_id, _digest, refers_to) of the records that repeat a payload; only ids, digests and lengths are shuffled."""
    narrow = materialize(_digested(pages, id_col, url_col, payload_col).select("_id", "_digest", F.length("_data").alias("_n")).where(F.col("_n") >= p.min_shared_bytes), "digests")
    firsts = narrow.groupBy("_digest").agg(F.min("_id").alias("refers_to"), F.count("*").alias("_k")).where("_k > 1").drop("_k")
    return narrow.drop("_n").join(firsts, "_digest").where(F.col("refers_to").isNotNull() & ~F.col("_id").eqNullSafe(F.col("refers_to"))).distinct()


def write_warc(pages: DataFrame, folder: str | None = None, p: WarcParams = WarcParams(), id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row and return the index: id, url, path, offset, length, payload_bytes, digest, type.

    Of records with equal payloads of at least p.min_shared_bytes the one with
    the smallest id is the response; other ids, and rows without one, revisit it;
    where no row has an id, all are responses.  Null payloads are
    empty, null URLs have no target header, repeated rows of the smallest id are
    responses each, an empty table gives an empty index, and other columns
    aren't read.  A payload, however long, is in memory once with its record.  Each task attempt writes files of its own names and the index
    names only those of the attempts that counted, so lost executors and
    repeated tasks leave at most unused files.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    kind = pages.schema[id_col].dataType.simpleString()
    repeats = materialize(revisits(pages, p, id_col, url_col, payload_col), "revisits")
    # The table of revisits has a known size: Spark broadcasts it below its threshold and else sorts and merges.
    repeats = repeats.select(F.col("_id").alias("_again"), F.col("_digest").alias("_d"), "refers_to")
    again = F.col("_id").eqNullSafe(F.col("_again")) & (F.col("_digest") == F.col("_d"))
    rows = _digested(pages, id_col, url_col, payload_col).join(repeats, again, "left").select("_id", "_url", "_data", "_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem, number, out, path, at = f"{folder}/part-{task.partitionId():05d}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}", 0, None, "", 0
        for batch in batches:
            index = []
            for page, url, data, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= p.max_file_bytes:
                    if out is not None:
                        out.close()
                    path, at = f"{stem}-{number:03d}.warc.gz", 0
                    out, number = open_output(path), number + 1
                z = zlib.compressobj(p.level, zlib.DEFLATED, 31)
                member = z.compress(record_bytes(page, url, data, digest, refers, date)) + z.flush()
                out.write(member)
                index.append((page, url, path, at, len(member), len(data), digest, "response" if refers is None else "revisit"))
                at += len(member)
            cols = list(zip(*index)) or [[]] * 8
            types = [batch.schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["_id", "url", "path", "offset", "length", "payload_bytes", "digest", "type"])
        if out is not None:
            out.close()

    index = rows.mapInArrow(run, f"_id {kind}, url string, path string, offset long, length long, payload_bytes long, digest string, type string")
    return materialize(index, "warc-index").withColumnRenamed("_id", id_col)


# --- reading -----------------------------------------------------------------------------------------------------


def coalesce_ranges(rows: list[tuple[str, int, int]], p: WarcParams) -> list[tuple[str, int, int, list[int]]]:
    """(path, start, end, row numbers) of the reads that cover the sorted ranges (path, offset, length)."""
    reads: list[tuple[str, int, int, list[int]]] = []
    for i, (path, offset, length) in enumerate(rows):
        if reads:
            last, start, end, members = reads[-1]
            if path == last and offset - end <= p.max_gap_bytes and offset + length - start <= p.max_read_bytes:
                reads[-1] = (path, start, max(end, offset + length), [*members, i] if len(members) < 64 else members + [i])
                continue
        reads.append((path, offset, offset + length, [i]))
    return reads


def read_warc(index: DataFrame, p: WarcParams = WarcParams(), with_payload: bool = True) -> DataFrame:
    """The records of the index rows (any selection): page and refers_to as texts, type, url, digest, payload_bytes, payload.

    Rows are dealt by file and offset, so each task reads neighbouring ranges; a
    record without an id has a null page;
    a response whose payload doesn't have the digest of its header is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for path, start, end, members in coalesce_ranges(rows, p):
                with open_input(path) as f:
                    f.seek(start)
                    data = f.read(end - start)
                found = []
                for i in members:
                    a = rows[i][1] - start
                    r = parse_record(zlib.decompress(data[a : a + rows[i][2]], 31))
                    if r["payload"] is not None and hashlib.sha256(r["payload"]).hexdigest() != r["digest"]:
                        raise ValueError(f"payload of {r['page']} doesn't match its digest")
                    found.append((r["page"], r["refers_to"], r["type"], r["url"], r["digest"], r["payload_bytes"], r["payload"] if with_payload else None))
                cols = list(zip(*found))
                types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["page", "refers_to", "type", "url", "digest", "payload_bytes", "payload"])

    # Ranges are dealt by what is read, not by the size of the index.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(3 * index.sparkSession.sparkContext.defaultParallelism, -(-total // p.task_bytes))
    ranges = index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    return ranges.mapInArrow(run, "page string, refers_to string, type string, url string, digest string, payload_bytes long, payload binary")
