"""FASTA as a Spark data source, plain or packed with gzip or xz.

Reading: spark.read.format("fasta").load(path), columns file, ord, id,
description, seq.  A file is planned as ranges of about `split_bytes` decoded
bytes: plain files by offset, xz files by the blocks of their index, gzip files
whole.  A record belongs to the range that holds the line end before its `>`, so
ranges need nothing of each other.  ord is the file's number and the record's
offset in the decoded file: the same however the file is split.

Writing: df.write.format("fasta") takes id and seq and writes one file per task;
option `by` names columns that become folders, one file per group and task.

Files are reached through Arrow's file systems, by URI or as local paths.
"""

from __future__ import annotations

import fnmatch
import glob
import gzip
import lzma
import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "file string, ord long, id string, description string, seq string"
_ARROW = pa.schema([("file", pa.string()), ("ord", pa.int64()), ("id", pa.string()), ("description", pa.string()), ("seq", pa.string())])

SPLIT_BYTES = 128 << 20
CHUNK = 4 << 20
#: ord = file number << OFFSET_BITS + offset.
OFFSET_BITS = 44
BLANKS = b" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def local_path(path: str) -> str:
    parts = urlsplit(path)
    return unquote(parts.path) if parts.scheme == "file" else path


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a URI or a local path."""
    if len(urlsplit(path).scheme) > 1 and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(local_path(path))


def list_files(path: str, pattern: str = "*") -> list[str]:
    """Sorted files of a path: a file, a folder with its subfolders (those that fit the pattern), or a glob of names."""
    store, at = file_system(path)
    if isinstance(store, pafs.LocalFileSystem):
        tops, head = sorted(glob.glob(at)), ""
    else:
        parts = urlsplit(path)
        folder, name = posixpath.split(at)
        tops = sorted(x.path for x in store.get_file_info(pafs.FileSelector(folder)) if fnmatch.fnmatch(x.base_name, name)) if glob.has_magic(name) else [at]
        head = path[: len(path) - len(parts.path)] if not at.startswith(parts.netloc + "/") else f"{parts.scheme}://"
    out = []
    for info in store.get_file_info(tops):
        inside = store.get_file_info(pafs.FileSelector(info.path, recursive=True)) if info.type == pafs.FileType.Directory else [info]
        for x in inside:
            under = x.path[len(info.path) :].split("/")
            if x.type == pafs.FileType.File and not any(p.startswith(("_", ".")) for p in under) and (len(inside) == 1 and x is info or fnmatch.fnmatch(x.base_name, pattern)):
                out.append(head + x.path)
    return sorted(out)


def kind_of(path: str, compression: str = "auto") -> str:
    return {".gz": "gzip", ".xz": "xz"}.get(os.path.splitext(path)[1], "none") if compression == "auto" else compression


# --- xz by its index ---------------------------------------------------------------------------------------------


@dataclass
class XzBlock:
    """A block of an xz file: where it lies, how long it is there, and its decoded offset and length; header is that of its stream."""

    header: bytes
    offset: int
    packed: int
    start: int
    length: int


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A variable-length number of the index, and the place behind it."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def xz_blocks(file: pa.NativeFile, size: int) -> list[XzBlock]:
    """All blocks of an xz file, read from the indexes at the ends of its streams."""

    def bytes_at(offset: int, n: int) -> bytes:
        file.seek(offset)
        return file.read(n)

    streams, end = [], size
    while end > 0:
        foot = bytes_at(end - 12, 12)
        if foot[-4:] == b"\0\0\0\0":  # padding between streams
            end -= 4
            continue
        if foot[-2:] != b"YZ":
            raise ValueError("not an xz file")
        n = (int.from_bytes(foot[4:8], "little") + 1) * 4
        index = bytes_at(end - 12 - n, n)
        count, at = _number(index, 1)
        sizes = []
        for _ in range(count):
            packed, at = _number(index, at)
            length, at = _number(index, at)
            sizes.append((packed + 3 & ~3, length))
        begin = end - 12 - n - sum(p for p, _ in sizes) - 12
        streams.append((begin, bytes_at(begin, 12), sizes))
        end = begin
    out, start = [], 0
    for begin, header, sizes in reversed(streams):
        at = begin + 12
        for packed, length in sizes:
            out.append(XzBlock(header, at, packed, start, length))
            at, start = at + packed, start + length
    return out


def _unpacked(file: pa.NativeFile, blocks: list[XzBlock]) -> Iterator[bytes]:
    for b in blocks:
        decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
        decoder.decompress(b.header)
        left, at = b.packed, b.offset
        while left or not decoder.needs_input:
            piece = b""
            if decoder.needs_input:
                file.seek(at)
                piece = file.read(min(left, CHUNK))
                if not piece:
                    raise EOFError("the xz file is cut short")
                at, left = at + len(piece), left - len(piece)
            out = decoder.decompress(piece, CHUNK)
            if out:
                yield out
            elif not left and not piece:
                break


# --- records -----------------------------------------------------------------------------------------------------


def records(chunks: Iterator[bytes], start: int = 0, end: int | None = None) -> Iterator[tuple[int, str, str, str]]:
    """(offset, id, description, sequence) of the records of the range; chunks: decoded bytes from start on, further than end as needed.

    The id is the header up to the first white space, sequence lines are joined;
    what stands before the first header belongs to no record.
    """
    chunks, buf, base = iter(chunks), bytearray(), start

    def more() -> bool:
        piece = next(chunks, None)
        if piece is not None:
            buf.extend(piece)
        return piece is not None

    def find(at: int) -> int:
        """Place of the next line end before a `>`, or -1."""
        while True:
            hit = buf.find(b"\n>", at)
            if hit >= 0:
                return hit
            at = max(at, len(buf) - 1)
            if not more():
                return -1

    while not buf and more():
        pass
    at = 0 if start == 0 and buf[:1] == b">" else find(0) + 1
    if not (start == 0 and at == 0 and buf[:1] == b">") and (at == 0 or end is not None and base + at - 1 >= end):
        return
    while True:
        stop = find(at)
        head, _, body = bytes(buf[at + 1 : stop if stop >= 0 else len(buf)]).partition(b"\n")
        head = head.decode("utf-8", "replace").strip("\r")
        yield base + at, (head.split(None, 1) or [""])[0], head, body.translate(None, BLANKS).decode("utf-8", "replace")
        if stop < 0 or end is not None and base + stop >= end:
            return
        at = stop + 1
        if at > CHUNK:
            del buf[:at]
            base, at = base + at, 0


@dataclass
class FastaRange(InputPartition):
    """Decoded bytes start to end (None: the file's end) of a file; blocks: of an xz file, from start to its end."""

    path: str
    number: int
    kind: str
    start: int = 0
    end: int | None = None
    blocks: list[XzBlock] = field(default_factory=list)

    def chunks(self) -> Iterator[bytes]:
        store, at = file_system(self.path)
        if self.kind == "none":
            with store.open_input_file(at) as f:
                f.seek(self.start)
                size = CHUNK if self.end is None else min(CHUNK, max(self.end - self.start, 1 << 16))
                while piece := f.read(size):
                    yield piece
        elif self.kind == "xz":
            with store.open_input_file(at) as f:
                yield from _unpacked(f, self.blocks)
        else:
            with store.open_input_stream(at, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
                while piece := f.read(CHUNK):
                    yield piece


def ranges(path: str, number: int, kind: str, split_bytes: int) -> list[FastaRange]:
    """The ranges of a file, none of them empty but that of an empty file."""
    store, at = file_system(path)
    if kind == "none":
        size = store.get_file_info(at).size
        cuts = list(range(0, size, split_bytes)) or [0]
        return [FastaRange(path, number, kind, a, b) for a, b in zip(cuts, [*cuts[1:], None])]
    if kind == "xz":
        with store.open_input_file(at) as f:
            blocks = xz_blocks(f, f.size())
        cuts, filled = [], split_bytes
        for i, b in enumerate(blocks):
            if filled >= split_bytes:
                cuts.append(i)
                filled = 0
            filled += b.length
        return [FastaRange(path, number, kind, blocks[a].start, blocks[b].start if b < len(blocks) else None, blocks[a:]) for a, b in zip(cuts, [*cuts[1:], len(blocks)])]
    return [FastaRange(path, number, kind)]


class FastaReader(DataSourceReader):
    def __init__(self, options):
        self.files = list_files(options["path"], options.get("pattern", "*"))
        self.compression = options.get("compression", "auto")
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        if not self.files:
            raise FileNotFoundError(options["path"])

    def partitions(self):
        return [r for i, f in enumerate(self.files) for r in ranges(f, i, kind_of(f, self.compression), self.split_bytes)]

    def read(self, part: FastaRange) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for offset, name, description, seq in records(part.chunks(), part.start, part.end):
            rows.append((part.path, (part.number << OFFSET_BITS) + offset, name, description, seq))
            size += len(seq) + len(description)
            if size > CHUNK or len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)


# --- writing -----------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class FastaWriter(DataSourceArrowWriter):
    """Files get their final names when the job is committed; until then, and where it fails, readers don't see them."""

    def __init__(self, options, schema, overwrite: bool):
        self.folder = options["path"]
        self.suffix = {"gzip": ".gz", "xz": ".xz"}.get(options.get("compression", "none"), "")
        self.width = int(options.get("width", "60"))
        self.by = [c for c in options.get("by", "").split(",") if c]
        self.overwrite = overwrite
        missing = {"id", "seq", *self.by} - set(schema.names)
        if missing:
            raise ValueError(f"columns {sorted(missing)} are missing")

    def _open(self, group: tuple):
        store, top = file_system(self.folder)
        folder = "/".join([top, *[f"{c}={quote(str(v), safe='')}" for c, v in zip(self.by, group)]])
        store.create_dir(folder, recursive=True)
        path = f"{folder}/_part-{uuid.uuid4().hex}.fasta{self.suffix}"
        raw = store.open_output_stream(path, compression=None)
        packed = gzip.GzipFile(fileobj=raw, mode="wb") if self.suffix == ".gz" else lzma.LZMAFile(raw, "wb") if self.suffix == ".xz" else raw
        return path, raw, packed

    def _text(self, name: str | None, seq: str | None) -> bytes:
        seq = seq or ""
        return (f">{name or ''}\n" + "".join(seq[i : i + self.width] + "\n" for i in range(0, len(seq), self.width))).encode("utf-8")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One file at a time: where the group changes a new one begins, so rows come sorted by group."""
        paths, now, out = [], None, None

        def close() -> None:
            if out is not None:
                out[2].close()
                if out[1] is not out[2]:
                    out[1].close()

        for batch in batches:
            groups = list(zip(*[batch.column(c).to_pylist() for c in self.by])) if self.by else [()] * batch.num_rows
            for group, name, seq in zip(groups, batch.column("id").to_pylist(), batch.column("seq").to_pylist()):
                if group != now or out is None:
                    close()
                    now, out = group, self._open(group)
                    paths.append(out[0])
                out[2].write(self._text(name, seq))
        close()
        return Written(paths)

    def commit(self, messages) -> None:
        store, _ = file_system(self.folder)
        old = [file_system(f)[1] for f in list_files(self.folder, "part-*")] if self.overwrite and store.get_file_info(file_system(self.folder)[1]).type == pafs.FileType.Directory else []
        for path in [p for m in messages if m is not None for p in m.paths]:
            folder, name = posixpath.split(path)
            store.move(path, f"{folder}/{name[1:]}")
        for path in old:
            store.delete_file(path)

    def abort(self, messages) -> None:
        store, _ = file_system(self.folder)
        for path in [p for m in messages if m is not None for p in m.paths]:
            if store.get_file_info(path).type == pafs.FileType.File:
                store.delete_file(path)


class FastaSource(DataSource):
    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FastaReader(self.options)

    def writer(self, schema, overwrite):
        return FastaWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastaSource)
