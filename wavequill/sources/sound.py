"""A data source of wave files that reads headers and byte ranges: `spark.read.format("wavequill_sound").load(folder)`.

Planning lists files and cuts them by size; a task reads the header of its files (a few dozen bytes each) and of the samples
only those its blocks are made of. So a duration costs a header, a slice costs its own bytes, and a long file is read by
many tasks. Options:

* content: `blocks` (one row a second of sound, the default) or `headers` (one row a file)
* rate: of the blocks; other rates are resampled from the samples around
* start, stop: seconds; only blocks in between are read, and cut there
* pattern: of file names (`*.wav`)
* split_mb, pushdown: bytes of a task's part; `true` also takes comparisons of `start_sample` from the query's filters, where
  spark.sql.python.filterPushdown.enabled is set

Files are reached through pyarrow's file systems (local, HDFS, S3, ...), by their URI. 8 to 32 bits of plain samples are
read; any other file is one row of nulls beside its path and error. A folder that doesn't exist is an empty table.
"""

from __future__ import annotations

import fnmatch
import math
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

BLOCKS = "path string, block_no int, start_sample long, left array<float>, right array<float>, bytes_read long, error string"
HEADERS = "path string, seconds double, rate int, channels int, bits int, frames long, bytes_read long, error string"


class Unreadable(ValueError):
    pass


@dataclass(frozen=True)
class Header:
    rate: int
    channels: int
    width: int
    frames: int
    offset: int


class Counted:
    """A file that counts the bytes that are read of it."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.read_bytes = file, file.size(), 0

    def at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        found = self.file.read(n)
        self.read_bytes += len(found)
        return found


def header_of(file: Counted) -> Header:
    """Chunk by chunk, without what lies in them."""
    if file.at(0, 12)[:4] != b"RIFF":
        raise Unreadable("no RIFF file")
    at, form = 12, None
    while True:
        chunk = file.at(at, 8)
        if len(chunk) < 8:
            raise Unreadable("no samples")
        name, size = chunk[:4], struct.unpack("<I", chunk[4:])[0]
        if name == b"fmt ":
            form = struct.unpack("<HHIIHH", file.at(at + 8, 16).ljust(16, b"\0"))
            if form[0] not in (1, 0xFFFE) or form[5] not in (8, 16, 24, 32) or not form[1] or not form[2]:
                raise Unreadable(f"format {form[0]} with {form[5]} bits")
        elif name == b"data":
            if not form:
                raise Unreadable("samples before their format")
            size = min(size, file.size - at - 8)  # a file that was cut short
            return Header(form[2], form[1], form[5] // 8, size // (form[1] * form[5] // 8), at + 8)
        at += 8 + size + size % 2


def decoded(raw: bytes, width: int, channels: int) -> np.ndarray:
    """Samples in [-1, 1), one column a channel."""
    data = np.frombuffer(raw, np.uint8)
    if width == 1:
        return ((data.astype(np.float32) - 128) / 128).reshape(-1, channels)
    wide = np.zeros((len(data) // width, 4), np.uint8)
    wide[:, 4 - width :] = data.reshape(-1, width)  # the upper bytes of a 32-bit number
    return (wide.view("<i4")[:, 0] / 2**31).astype(np.float32).reshape(-1, channels)


def resampled_part(read: Callable[[int, int], np.ndarray], old: int, new: int, first: int, stop: int, half: int = 24) -> np.ndarray:
    """The samples from `first` up to `stop` at the new rate, by a windowed sinc that cuts what the lower rate can't hold.
    read(a, b): the samples a to b at the old rate, zeros beyond the ends."""
    if old == new or stop <= first:
        return read(first, max(first, stop))
    cut = min(1.0, new / old)
    reach = math.ceil(half / cut)
    k, parts = np.arange(-reach, reach + 1), []
    for a in range(first, stop, 8192):
        j = np.arange(a, min(stop, a + 8192), dtype=np.int64) * old
        whole, rest = j // new, j % new / new
        at = (k - rest[:, None]) * cut
        weight = np.sinc(at) * np.cos(np.pi * np.clip(at / (2 * half + 2), -0.5, 0.5)) ** 2
        weight /= weight.sum(1, keepdims=True)
        low = int(whole[0]) - reach
        x = read(low, int(whole[-1]) + reach + 1).astype(np.float64)
        parts.append(np.einsum("jk,jkc->jc", weight, x[whole[:, None] + k - low]).astype(np.float32))
    return np.concatenate(parts)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class Part(InputPartition):
    """Some files, or one part of several of one file: (path, part, parts)."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class SoundReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.headers = options.get("content", "blocks") == "headers"
        self.pattern = options.get("pattern", "*.wav")
        self.split = int(float(options.get("split_mb", "64")) * (1 << 20))
        self.rate = int(options.get("rate", "48000"))
        self.first = math.floor(float(options.get("start", "0")) * self.rate)
        stop = options.get("stop")
        self.stop = None if stop is None else math.floor(float(stop) * self.rate)
        #: blocks outside are left out, those at the ends stay whole
        self.low, self.high = 0, None

    def partitions(self) -> Sequence[InputPartition]:
        system, root = file_system(self.uri)
        info = system.get_file_info(root)
        if info.type == pafs.FileType.NotFound:
            return [Part([])]
        found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(root, recursive=True))
        parts, held, size = [], [], 0
        for f in sorted((f for f in found if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern)), key=lambda f: f.path):
            n = 1 if self.headers else max(1, -(-f.size // self.split))
            if n > 1:
                parts += [Part([(f.path, k, n)]) for k in range(n)]
                continue
            held.append((f.path, 0, 1))
            size += 1 << 12 if self.headers else f.size  # opening a file is worth some bytes
            if size >= self.split:
                parts.append(Part(held))
                held, size = [], 0
        return [*parts, Part(held)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.uri)
        prefix = self.uri.split("://", 1)[0] + "://" if "://" in self.uri else "file:" if self.uri.startswith("file:") else ""
        for path, part, parts in partition.files:
            name = path if not prefix or "://" in path else prefix + path
            try:
                with system.open_input_file(path) as opened:
                    file = Counted(opened)
                    yield from self._rows(name, file, header_of(file), part, parts)
            except (Unreadable, OSError, struct.error) as e:
                if part == 0:
                    yield self._row(name, None, 0, str(e) or type(e).__name__)

    def _row(self, name: str, found: tuple | None, count: int, error: str | None = None) -> pa.RecordBatch:
        schema = pa.schema([("path", pa.string()), ("seconds", pa.float64()), ("rate", pa.int32()), ("channels", pa.int32()), ("bits", pa.int32()), ("frames", pa.int64())]) if self.headers else pa.schema([("path", pa.string()), ("block_no", pa.int32()), ("start_sample", pa.int64()), ("left", pa.list_(pa.float32())), ("right", pa.list_(pa.float32()))])
        schema = schema.append(pa.field("bytes_read", pa.int64())).append(pa.field("error", pa.string()))
        values = [name, *(found or [None] * (len(schema) - 3)), count, error]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    def _rows(self, name: str, file: Counted, head: Header, part: int, parts: int) -> Iterator[pa.RecordBatch]:
        if self.headers:
            yield self._row(name, (head.frames / head.rate, head.rate, head.channels, head.width * 8, head.frames), file.read_bytes)
            return
        frame = head.width * head.channels

        def samples(a: int, b: int) -> np.ndarray:
            low, high = min(max(a, 0), head.frames), min(max(b, 0), head.frames)
            x = decoded(file.at(head.offset + low * frame, (high - low) * frame), head.width, head.channels)
            return np.pad(x[:, [0, min(1, head.channels - 1)]], ((low - a if a < low else 0, b - high if b > high else 0), (0, 0)))

        total = -(-head.frames * self.rate // head.rate)
        stop = total if self.stop is None else min(total, self.stop)
        blocks = -(-total // self.rate)
        for k in range(part * blocks // parts, (part + 1) * blocks // parts):
            begin, end = max(k * self.rate, self.first), min((k + 1) * self.rate, stop)
            if begin >= end or begin < self.low or (self.high is not None and begin > self.high):
                continue
            before = file.read_bytes
            x = resampled_part(samples, head.rate, self.rate, begin, end)
            yield self._row(name, (k, begin, x[:, 0], x[:, 1]), file.read_bytes - before)


class PushingReader(SoundReader):
    """Also leaves out blocks that a comparison of `start_sample` leaves out."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("start_sample",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif getattr(f, "attribute", None) == ("start_sample",) and isinstance(f, (LessThan, LessThanOrEqual)):
                top = f.value - isinstance(f, LessThan)
                self.high = top if self.high is None else min(self.high, top)
            else:
                yield f


class SoundSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wavequill_sound"

    def schema(self) -> str:
        return HEADERS if self.options.get("content") == "headers" else BLOCKS

    def reader(self, schema) -> DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else SoundReader)(dict(self.options))


def sound(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The table of the sound files below `path`, with the source's options."""
    spark.dataSource.register(SoundSource)
    given = {k: str(v) for k, v in options.items() if v is not None}
    return spark.read.format(SoundSource.name()).options(**given).load(path)
