"""Data source writers that show a job's files all at once: `df.write.format("wavequill_waves")` and `"wavequill_files"`.

Every task attempt writes into a folder of its own under `_staging-<job>`; a finished task reports its files. When all tasks
are done, the driver moves the reported files to their places and writes `_SUCCESS`; files of attempts that failed or were
repeated are never moved. When the job fails, the staging folder goes and nothing is visible. Files are reached through
pyarrow's file systems (local, HDFS, S3, ...), by the URI that is saved to. Existing files of the same names are replaced; the
mode `overwrite` first removes all others.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from wavequill.sources.sound import file_system


@dataclass
class Written(WriterCommitMessage):
    """(staged path, final path) of a task's files."""

    files: list[tuple[str, str]]


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.options, self.overwrite = dict(options), overwrite
        self.uri = self.options["path"]
        _, self.root = file_system(self.uri)
        self.staging = f"{self.root.rstrip('/')}/_staging-{uuid.uuid4().hex}"

    def _place(self, name: str) -> str:
        if name.startswith("/") or ".." in name.split("/"):
            raise ValueError(f"not a name below the folder: {name}")
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = file_system(self.uri)
        own = f"{self.staging}/{uuid.uuid4().hex}"
        system.create_dir(own, recursive=True)
        return Written([(staged, self._place(name)) for staged, name in self._files(system, own, iterator)])

    def _files(self, system: pafs.FileSystem, own: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
        """Writes files below `own`; (staged path, name) of each."""
        raise NotImplementedError

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = file_system(self.uri)
        moved = [f for m in messages if m is not None for f in m.files]
        names = [final for _, final in moved]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("two tasks wrote one file: rows of a file belong in one partition")
        if self.overwrite:
            for f in system.get_file_info(pafs.FileSelector(self.root, allow_not_found=True)):
                if f.path.rstrip("/") != self.staging.rstrip("/"):
                    (system.delete_file if f.is_file else system.delete_dir)(f.path)
        for folder in sorted({final.rsplit("/", 1)[0] for final in names}):
            system.create_dir(folder, recursive=True)
        for staged, final in moved:
            system.move(staged, final)
        system.delete_dir(self.staging)
        with system.open_output_stream(f"{self.root.rstrip('/')}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = file_system(self.uri)
        if system.get_file_info(self.staging).type == pafs.FileType.Directory:
            system.delete_dir(self.staging)


class FileWriter(StagedWriter):
    """Rows (path, content): a whole file each."""

    def _files(self, system, own, batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                staged = f"{own}/{uuid.uuid4().hex}"
                with system.open_output_stream(staged) as out:
                    out.write(content)
                yield staged, name


class WaveWriter(StagedWriter):
    """Rows (path, frames, start, left, right), sorted by path and start: blocks of 16-bit stereo files of `frames` samples. A
    file is streamed, so a task holds one batch of blocks. Holes are silence."""

    def _files(self, system, own, batches):
        rate = int(self.options.get("rate", "48000"))
        name = out = staged = None
        at = frames = 0

        def close() -> tuple[str, str]:
            if at > frames:
                raise ValueError(f"{name} has more than {frames} samples")
            out.write(bytes(4 * (frames - at)))
            out.close()
            return staged, name

        try:
            for batch in batches:
                rows = zip(batch.column("path").to_pylist(), batch.column("frames").to_pylist(), batch.column("start").to_pylist(), strict=True)
                for i, (path, n, start) in enumerate(rows):
                    if path != name:
                        if name is not None:
                            yield close()
                        name, frames, at, staged = path, n, 0, f"{own}/{uuid.uuid4().hex}"
                        out = system.open_output_stream(staged)
                        out.write(b"RIFF" + struct.pack("<I", 36 + 4 * n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, rate, 4 * rate, 4, 16) + b"data" + struct.pack("<I", 4 * n))
                    if start < at:
                        raise ValueError(f"blocks of {path} overlap or aren't in order")
                    x = np.stack([batch.column(s)[i].values.to_numpy(zero_copy_only=False).astype(float) for s in ("left", "right")], 1)
                    out.write(bytes(4 * (start - at)) + np.clip(np.rint(x * 32768), -32768, 32767).astype("<i2").tobytes())
                    at = start + len(x)
            if name is not None:
                yield close()
        finally:
            if out is not None and not out.closed:
                out.close()


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wavequill_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool):
        return FileWriter(self.options, overwrite)


class WaveSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wavequill_waves"

    def schema(self) -> str:
        return "path string, frames long, start long, left array<double>, right array<double>"

    def writer(self, schema, overwrite: bool):
        return WaveWriter(self.options, overwrite)


def registered(spark: SparkSession) -> None:
    for sink in (FileSink, WaveSink):
        spark.dataSource.register(sink)


def save_files(rows: DataFrame, root: str, overwrite: bool = False) -> None:
    """Rows (path, content) as files below `root`, all of them or none."""
    registered(rows.sparkSession)
    rows.select("path", F.col("content").cast("binary").alias("content")).write.format("wavequill_files").mode("overwrite" if overwrite else "append").save(root)


def save_waves(blocks: DataFrame, root: str, rate: int, overwrite: bool = False) -> None:
    """Blocks (path, start, left, right) as 16-bit stereo files below `root`, all of them or none. One task streams a file."""
    registered(blocks.sparkSession)
    frames = blocks.groupBy("path").agg(F.max(F.col("start") + F.size("left")).cast("long").alias("frames"))
    rows = blocks.join(frames, "path").select("path", "frames", F.col("start").cast("long").alias("start"), *[F.col(s).cast("array<double>").alias(s) for s in ("left", "right")])
    ordered = rows.repartition("path").sortWithinPartitions("path", "start")
    ordered.write.format("wavequill_waves").option("rate", rate).mode("overwrite" if overwrite else "append").save(root)
