"""Media columns: payloads stored as lossless WebP images in a binary column, read back as pixel arrays.

`as_media` stores a payload column, `pixel_arrays` decodes a media column into arrays, `media_features` reads a
media column of payloads back and describes it. Bytes travel in Arrow batches; nothing is gathered.

Null payloads count as empty and are stored as 64 zero bytes. A payload may have 1 GiB. Images that cannot be
decoded raise an error in `media_features` and give null pixels in `pixel_arrays`. Rows repeat as in the input and
equal payloads give equal files; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.llm.webp_lossless import decode_batch, store_payloads

#: bytes of payloads that are coded, and of images that are decoded, at a time
STORED, LOADED = 3 << 20, 8 << 20


def padded(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")


def _chunks(sizes: list[int], most: int) -> Iterator[slice]:
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield slice(begin, i)
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def as_media(rows: DataFrame, payload: Column, keep: list[str]) -> DataFrame:
    """`keep`, n_bytes of the payload and media, the WebP file."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x or b"" for x in batch.column("payload").to_pylist()]
            for part in _chunks([len(x) for x in data], STORED):
                own = data[part]
                kept = [batch.column(k).slice(part.start, len(own)) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([len(x) for x in own], pa.int64()), pa.array(store_payloads([padded(x) for x in own]), pa.binary())], names=[*keep, "n_bytes", "media"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    slim = rows.select(*[F.col(k) for k in keep], payload.cast("binary").alias("payload"))
    return slim.mapInArrow(store, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n_bytes long, media binary")


def media_features(stored: DataFrame, keep: list[str]) -> DataFrame:
    """Reads payload images back: `keep`, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature (image size, mean, entropy and share of zero of the payload's bytes)."""
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def describe(n: int, media: bytes, pixels: np.ndarray) -> tuple:
        size = max(64, -(-n // 64) * 64)
        own = pixels.astype("<u4").tobytes()[:size]
        share = np.bincount(np.frombuffer(own, np.uint8), minlength=256) / size
        used = share[share > 0]
        entropy = abs(float(-(used * np.log2(used)).sum()))
        feature = f"{pixels.shape[1]}x{pixels.shape[0]};mean={share @ np.arange(256):.3f};entropy={entropy:.3f};zero={share[0]:.4f}"
        return n, size, hashlib.sha256(own).hexdigest(), zlib.crc32(own[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media, n = batch.column("media").to_pylist(), batch.column("n_bytes").to_pylist()
            for part in _chunks([len(x) for x in media], LOADED):
                rows = [describe(*x) for x in zip(n[part], media[part], decode_batch(media[part]), strict=True)]
                kept = [batch.column(k).slice(part.start, len(rows)) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=[*keep, *names])

    kinds = {f.name: f.dataType.simpleString() for f in stored.schema}
    return stored.mapInArrow(load, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def pixel_arrays(images: DataFrame, media_col: str, keep: list[str]) -> DataFrame:
    """`keep`, height, width and argb (one unsigned 32-bit number a pixel, row by row); nulls for what is no lossless WebP."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for m in batch.column("media").to_pylist():
                try:
                    found += decode_batch([m])
                except (ValueError, TypeError, IndexError):
                    found.append(None)
            arrays = [pa.array([None if p is None else p.shape[k] for p in found], pa.int32()) for k in (0, 1)]
            argb = pa.array([None if p is None else p.ravel().astype(np.int64) for p in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *arrays, argb], names=[*keep, "height", "width", "argb"])

    kinds = {f.name: f.dataType.simpleString() for f in images.schema}
    slim = images.select(*[F.col(k) for k in keep], F.col(media_col).alias("media"))
    return slim.mapInArrow(load, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", height int, width int, argb array<long>")
