"""PNG media columns: a lossless writer and reader over zlib chunks, and cosine-transform hashes."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import utf8

_MAGIC = b"\x89PNG\r\n\x1a\n"
WIDTH = 64


class MediaError(ValueError):
    pass


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def payload_of(text: str | None, unit: int = WIDTH) -> tuple[bytes, int]:
    """UTF-8 of a text with zero bytes up to a positive multiple of unit, and its length before that."""
    raw = utf8(text)
    return raw + bytes(-len(raw) % unit if raw else unit), len(raw)


def encode_png(pixels: np.ndarray, level: int = 3, idat: int = 1 << 16) -> bytes:
    """An 8-bit grey PNG of a (height, width) uint8 array. Each row takes none, sub or up, whichever has the least sum of absolute values."""
    h, w = pixels.shape
    up = pixels - np.vstack((np.zeros((1, w), np.uint8), pixels[:-1]))
    sub = pixels.copy()
    sub[:, 1:] -= pixels[:, :-1]
    rows = np.stack((pixels, sub, up))
    cost = np.minimum(rows, -rows).sum(2, dtype=np.int64)
    kind = cost.argmin(0)
    out = np.empty((h, w + 1), np.uint8)
    out[:, 0] = kind
    out[:, 1:] = rows[kind, np.arange(h)]
    data = zlib.compress(out.tobytes(), level)
    parts = [_MAGIC, _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))]
    parts += [_chunk(b"IDAT", data[i : i + idat]) for i in range(0, len(data), idat)]
    return b"".join([*parts, _chunk(b"IEND", b"")])


def decode_png(media: bytes) -> np.ndarray:
    """The (height, width) samples of an 8-bit grey PNG without interlacing; MediaError on anything malformed."""
    if media[:8] != _MAGIC:
        raise MediaError("no PNG signature")
    at, idat, head = 8, [], None
    while True:
        if at + 12 > len(media):
            raise MediaError("chunks end early")
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        data = media[at + 8 : at + 8 + n]
        if media[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + data)):
            raise MediaError(f"checksum of {kind!r}")
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            idat.append(data)
        elif kind == b"IEND":
            break
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise MediaError("not 8-bit grey")
    w, h = head[:2]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8)
    except zlib.error as e:
        raise MediaError(str(e)) from e
    if len(raw) != h * (w + 1):
        raise MediaError("wrong amount of data")
    return unfilter(raw.reshape(h, w + 1))


def unfilter(raw: np.ndarray) -> np.ndarray:
    """Undoes row filters 0-4. Runs of rows with one filter go at once where the filter allows it."""
    kind, out = raw[:, 0], raw[:, 1:].copy()
    h, w = out.shape
    sub = kind == 1
    out[sub] = np.cumsum(out[sub], axis=1, dtype=np.uint8)
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if h else []
    for s, e in zip(edge, [*edge[1:], h], strict=True):
        if kind[s] == 2:
            s0 = max(s - 1, 0)
            out[s0:e] = np.cumsum(out[s0:e], axis=0, dtype=np.uint8)
        elif kind[s] in (3, 4):
            for y in range(s, e):
                above = out[y - 1].astype(int) if y else np.zeros(w, int)
                left = corner = 0
                for x in range(w):
                    b = int(above[x])
                    if kind[y] == 3:
                        guess = (left + b) // 2
                    else:
                        p = left + b - corner
                        pa_, pb, pc = abs(p - left), abs(p - b), abs(p - corner)
                        guess = left if pa_ <= pb and pa_ <= pc else b if pb <= pc else corner
                    left, corner = (int(out[y, x]) + guess) & 255, b
                    out[y, x] = left
        elif kind[s] > 4:
            raise MediaError(f"row filter {kind[s]}")
    return out


@lru_cache(maxsize=512)
def _basis(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(k), np.arange(n) + 0.5) / n).astype(np.float64)


def cosine_hash(pixels: np.ndarray, k: int = 8) -> str:
    """k*k low-frequency coefficients of the two-dimensional cosine transform against their median (the constant term left out of it), as hex."""
    h, w = pixels.shape
    total = np.zeros((k, k))
    rows = _basis(h, k) if h <= 4096 else None
    across = _basis(w, k).T
    for s in range(0, h, 4096):  # a tall image in strips
        e = min(h, s + 4096)
        down = rows if rows is not None else np.cos(np.pi * np.outer(np.arange(k), np.arange(s, e) + 0.5) / h)
        total += down @ (pixels[s:e].astype(np.float64) @ across)
    flat = np.round(total / (h * w), 9).ravel()
    return np.packbits(flat > np.median(flat[1:])).tobytes().hex()


def _mapped(df: DataFrame, schema: T.StructType, make) -> DataFrame:
    """Adds make(row values)'s columns batch by batch; make takes a dict of lists and gives one."""
    names = [f.name for f in schema.fields]
    full = T.StructType([f for f in df.schema.fields if f.name not in names] + schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                new = make(batch)
                kept = [f.name for f in batch.schema if f.name not in names]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *(new[n] for n in names)], names=[*kept, *names])

    return df.mapInArrow(run, full)


def to_media(docs: DataFrame, *, text_col: str = "text", level: int = 3) -> DataFrame:
    """docs plus n_bytes (long) and media (binary): the text's padded UTF-8 as rows of 64 grey samples.

    Null text is as empty text: 64 zero bytes. Columns of those names are replaced; extra columns pass through.
    """

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        media, sizes = [], []
        for t in batch.column(text_col).to_pylist():
            payload, n = payload_of(t)
            media.append(encode_png(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH), level))
            sizes.append(n)
        return {"n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(media, pa.binary())}

    return _mapped(docs, T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]), make)


def media_features(df: DataFrame, *, media_col: str = "media") -> DataFrame:
    """df without the media, plus what its stored bytes hold: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature and media_error.

    Null media give nulls; malformed media give media_error and nulls for what needs the samples.
    """
    fields = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()), ("media_error", T.StringType())]

    def one(media: bytes | None) -> list:
        if media is None:
            return [None] * 7
        stored = [len(media), hashlib.sha256(media).hexdigest()]
        try:
            pixels = decode_png(media)
        except MediaError as e:
            return [None, None, None, *stored, None, str(e)]
        payload = pixels.tobytes()
        return [len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *stored, cosine_hash(pixels), None]

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [one(m) for m in batch.column(media_col).to_pylist()]
        kinds = {"LongType()": pa.int64(), "StringType()": pa.string()}
        return {n: pa.array([r[i] for r in rows], kinds[str(k)]) for i, (n, k) in enumerate(fields)}

    return _mapped(df, T.StructType([T.StructField(n, k) for n, k in fields]), make).drop(media_col)
