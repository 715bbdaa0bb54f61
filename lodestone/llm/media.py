"""Media columns: payloads stored as 8-bit mono WAV, and spectral-peak pair fingerprints.

A payload is written with the standard ``wave`` module, one sample per byte, so the
stored form is lossless.  The stored bytes are read back, cut into Hann-windowed
frames (short-time Fourier transform; zeros fill the last frame), the magnitude peaks that
exceed all their neighbours in time and frequency are kept, and each peak is paired with
the next ones of later frames (Wang 2003).  A pair is one 64-bit integer, with its time in the upper bits:
``time << 32 | f1 << 20 | f2 << 8 | dt``.  The query writes the media column as a table in the shared
folder, reads it back, and returns the array ``pairs`` and its digest ``feature``.

Memory: frames are transformed ``BLOCK`` at a time, with the neighbours' frames
overlapping, so a long payload needs its own bytes and one block.

Edge cases: null and empty texts are 64 zero bytes; a payload without peaks (silence)
has an empty fingerprint; equal payloads have equal media and fingerprints.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, materialize, table, text_or_empty

RATE = 8000
FRAME, HOP = 256, 128
#: Frames transformed at a time.
BLOCK = 2048
#: A peak exceeds all magnitudes within so many frames and bins.
NEAR_T, NEAR_F = 2, 4
#: Each peak is paired with so many later peaks, at most so many frames on.
FAN, REACH = 3, 63
UNIT = 64


def pad(payload: bytes) -> bytes:
    """Zero bytes up to a positive multiple of ``UNIT``."""
    return payload + bytes(-len(payload) % UNIT if payload else UNIT)


def to_wav(payload: bytes) -> bytes:
    """8-bit mono WAV file of the payload."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def _neighbourhood_max(m: np.ndarray) -> np.ndarray:
    """Maximum within NEAR_T frames and NEAR_F bins."""
    for axis, reach in ((1, NEAR_F), (0, NEAR_T)):
        out = m.copy()
        for k in range(1, reach + 1):
            if axis:
                np.maximum(out[:, k:], m[:, :-k], out=out[:, k:])
                np.maximum(out[:, :-k], m[:, k:], out=out[:, :-k])
            else:
                np.maximum(out[k:], m[:-k], out=out[k:])
                np.maximum(out[:-k], m[k:], out=out[:-k])
        m = out
    return m


def peaks(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the spectral peaks, by time and then frequency."""
    x = np.frombuffer(payload, dtype=np.uint8).astype(np.float32) - 128
    x = np.concatenate([x, np.zeros(FRAME - len(x) if len(x) < FRAME else -(len(x) - FRAME) % HOP, np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    times, bins = [], []
    for at in range(0, len(frames), BLOCK):
        lo, hi = max(0, at - NEAR_T), min(len(frames), at + BLOCK + NEAR_T)
        m = np.abs(np.fft.rfft(frames[lo:hi] * _WINDOW, axis=1)[:, 1:]).astype(np.float32)
        m = np.round(m, 3)
        t, f = np.nonzero((m >= _neighbourhood_max(m)) & (m > m.mean(axis=1, keepdims=True) * 2))
        inner = (t + lo >= at) & (t + lo < at + BLOCK)
        times.append(t[inner] + lo)
        bins.append(f[inner] + 1)
    return np.concatenate(times), np.concatenate(bins)


def fingerprint(payload: bytes) -> np.ndarray:
    """Time-coded peak pairs, ascending."""
    t, f = peaks(payload)
    codes = []
    later = np.searchsorted(t, t, side="right")
    for k in range(FAN):
        a = np.flatnonzero(later + k < len(t))
        b = later[a] + k
        dt = t[b] - t[a]
        codes.append((t[a] << 32 | f[a] << 20 | f[b] << 8 | dt)[dt <= REACH])
    return np.sort(np.concatenate(codes).astype(np.int64))


def store_media(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes (unpadded), media (WAV bytes of the padded payload)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "t"):
            payloads = b.column("t").cast(pa.binary()).to_pylist()
            n = pa.array([len(p) for p in payloads], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), n, pa.array([to_wav(pad(p)) for p in payloads], pa.binary())], ["id", "n_bytes", "media"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_column)


def media_features(media: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Read media back: payload size and checksums, and ``pairs``, the time-coded fingerprint array."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "media"):
            cols: dict[str, list] = {"payload_bytes": [], "payload_sha256": [], "tail_crc32": [], "media_bytes": [], "media_sha256": [], "pairs": []}
            for stored in b.column("media").to_pylist():
                payload = from_wav(stored)
                cols["payload_bytes"].append(len(payload))
                cols["payload_sha256"].append(hashlib.sha256(payload).hexdigest())
                cols["tail_crc32"].append(zlib.crc32(payload[-UNIT:]))
                cols["media_bytes"].append(len(stored))
                cols["media_sha256"].append(hashlib.sha256(stored).hexdigest())
                cols["pairs"].append(fingerprint(payload))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            made = [pa.array(v, k) for v, k in zip(cols.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), *made], ["id", "n_bytes", *cols])

    kind = media.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, pairs array<bigint>"
    return media.select(F.col(id_column).alias("id"), "n_bytes", "media").mapInArrow(run, schema).withColumnRenamed("id", id_column)


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media_features(materialize(store_media(table(spark, sf_dir, "documents")), "media"))
    digest = F.concat_ws(":", F.size("pairs").cast("string"), F.md5(F.array_join(F.transform("pairs", lambda p: p.cast("string")), ",")))
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", digest.alias("feature"), "pairs")
