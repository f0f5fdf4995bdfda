"""Operator 10, media columns: texts stored as WAV, read back, short-time Fourier transforms and spectral-peak pairs.

A text's UTF-8 bytes, filled up with zero bytes to a positive multiple of 64, are the 8-bit mono samples of a WAV file
that the `wave` module writes and reads. Frames of 256 samples, half overlapping, under a Hann window give magnitude
spectra; the two strongest local maxima of each frame are its peaks (of equal neighbours the first is one); each peak is paired with the peaks of the three following
frames. A pair is coded as (first bin, second bin, frames between) and stored with its time, the first frame's number.

Defined results: null and empty texts are 64 zero samples (no peak passes the floor, so no pair); repeated rows give
repeated rows; other columns are kept out; work and memory of a very long text grow in proportion, frames go in blocks.
"""

from __future__ import annotations

import hashlib
import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import with_columns_of

RATE, FRAME, HOP, PEAKS, AHEAD, UNIT = 8000, 256, 128, 2, 3, 64
#: A peak's magnitude at least; silence has none.
FLOOR = 1.0
BLOCK = 2048

MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, media binary, payload binary, times array<int>, codes array<int>, feature string"


def to_wav(payload: bytes) -> bytes:
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


def peaks(samples: np.ndarray) -> np.ndarray:
    """(frames, PEAKS) bins of the strongest magnitudes, strongest first, ties to the lower bin; -1 where under the floor."""
    n = max(1, -(-(len(samples) - FRAME) // HOP) + 1)
    x = np.zeros((n - 1) * HOP + FRAME, np.float32)
    x[: len(samples)] = samples
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    window, found = np.hanning(FRAME).astype(np.float32), []
    for i in range(0, n, BLOCK):
        block = frames[i : i + BLOCK]
        size = np.abs(np.fft.rfft((block - block.mean(axis=1, keepdims=True)) * window, axis=1)).astype(np.float32)
        size[:, 0] = 0
        # a maximum is over the bin before and no less than the one after
        low = np.ones(size.shape, bool)
        low[:, 1:-1] = (size[:, 1:-1] <= size[:, :-2]) | (size[:, 1:-1] < size[:, 2:])
        low[:, -1] = size[:, -1] <= size[:, -2]
        size[low] = 0
        best = np.empty((len(size), PEAKS), np.int32)
        for k in range(PEAKS):
            at = size.argmax(axis=1)
            rows = np.arange(len(size))
            best[:, k] = np.where(size[rows, at] >= FLOOR, at, -1)
            size[rows, at] = 0
        found.append(best)
    return np.concatenate(found)


def pairs(best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times and codes of all peak pairs, ordered by time, then code."""
    times, codes = [], []
    for gap in range(1, AHEAD + 1):
        a, b = best[:-gap], best[gap:]
        for i in range(PEAKS):
            for j in range(PEAKS):
                ok = np.flatnonzero((a[:, i] >= 0) & (b[:, j] >= 0)) if len(a) else np.zeros(0, int)
                times.append(ok)
                codes.append((a[ok, i] << 10) | (b[ok, j] << 2) | gap)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column("doc_id"), b.column("text").cast(pa.binary())
        for i in range(0, b.num_rows, 256):
            raw = [x or b"" for x in texts.slice(i, 256).to_pylist()]
            media = [to_wav(x + bytes(max(UNIT, -(-len(x) // UNIT) * UNIT) - len(x))) for x in raw]
            yield pa.RecordBatch.from_arrays([ids.slice(i, 256), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            payload = [from_wav(x) for x in part.column("media").to_pylist()]
            got = [pairs(peaks(np.frombuffer(x, np.uint8).astype(np.float32))) for x in payload]
            digest = [hashlib.blake2b(t.tobytes() + c.tobytes(), digest_size=16).hexdigest() for t, c in got]
            lists = [pa.array([x[k] for x in got], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(payload, pa.binary()), *lists, pa.array(digest)], ["doc_id", "n_bytes", "media", "payload", "times", "codes", "feature"])


def store_wav(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and the WAV file of each text."""
    return with_columns_of(docs, doc_id=id_col, text=text_col).mapInArrow(_store, MEDIA)


def fingerprint(media: DataFrame) -> DataFrame:
    """Reads the stored files back: payload, fingerprint times and codes, and a digest of both as `feature`."""
    return media.mapInArrow(_features, FEATURES)


def query(docs: DataFrame) -> DataFrame:
    f = fingerprint(store_wav(docs))
    return f.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -UNIT, UNIT)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "feature", F.size("codes").cast("long").alias("n_pairs"),
    )
