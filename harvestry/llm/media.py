"""Media columns: WAV bytes, short-time Fourier transforms and spectral-peak pair fingerprints.

A payload is stored as 8-bit mono samples in a WAV made and read by the standard library's wave module. Peaks of the
spectrogram are local maxima over time and frequency; each peak is paired with the next ones in its target zone, and a pair is
stored as one long: time of the first peak, both frequencies and the time between them.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import map_batches

RATE, FRAME, HOP, ZONE, FANOUT = 8000, 256, 128, 16, 3
CHUNK_FRAMES = 2048
UNIT, PAD = 576, 255
_WINDOW = np.hanning(FRAME).astype(np.float32)


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes of the text (null: none), then bytes 255 up to a positive multiple of 576."""
    raw = (text or "").encode()
    return raw + bytes([PAD]) * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


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
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono is expected")
        return w.readframes(w.getnframes())


def spectrogram(samples: np.ndarray, first: int, last: int) -> np.ndarray:
    """Magnitudes of frames first..last-1, without the constant bin."""
    part = samples[first * HOP : (last - 1) * HOP + FRAME].astype(np.float32) - np.float32(128)
    frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
    return np.abs(np.fft.rfft(frames * _WINDOW, axis=1))[:, 1:].astype(np.float32)


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times and frequencies of the local maxima that stand out of their frame, by time and then frequency.

    Long inputs go through in chunks that overlap by a frame on either side, so memory doesn't grow with the length.
    """
    count = max(0, (len(samples) - FRAME) // HOP + 1)
    times, bins = [], []
    for a in range(0, count, CHUNK_FRAMES):
        b = min(count, a + CHUNK_FRAMES)
        lo, hi = max(0, a - 1), min(count, b + 1)
        s = spectrogram(samples, lo, hi)
        s = np.pad(s, ((int(lo == a), int(hi == b)), (1, 1)), constant_values=-1)
        mid = s[1:-1, 1:-1]
        high = mid > 2.5 * mid.mean(axis=1, keepdims=True)
        high &= (mid > s[1:-1, :-2]) & (mid >= s[1:-1, 2:]) & (mid > s[:-2, 1:-1]) & (mid >= s[2:, 1:-1])
        t, f = np.nonzero(high)
        times.append(t + a)
        bins.append(f)
    return (np.concatenate(times), np.concatenate(bins)) if times else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """Time-coded hashes of peak pairs, ascending: time << 20 | f1 << 12 | f2 << 4 | (dt - 1), for the next peaks up to 16 frames on."""
    t, f = peaks(samples)
    t, f = t.astype(np.int64), f.astype(np.int64)
    nxt = np.searchsorted(t, t, "right")
    out = []
    for k in range(FANOUT):
        j = nxt + k
        i = np.flatnonzero(j < len(t))
        j = j[i]
        dt = t[j] - t[i]
        near = dt <= ZONE
        i, j, dt = i[near], j[near], dt[near]
        out.append(t[i] << 20 | f[i] << 12 | f[j] << 4 | (dt - 1))
    return np.sort(np.concatenate(out))


MEDIA_COLUMNS = "n_bytes long, media binary, payload_sha256 string, tail_crc32 long, payload_bytes long, peaks_hash array<long>"


def with_media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the media columns of each text: the WAV, digests of what was read back from it, and the fingerprint.

    Other columns of df are left out, so none can clash; rows that repeat give rows that repeat, null keys included; an empty table gives an empty one. A null text counts as empty; its payload is 576 bytes of 255, which is constant and has no peaks. Equal texts have equal
    columns. The longest text decides the memory a task needs (a small multiple of its bytes).
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for text in part.column(1).to_pylist():
                    media = to_wav(payload_of(text))
                    back = from_wav(media)
                    rows.append((len((text or "").encode()), media, hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(back), fingerprint(np.frombuffer(back, dtype=np.uint8))))
                n, m, s, c, p, h = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(m, pa.binary()), pa.array(s), pa.array(c, pa.int64()), pa.array(p, pa.int64()), pa.array(h, pa.list_(pa.int64()))],
                    names=[key, "n_bytes", "media", "payload_sha256", "tail_crc32", "payload_bytes", "peaks_hash"],
                )

    return map_batches(df.select(key, text), run, f"`{key}` {kind}, {MEDIA_COLUMNS}")


def media_report(df: DataFrame) -> DataFrame:
    """One row for each row of df: sizes and digests of the payload and of the stored form, and the fingerprint's digest.

    feature is "<pairs>:<first 32 hex digits of the SHA-256 of the pairs, comma-joined>".
    """
    return with_media(df).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.size("peaks_hash").cast("string"), F.substring(F.sha2(F.array_join(F.col("peaks_hash").cast("array<string>"), ",").cast("binary"), 256), 1, 32)).alias("feature"),
    )
