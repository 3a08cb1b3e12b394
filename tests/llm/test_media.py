from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest

from harvestry.llm import media


@pytest.mark.parametrize("text", [None, "", "a", "é" * 288, "x" * 576, "x" * 577, "long text " * 40_000])
def test_round_trip(text):
    payload = media.payload_of(text)
    raw = (text or "").encode()
    assert payload.startswith(raw) and len(payload) % 576 == 0 and len(payload) >= 576 and len(payload) - len(raw) <= 576
    assert set(payload[len(raw) :]) <= {255}
    assert media.from_wav(media.to_wav(payload)) == payload


def test_report(spark):
    texts = [None, "", "hello", "hello", "x" * 576, "words and more " * 3000]
    rows = {r["doc_id"]: r for r in media.media_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    for i, text in enumerate(texts):
        payload = media.payload_of(text)
        assert rows[i]["n_bytes"] == len((text or "").encode()) and rows[i]["payload_bytes"] == len(payload)
        assert rows[i]["payload_sha256"] == hashlib.sha256(payload).hexdigest() and rows[i]["tail_crc32"] == zlib.crc32(payload[-32:])
        assert rows[i]["media_bytes"] == len(payload) + 44 and rows[i]["media_sha256"] == hashlib.sha256(media.to_wav(payload)).hexdigest()
    assert rows[2]["feature"] == rows[3]["feature"] and rows[0]["feature"] == rows[1]["feature"] and rows[4]["feature"] != rows[5]["feature"]
    assert media.media_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_peaks_find_tones_in_any_chunk(monkeypatch):
    t = np.arange(media.RATE * 2)
    tone = (128 + 50 * np.sin(2 * np.pi * 1000 * t / media.RATE) * (1 + 0.5 * np.sin(2 * np.pi * 3 * t / media.RATE))).astype(np.uint8)
    whole = media.fingerprint(tone)
    assert set(media.peaks(tone)[1]) & {30, 31, 32}
    monkeypatch.setattr(media, "CHUNK_FRAMES", 7)
    assert (media.fingerprint(tone) == whole).all() and (np.diff(whole) >= 0).all()


def test_a_shifted_signal_shares_pairs():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, media.HOP * 200).astype(np.uint8)
    a, b = media.fingerprint(x), media.fingerprint(x[media.HOP * 10 :])
    pairs = lambda f: {(int(v) >> 20, int(v) & 0xFFFFF) for v in f}
    moved = {(t - 10, h) for t, h in pairs(a)}
    assert len(moved & pairs(b)) > 0.9 * len(b)


def plain_fingerprint(samples: np.ndarray) -> list[int]:
    """The discrete Fourier transform by its sum, peaks cell by cell, and pairs one by one."""
    n, hop, x = media.FRAME, media.HOP, samples.astype(float) - 128
    window = [0.5 - 0.5 * math.cos(2 * math.pi * k / (n - 1)) for k in range(n)]
    waves = np.exp(-2j * math.pi * np.outer(np.arange(1, n // 2 + 1), np.arange(n)) / n)
    level = [np.abs(waves @ (x[at : at + n] * window)) for at in range(0, len(x) - n + 1, hop)]
    value = lambda t, f: level[t][f] if 0 <= t < len(level) and 0 <= f < n // 2 else -1
    found = []
    for t, row in enumerate(level):
        for f, v in enumerate(row):
            if v > 2.5 * row.mean() and v > value(t, f - 1) and v >= value(t, f + 1) and v > value(t - 1, f) and v >= value(t + 1, f):
                found.append((t, f))
    out = []
    for i, (t, f) in enumerate(found):
        following = [p for p in found[i + 1 :] if p[0] > t][: media.FANOUT]
        out += [t << 20 | f << 12 | g << 4 | (u - t - 1) for u, g in following if u - t <= media.ZONE]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_fingerprints_equal_the_plain_transform(seed, monkeypatch):
    monkeypatch.setattr(media, "CHUNK_FRAMES", 5)
    rng = np.random.default_rng(seed)
    text = " ".join("".join(rng.choice(list("abcdef"), 5)) for _ in range(700))
    for samples in (np.frombuffer(media.payload_of(text), dtype=np.uint8), rng.integers(0, 256, 3000).astype(np.uint8)):
        want = plain_fingerprint(samples)
        assert len(want) > 20 and media.fingerprint(samples).tolist() == want


def test_other_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, "a", b"x"), (1, "a", b"x"), (None, None, None)], "doc_id long, text string, media binary")
    out = media.with_media(df)
    assert out.columns[0] == "doc_id" and out.columns.count("media") == 1 and out.count() == 3
    assert bytes(out.where("doc_id = 1").first()["media"]) == media.to_wav(media.payload_of("a"))
    assert media.with_media(df.limit(0)).collect() == []
