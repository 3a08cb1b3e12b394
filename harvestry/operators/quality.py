"""Image quality filter: header predicates, blur, pluggable scorers, and the funnel of their counts.

Order of work is by cost: width and height come from the file's header, then pixels are decoded once for the blur score, and only
then a scorer (a model) runs. Spark doesn't reorder Python work by cost, so the order is written out.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A scorer gets a batch [n, 3, 512, 512] and gives n numbers, NaN where it can't.
Scorer = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Thresholds:
    min_resolution: int = 256
    max_aspect_ratio: float = 3.0
    blur: float = 100.0
    brisque: float = 45.0
    content: float = 0.5


def image_size(data: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, JPEG, BMP, WebP, TIFF or GIF file; None if it is none of these or broken."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp_size(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg_size(data)
        if data[:4] in (b"II*\0", b"MM\0*"):
            return _tiff_size(data)
    except (struct.error, IndexError):
        pass
    return None


def _webp_size(data: bytes) -> tuple[int, int] | None:
    kind = data[12:16]
    if kind == b"VP8 ":
        w, h = struct.unpack("<HH", data[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if kind == b"VP8L":
        bits = struct.unpack("<I", data[21:25])[0]
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8X":
        return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    return None


def _jpeg_size(data: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            return None
        mark = data[at + 1]
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", data[at + 5 : at + 9])
            return w, h
        if mark == 0xFF:
            at += 1
        elif mark == 1 or 0xD0 <= mark <= 0xD8:
            at += 2
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def _tiff_size(data: bytes) -> tuple[int, int] | None:
    order = "<" if data[:2] == b"II" else ">"
    at = struct.unpack(order + "I", data[4:8])[0]
    found = {}
    for k in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        tag, kind, _ = struct.unpack(order + "HHI", data[at + 2 + 12 * k : at + 10 + 12 * k])
        if tag in (256, 257):
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), data[at + 10 + 12 * k : at + (12 if kind == 3 else 14) + 12 * k])[0]
    return (found[256], found[257]) if len(found) == 2 else None


@F.pandas_udf(T.StructType().add("width", T.IntegerType()).add("height", T.IntegerType()))
def header_size(content: pd.Series) -> pd.DataFrame:
    """Width and height of image files; nulls where the header can't be read."""
    sizes = [image_size(bytes(c)) if c is not None else None for c in content]
    return pd.DataFrame({"width": pd.array([s[0] if s else None for s in sizes], dtype="Int32"), "height": pd.array([s[1] if s else None for s in sizes], dtype="Int32")})


def gray(bgr: np.ndarray) -> np.ndarray:
    """Luminance of BGR pixels, rounded to bytes."""
    return np.rint(bgr[..., 0] * 0.114 + bgr[..., 1] * 0.587 + bgr[..., 2] * 0.299).astype(np.uint8)


def laplacian_variance(g: np.ndarray) -> float:
    """Population variance of the 3 x 3 Laplacian with mirrored borders: low for blurred images."""
    p = np.pad(g.astype(np.float64), 1, mode="reflect") if min(g.shape) > 1 else np.pad(g.astype(np.float64), 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    return float(lap.var())


def resize(pixels: np.ndarray, size: int = 512, reach: int = 3) -> np.ndarray:
    """Lanczos resampling to size x size, without keeping the aspect ratio; windows widen when shrinking."""

    def weights(n: int) -> np.ndarray:
        scale = n / size
        width = reach * max(scale, 1.0)
        centre = (np.arange(size) + 0.5) * scale
        x = (np.arange(n)[None, :] + 0.5 - centre[:, None]) / max(scale, 1.0)
        w = np.where(np.abs(x) * max(scale, 1.0) < width, np.sinc(x) * np.sinc(x / reach), 0.0)
        return w / w.sum(axis=1, keepdims=True)

    out = np.einsum("yh,hwc->ywc", weights(pixels.shape[0]), pixels.astype(np.float64))
    out = np.einsum("xw,ywc->yxc", weights(pixels.shape[1]), out)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def tensor(bgr: np.ndarray, size: int = 512) -> np.ndarray:
    """RGB channels first, from 0 to 1: what scorers get."""
    return resize(bgr, size)[..., ::-1].transpose(2, 0, 1).astype(np.float32) / 255


def pixels_of(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """BGR pixels of a row of Spark's image source; gray images are spread over three channels, alpha is left out."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[..., :3]


def _normalised(g: np.ndarray) -> np.ndarray:
    """Luminance less its local mean, over its local deviation (plus one), under a 7 x 7 Gaussian window."""
    k = np.exp(-0.5 * (np.arange(-3, 4) / (7 / 6)) ** 2)
    k /= k.sum()

    def blur(a: np.ndarray) -> np.ndarray:
        p = np.pad(a, 3, mode="edge")
        rows = sum(w * p[i : i + a.shape[0]] for i, w in enumerate(k))
        return sum(w * rows[:, i : i + a.shape[1]] for i, w in enumerate(k))

    mean = blur(g)
    return (g - mean) / (np.sqrt(np.abs(blur(g * g) - mean**2)) + 1)


_SHAPES = np.arange(0.2, 10.001, 0.001)
_GAMMA = np.vectorize(math.gamma)
_RATIO = _GAMMA(2 / _SHAPES) ** 2 / (_GAMMA(1 / _SHAPES) * _GAMMA(3 / _SHAPES))


def _shape(ratio: float) -> float:
    return float(_SHAPES[np.abs(_RATIO - ratio).argmin()])


def _general(x: np.ndarray) -> list[float]:
    """Shape and variance of a generalised Gaussian, by moments."""
    square, mean = float((x**2).mean()), float(np.abs(x).mean())
    return [_shape(mean**2 / square) if square > 0 else 10.0, square]


def _skewed(x: np.ndarray) -> list[float]:
    """Shape, mean, and left and right variances of an asymmetric generalised Gaussian, by moments."""
    left, right = x[x < 0], x[x > 0]
    ls, rs = (float(np.sqrt((v**2).mean())) if len(v) else 0.0 for v in (left, right))
    square = float((x**2).mean())
    if not square or not rs:
        return [10.0, 0.0, ls**2, rs**2]
    side = ls / rs
    a = _shape(float(np.abs(x).mean()) ** 2 / square * (side**3 + 1) * (side + 1) / (side**2 + 1) ** 2)
    mean = (rs - ls) * math.gamma(2 / a) / math.sqrt(math.gamma(1 / a) * math.gamma(3 / a))
    return [a, mean, ls**2, rs**2]


def natural_scene_statistics(g: np.ndarray) -> np.ndarray:
    """The 36 features that no-reference scorers are trained on: two scales; the normalised luminance and its products with four neighbours."""
    out: list[float] = []
    g = g.astype(np.float64)
    for scale in range(2):
        x = _normalised(g)
        out += _general(x)
        for other in (x[:, :-1] * x[:, 1:], x[:-1] * x[1:], x[:-1, :-1] * x[1:, 1:], x[:-1, 1:] * x[1:, :-1]):
            out += _skewed(other)
        if not scale:
            h, w = (n - n % 2 for n in g.shape)
            g = g[:h, :w].reshape(h // 2, 2, w // 2, 2).mean(axis=(1, 3))
    return np.array(out)


def trained_scorer(predict: Callable[[np.ndarray], np.ndarray]) -> Scorer:
    """A scorer from a trained regressor over the 36 features; the weights are the caller's."""

    def score(batch: np.ndarray) -> np.ndarray:
        return predict(np.stack([natural_scene_statistics(gray((b[::-1] * 255).transpose(1, 2, 0))) for b in batch]))

    return score


def with_blur(images: DataFrame, image: str = "image", out: str = "blur_score") -> DataFrame:
    """Rows of Spark's image source with the blur score of their pixels; null where there are none."""
    fields = [F.col(f"{image}.data").alias("data"), F.col(f"{image}.height").alias("h"), F.col(f"{image}.width").alias("w"), F.col(f"{image}.nChannels").alias("c")]

    @F.pandas_udf("double")
    def score(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([laplacian_variance(gray(pixels_of(bytes(d), int(y), int(x), int(k)).astype(float))) if d is not None and len(d) else None for d, y, x, k in zip(data, h, w, c, strict=True)], dtype=float)

    return images.withColumn(out, score(*fields))


def with_score(images: DataFrame, scorer: Scorer, out: str, image: str = "image", batch: int = 32) -> DataFrame:
    """Rows with a scorer's number; a row that can't be decoded or scored has null, the others of its batch are kept."""

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for data, h, w, c in parts:
            found = np.full(len(data), np.nan)
            some = [i for i in range(len(data)) if data.iloc[i] is not None and len(data.iloc[i])]
            for at in range(0, len(some), batch):
                rows = some[at : at + batch]
                x = np.stack([tensor(pixels_of(bytes(data.iloc[i]), int(h.iloc[i]), int(w.iloc[i]), int(c.iloc[i]))) for i in rows])
                found[rows] = scorer(x)
            yield pd.Series(found).where(~np.isnan(found), None).astype(float)

    return images.withColumn(out, score(F.col(f"{image}.data"), F.col(f"{image}.height"), F.col(f"{image}.width"), F.col(f"{image}.nChannels")))


def large_enough(width: Column, height: Column, t: Thresholds = Thresholds()) -> Column:
    return F.least(width, height) >= t.min_resolution


def not_elongated(width: Column, height: Column, t: Thresholds = Thresholds()) -> Column:
    return F.try_divide(F.greatest(width, height), F.least(width, height)) <= t.max_aspect_ratio


def origin_path(origin: Column) -> Column:
    """A local path as the binary source writes it (one slash after the scheme)."""
    return F.regexp_replace(origin, "^file:/+", "file:/")


def filter_images(files: DataFrame, images: DataFrame | None = None, t: Thresholds = Thresholds(), brisque: Scorer | None = None, content: Scorer | None = None) -> DataFrame:
    """Paths of good images. files: binary files (path, content); images: Spark's image source rows, for decoded stages.

    Stages: header (size and aspect ratio); blur and BRISQUE, both only with a BRISQUE scorer; content, only with a content
    scorer (kept above the threshold). A stage without its scorer is passed over. Files that can't be read go.
    """
    sized = files.withColumn("_size", header_size("content"))
    w, h = F.col("_size.width"), F.col("_size.height")
    kept = sized.where(w.isNotNull() & large_enough(w, h, t) & not_elongated(w, h, t)).select("path")
    if images is None or (brisque is None and content is None):
        return kept
    rows = images.withColumn("path", origin_path(F.col("image.origin"))).join(kept, "path", "left_semi")
    if brisque is not None:
        rows = with_blur(rows).where(F.col("blur_score") >= t.blur)
        rows = with_score(rows, brisque, "brisque").where(F.col("brisque") <= t.brisque)
    if content is not None:
        rows = with_score(rows, content, "content_score").where(F.col("content_score") > t.content)
    return rows.select("path")


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, rows, passed, share): how many rows pass each stage and all before it, in one pass. Empty input: null shares."""
    so_far, aggregates = None, [F.count("*").alias("_all")]
    for k, condition in enumerate(stages.values()):
        ok = F.coalesce(condition, F.lit(False))
        so_far = ok if so_far is None else so_far & ok
        aggregates.append(F.count_if(so_far).alias(f"_{k}"))
    counts = df.agg(*aggregates)
    rows = [F.struct(F.lit(k + 1).alias("place"), F.lit(s).alias("stage"), (F.col("_all") if k == 0 else F.col(f"_{k - 1}")).alias("rows"), F.col(f"_{k}").alias("passed")) for k, s in enumerate(stages)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.place", "r.stage", "r.rows", "r.passed", F.try_divide(F.col("r.passed"), F.col("r.rows")).alias("share"))
