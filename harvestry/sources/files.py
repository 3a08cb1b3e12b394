"""Sources: image listings, list files, decoded images, stored results."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp", "tiff")
_ANY_CASE = ",".join("*." + "".join(f"[{c}{c.upper()}]" for c in e) for e in EXTENSIONS)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def image_files(spark: SparkSession, image_dir: str) -> DataFrame:
    """Binary files (path, modificationTime, length, content) under a folder with an image extension in any case; only what is selected is read."""
    if not _exists(spark, image_dir):
        raise FileNotFoundError(image_dir)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{{{_ANY_CASE}}}").load(image_dir)


def image_paths(spark: SparkSession, image_dir: str | None = None, filter_list: str | None = None) -> DataFrame:
    """(path): of a folder, or the non-blank lines of a list file without trailing white space. Distinct."""
    if filter_list is not None:
        lines = spark.read.text(filter_list).select(F.rtrim("value").alias("path"))
        return lines.where(F.trim("path") != "").distinct()
    return image_files(spark, image_dir).select("path").distinct()


def images(spark: SparkSession, image_dir: str) -> DataFrame:
    """Spark's image source; files that can't be decoded are left out."""
    if not _exists(spark, image_dir):
        raise FileNotFoundError(image_dir)
    return spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"{{{_ANY_CASE}}}").load(image_dir)


def with_ids(paths: DataFrame) -> DataFrame:
    """(id, path): an id from the path itself, so that it doesn't depend on order or partitions."""
    return paths.select(F.xxhash64("path").alias("id"), "path")


MODES = {".npy": "numpy", ".yaml": "yaml", ".yml": "yaml", ".json": "json", ".txt": "list"}


def mode_of(path: str, mode: str = "auto") -> str:
    if mode == "auto":
        suffix = Path(path).suffix.lower()
        if suffix not in MODES:
            raise ValueError(f"no mode for {suffix!r}")
        return MODES[suffix]
    if mode not in set(MODES.values()):
        raise ValueError(f"unknown mode {mode!r}")
    return mode


def load_results(path: str, mode: str = "auto") -> object:
    """A small result from the driver's disk: list (blank lines left out), numpy, yaml or json, by mode or suffix."""
    mode = mode_of(path, mode)
    if not Path(path).exists():
        raise FileNotFoundError(path)
    if mode == "numpy":
        return np.load(path)
    text = Path(path).read_text()
    if mode == "list":
        return [line.strip() for line in text.splitlines() if line.strip()]
    return yaml.safe_load(text) if mode == "yaml" else json.loads(text)


def import_vectors(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """(id, embedding) of a matrix file that fits the driver; ids default to row numbers. Tables are read by spark.read.parquet."""
    m = np.load(path)
    if m.ndim != 2:
        raise ValueError(f"{m.ndim} dimensions")
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids if ids is not None else range(len(m)), m, strict=True)], "id long, embedding array<float>")
