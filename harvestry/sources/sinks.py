"""Sinks: small results on the driver's disk, checked tables, copies and links of selected files."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

import numpy as np
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import collision_names
from harvestry.sources.files import mode_of


def plain(value: object) -> object:
    """Rows, numpy scalars and arrays as plain Python."""
    if hasattr(value, "asDict"):
        return plain(value.asDict(recursive=True))
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, np.ndarray):
        return value.tolist()
    return value.item() if isinstance(value, np.generic) else value


def save_results(data: object, path: str, mode: str = "auto", sort_keys: bool = True) -> None:
    """A small result to the driver's disk as list (one item a line), numpy, yaml or json, by mode or suffix."""
    mode = mode_of(path, mode)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    if mode == "numpy":
        np.save(path, np.asarray(data))
    elif mode == "list":
        Path(path).write_text("".join(f"{x}\n" for x in data))
    elif mode == "yaml":
        Path(path).write_text(yaml.safe_dump(plain(data), sort_keys=sort_keys))
    else:
        Path(path).write_text(json.dumps(plain(data), indent=2))


def save_checked(df: DataFrame, path: str, vector: str | None = None) -> DataFrame:
    """Write a table, read it back, and compare row counts and vector lengths; RuntimeError if they differ."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    measure = [F.count("*").alias("n")] + ([F.min(F.size(vector)).alias("lo"), F.max(F.size(vector)).alias("hi")] if vector else [])
    want, got = df.agg(*measure).first(), back.agg(*measure).first()
    if want != got:
        raise RuntimeError(f"{path}: {got} was read back, {want} was written")
    return back


def _place(selection: DataFrame, output_dir: str, put: Callable[[str, str], object]) -> int:
    """Selected files are few and land on the driver's disk, one by one."""
    Path(output_dir).mkdir(parents=True, exist_ok=True)
    n = 0
    for row in collision_names(selection).orderBy("rank").select("path", "target").toLocalIterator():
        source = row["path"].removeprefix("file:")
        put(os.path.abspath("/" + source.lstrip("/") if row["path"].startswith("file:") else source), str(Path(output_dir, row["target"])))
        n += 1
    return n


def copy_selected(selection: DataFrame, output_dir: str) -> int:
    """Copy (rank, path) to a folder; equal names get numbers."""
    return _place(selection, output_dir, shutil.copy2)


def link_selected(selection: DataFrame, output_dir: str) -> int:
    """Symbolic links to the resolved files; equal names get numbers."""
    return _place(selection, output_dir, lambda a, b: os.symlink(os.path.realpath(a), b))
