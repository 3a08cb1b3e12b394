from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestry.functions import text
from harvestry.operators import encode, quality
from harvestry.plans import cli, pipeline
from harvestry.plans.config import Config, load_config, merged
from harvestry.sources import files, sinks
from harvestry.streaming.topup import top_up


def png(pixels: np.ndarray) -> bytes:
    h, w = pixels.shape[:2]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def noise(w: int, h: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3)).astype(np.uint8)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    (root / "sub").mkdir()
    for name, data in {
        "a.png": noise(256, 256), "small.png": noise(255, 300), "wide.PNG": noise(900, 300), "long.png": noise(903, 300), "sub/flat.Png": np.full((300, 300, 3), 90, np.uint8), "sub/a.png": noise(260, 300, 5),
    }.items():
        (root / name).write_bytes(png(data))
    (root / "broken.jpg").write_bytes(b"nothing")
    (root / "notes.txt").write_text("x")
    return str(root)


def names(df) -> set[str]:
    return {r["path"].split("/images", 1)[1].split("/", 1)[1] for r in df.collect()}


def test_listing_and_header_filter(spark, tree):
    assert names(files.image_paths(spark, tree)) == {"a.png", "small.png", "wide.PNG", "long.png", "sub/flat.Png", "sub/a.png", "broken.jpg"}
    assert names(quality.filter_images(files.image_files(spark, tree))) == {"a.png", "wide.PNG", "sub/flat.Png", "sub/a.png"}
    with pytest.raises(FileNotFoundError):
        files.image_files(spark, tree + "/none")
    plan = files.image_paths(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_scorers_and_blur(spark, tree):
    images = files.images(spark, tree)
    kept = quality.filter_images(files.image_files(spark, tree), images, brisque=lambda x: np.full(len(x), 10.0), content=lambda x: np.array([0.9 if b.std() > 0 else np.nan for b in x]))
    assert names(kept) == {"a.png", "wide.PNG", "sub/a.png"}
    assert names(quality.filter_images(files.image_files(spark, tree), images, brisque=lambda x: np.full(len(x), 46.0))) == set()


def test_blur_is_the_plain_laplacian():
    g = noise(9, 7)[..., 0]
    p = np.pad(g.astype(float), 1, mode="reflect")
    lap = [[p[y, x + 1] + p[y + 2, x + 1] + p[y + 1, x] + p[y + 1, x + 2] - 4 * p[y + 1, x + 1] for x in range(9)] for y in range(7)]
    assert np.isclose(quality.laplacian_variance(g), np.var(lap))
    assert quality.laplacian_variance(np.full((4, 4), 7)) == 0 and quality.gray(np.array([[[0, 0, 255]]])).item() == 76


def test_pixels_and_resize():
    a = noise(20, 10)
    assert (quality.resize(np.full((9, 30, 3), 77, np.uint8), 16) == 77).all() and quality.tensor(a, 32).shape == (3, 32, 32)


@pytest.mark.parametrize(
    ("data", "size"),
    [
        (png(noise(5, 4)), (5, 4)), (b"BM" + b"\0" * 16 + struct.pack("<ii", 7, -8) + b"\0" * 20, (7, 8)), (b"GIF89a" + struct.pack("<HH", 3, 2), (3, 2)), (b"", None), (b"\xff\xd8\xff", None), (b"\x89PNG\r\n\x1a\n", None),
        (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 11, 13) + b"\0" * 8, (13, 11)),
        (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), (100, 50)),
        (b"II*\0" + struct.pack("<IH", 8, 2) + struct.pack("<HHIHH", 256, 3, 1, 21, 0) + struct.pack("<HHII", 257, 4, 1, 22) + b"\0" * 4, (21, 22)),
    ],
)
def test_headers(data, size):
    assert quality.image_size(data) == size


def test_natural_scene_statistics():
    rng = np.random.default_rng(0)
    sharp = rng.normal(128, 40, (96, 96))
    f = quality.natural_scene_statistics(sharp)
    assert f.shape == (36,) and np.isfinite(f).all()
    assert abs(quality._general(rng.normal(0, 3, 50_000))[0] - 2) < 0.1 and abs(quality._general(rng.laplace(0, 3, 50_000))[0] - 1) < 0.1
    assert abs(quality._skewed(rng.normal(0, 2, 50_000))[1]) < 0.1
    heavy = quality.natural_scene_statistics(128 + 10 * rng.standard_t(2, (96, 96)))
    assert heavy[0] < f[0]
    assert np.isfinite(quality.natural_scene_statistics(np.full((20, 20), 9))).all()
    score = quality.trained_scorer(lambda x: x[:, 0] * 10)
    assert score(np.stack([quality.tensor(noise(64, 64), 64)] * 2)).shape == (2,)


def test_funnel_counts(spark):
    rows = quality.funnel(spark.range(10), {"a": F.col("id") > 3, "b": F.col("id") % 2 == 0}).collect()
    assert [(r["stage"], r["rows"], r["passed"]) for r in rows] == [("a", 10, 6), ("b", 6, 3)]
    assert quality.funnel(spark.range(0), {"a": F.lit(True)}).first()["share"] is None


def test_formats_round_as_the_binary_value_is(spark):
    rng = np.random.default_rng(0)
    values = [0.25, 0.35, 0.05, 0.15, 0.005, 2.675, 59.9, 59.949999, 60.0, 3599.0, 3600.0, -0.01, -5.5, 0.0, 1e7, 1023.0, 1024.0, 2.0**50, 2.0**60, 1e-9]
    values += [*rng.uniform(0, 1e5, 300), *(rng.integers(0, 10**6, 300) / 8), *(rng.integers(0, 10**5, 300) / 20), *rng.uniform(0, 1e15, 300)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    x = F.col("x")
    for r in df.select("x", text.fixed(x, 1).alias("one"), text.fixed(x, 2).alias("two"), text.format_time(x).alias("time"), text.format_bytes(x).alias("size")).collect():
        if r["x"] is None or not np.isfinite(r["x"]):
            assert r[1:] == (None,) * 4
        else:
            assert (r["one"], r["two"]) == ("%.1f" % r["x"], "%.2f" % r["x"])
    told = {r["x"]: (r[1], r[2]) for r in df.limit(19).select("x", text.format_time(x), text.format_bytes(x)).collect()}
    assert [told[v][0] for v in (59.9, 60.0, 3599.0, 3600.0, 0.25, 0.35)] == ["59.9s", "1.0m", "60.0m", "1.00h", "0.2s", "0.3s"]
    assert [told[v][1] for v in (1023.0, 1024.0, 2.0**50, 2.0**60)] == ["1023.00 B", "1.00 KB", "1.00 PB", "1024.00 PB"]


@pytest.mark.parametrize("seed", range(4))
def test_names_are_those_of_one_after_the_other(spark, seed):
    rng = np.random.default_rng(seed)
    stems = ["a", "a_1", "a_1_1", "a_2", "b", "b_1"]
    paths = ["x/a.png", "y/a.png", "a_1.png", "a_1_1.png"] if not seed else [f"d{i}/{stems[rng.integers(0, 6)]}.png" for i in range(40)]
    taken: set[str] = set()
    want = []
    for p in paths:
        first, k = os.path.basename(p), 0
        name = first
        while name in taken:
            k += 1
            name = first.replace(".png", f"_{k}.png")
        taken.add(name)
        want.append(name)
    df = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "rank int, path string")
    assert [r["target"] for r in text.collision_names(df).orderBy("rank").collect()] == want


def test_names_and_bars(spark):
    paths = ["/x/a.png", "/y/a.png", "/z/a_1.png", "/x/.hid", "/y/.hid", "/x/noext", "/y/noext"]
    df = spark.createDataFrame([(k + 1, p) for k, p in enumerate(paths)], "rank int, path string")
    assert [r["target"] for r in text.collision_names(df).orderBy("rank").collect()] == ["a.png", "a_1.png", "a_1_1.png", ".hid", ".hid_1", "noext", "noext_1"]
    bars = spark.createDataFrame([(0.0,), (52.0,), (100.0,)], "s double").select(text.progress_bar(F.col("s")), text.band(F.col("s"))).collect()
    assert [tuple(b) for b in bars] == [(" " * 20, "Poor"), ("█" * 10 + " " * 10, "Fair"), ("█" * 20, "Excellent")]


def test_results_round_trip(tmp_path, spark):
    for name, value in {"a.json": {"b": [1, 2.5], "a": "é"}, "b.yaml": {"b": 1, "a": [1]}, "c.txt": ["x", "y"]}.items():
        sinks.save_results(value, str(tmp_path / name))
        assert files.load_results(str(tmp_path / name)) == value
    sinks.save_results(np.eye(2), str(tmp_path / "d.npy"))
    assert (files.load_results(str(tmp_path / "d.npy")) == np.eye(2)).all()
    (tmp_path / "l.txt").write_text("a  \n\n b\n")
    assert files.load_results(str(tmp_path / "l.txt")) == ["a", "b"]
    assert sorted(r["path"] for r in files.image_paths(spark, filter_list=str(tmp_path / "l.txt")).collect()) == [" b", "a"]
    assert files.import_vectors(spark, str(tmp_path / "d.npy")).count() == 2
    for bad, error in (("a.bin", ValueError), ("none.json", FileNotFoundError)):
        with pytest.raises(error):
            files.load_results(str(tmp_path / bad))
    with pytest.raises(ValueError):
        sinks.save_results([], str(tmp_path / "x"), "pickle")


def test_copies_and_links(spark, tree, tmp_path):
    picked = files.image_paths(spark, tree).where("path LIKE '%a.png'").selectExpr("row_number() OVER (ORDER BY path) AS rank", "path")
    assert sinks.copy_selected(picked, str(tmp_path / "c")) == 2 and sorted(os.listdir(tmp_path / "c")) == ["a.png", "a_1.png"]
    assert sinks.link_selected(picked, str(tmp_path / "l")) == 2 and all((tmp_path / "l" / f).is_symlink() for f in os.listdir(tmp_path / "l"))


def test_config_precedence(tmp_path):
    (tmp_path / "c.yaml").write_text("diversity_selection:\n  n_select: 7\n  hybrid:\n    n_clusters: 3\nlogging:\n  log_file: null\n")
    c = load_config(str(tmp_path / "c.yaml"), {"diversity_selection": {"n_select": None, "method": "fps"}})
    assert (c.diversity_selection.n_select, c.diversity_selection.method, c.diversity_selection.hybrid.n_clusters, c.deduplication.threshold) == (7, "fps", 3, 0.95)
    assert load_config(overrides={"diversity_selection": {"n_select": 0}}).diversity_selection.n_select == 0
    with pytest.raises(ValueError):
        merged(Config(), {"nothing": {}})


def test_pipeline_from_images(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    config = load_config(overrides={"input": {"image_dir": tree}, "output": {"output_dir": out, "copy_images": True}, "dimensionality_reduction": {"n_components": 2}, "diversity_selection": {"n_select": 3, "method": "fps"}})

    def make() -> encode.Encoder:
        return lambda x: np.stack([x.mean(axis=(1, 2, 3)), x.std(axis=(1, 2, 3)), x[:, 0, 0, 0], x[:, 1, 5, 5]], axis=1)

    result = pipeline.run_pipeline(spark, config, make)
    picks = [r["id"] for r in result.selected.orderBy("rank").collect()]
    assert len(picks) == 3 and result.skipped == ["brisque", "content"]
    assert len(os.listdir(f"{out}/selected_images")) == 3 and files.load_results(f"{out}/evaluation_metrics.yaml")["selected_images"] == 3
    assert cli.main(["evaluate", out, "--metrics-only"]) == 0
    assert cli.main(["evaluate", str(tmp_path / "none")]) == 1
    again = pipeline.run_pipeline(spark, config, make, resume=True)
    assert [r["id"] for r in again.selected.orderBy("rank").collect()] == picks


def test_curate_by_cells_is_curate(spark):
    rng = np.random.default_rng(2)
    m = np.repeat(rng.normal(size=(12, 8)), 20, axis=0) + 0.01 * rng.normal(size=(240, 8))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, embedding array<double>")
    base = {"dimensionality_reduction": {"enabled": False}, "diversity_selection": {"n_select": 5, "method": "fps"}, "evaluation": {"enabled": False}}
    rows = []
    for cells in (None, 6):
        result = pipeline.curate(df, load_config(overrides=base | {"deduplication": {"cells": cells, "neighbours": 40}}))
        rows.append((result.embeddings.count(), [r["id"] for r in result.selected.orderBy("rank").collect()]))
    assert rows[0] == rows[1] and rows[0][0] == 12


def test_command_from_images(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    assert cli.main(["run", "--image-dir", tree, "--output-dir", out, "--n-select", "3", "--method", "fps", "--skip-quality-filter", "--skip-deduplication", "--device", "cpu", "--visualization-method", "pca"]) == 0
    assert spark.read.parquet(f"{out}/selected").count() == 3
    assert spark.read.parquet(f"{out}/embeddings_raw").selectExpr("size(embedding) AS n").first()["n"] == 88
    lost = {os.path.basename(r["path"]) for r in spark.read.parquet(f"{out}/undecoded").collect()}
    assert lost and all(n not in lost for n in os.listdir(tree) if n.endswith("a.png"))
    assert cli.main(["run", "--image-dir", str(tmp_path / "none"), "--output-dir", out]) == 1


def test_encoder_names_and_colours():
    assert encode.model_name("dinov2-base") == "facebook/dinov2-base" and encode.model_name("own") == "own"
    batch = np.full((2, 3, 16, 16), 0.485, dtype=np.float32)
    assert abs(encode.normalised(batch, "imagenet")[0, 0]).max() < 1e-6 and encode.normalised(batch, None) is batch
    assert encode.pixel_statistics()(batch).shape == (2, 88)


def test_streaming_top_up(spark, tmp_path):
    rng = np.random.default_rng(0)
    for part in range(2):
        rows = [(100 * part + i, [float(x) for x in rng.normal(size=3)]) for i in range(30)]
        spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = top_up(spark, str(tmp_path / "in"), str(tmp_path / "sel"), str(tmp_path / "cp"), 4)
        query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "sel")).collect()
    assert len(rows) == 8 and len({r["id"] for r in rows}) == 8 and {r["batch"] for r in rows} == {0, 1}
