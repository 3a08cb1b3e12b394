from __future__ import annotations

import numpy as np
import pytest

from harvestry.operators import charts, evaluate
from harvestry.operators.reduce import CentredPCA, combine_features

FPS = [0, 188, 291, 152, 366, 49, 11, 132, 80, 14, 355, 296, 134, 308, 149, 459, 339, 267, 353, 419]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS id", "embedding")


def chosen(spark, ids):
    return spark.createDataFrame([(k + 1, i) for k, i in enumerate(ids)], "rank int, id long")


def test_golden_metrics(spark, table):
    m = evaluate.evaluate_selection(table.repartition(5), chosen(spark, FPS)).first()
    want = {
        "coverage_radius_max": 1.328141, "coverage_radius_mean": 1.182959, "coverage_radius_median": 1.234988, "coverage_radius_std": 0.245775, "coverage_p25": 1.199146, "coverage_p75": 1.264382,
        "coverage_radius_95th": 1.296377, "intra_diversity_mean": 1.440573, "intra_diversity_std": 0.066919, "intra_diversity_min": 1.329605, "intra_diversity_max": 1.635295, "intra_diversity_median": 1.430531,
    }
    for name, value in want.items():
        assert abs(m[name] - value) < 1e-5, name
    assert m["total_images"] == 500 and m["selected_images"] == 20
    assert m["distance_distribution"]["histogram_counts"] == [20] + [0] * 15 + [13, 86, 247, 134]
    assert len(m["distance_distribution"]["histogram_edges"]) == 21


def test_everything_selected_has_no_distance(spark, table):
    m = evaluate.evaluate_selection(table, table.select("id").limit(500)).first()
    assert m["coverage_radius_max"] == 0 and sum(m["distance_distribution"]["histogram_counts"]) == 500


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_selections(spark, table, n):
    m = evaluate.evaluate_selection(table, chosen(spark, FPS[:n])).first()
    assert m["selected_images"] == n
    assert (m["intra_diversity_mean"] is None) == (n < 2) and (m["coverage_radius_max"] is None) == (n == 0)


def test_pairs_are_sampled_beyond_the_limit(spark, table):
    v = evaluate.vectors(table)
    few, many = (evaluate.selected_vectors(v, table.orderBy("id").limit(n).select("id")) for n in (141, 142))
    assert evaluate.diversity_pairs(few).count() == 141 * 140 // 2
    pairs = evaluate.diversity_pairs(many).collect()
    assert len(pairs) == 10_000 and all(r["i"] != r["j"] for r in pairs)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 5.0], [3.0, 3.0], list(np.random.default_rng(0).normal(size=200))])
def test_histogram_is_numpys(spark, values):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(values)], "id long, distance double")
    counts, edges = np.histogram(values, bins=20)
    rows = evaluate.histogram(df).orderBy("bin").collect()
    assert [r["n"] for r in rows] == counts.tolist() and np.allclose([r["lo"] for r in rows] + [rows[-1]["hi"]], edges)


def test_validation(spark, table):
    evaluate.validate_selection(table, chosen(spark, FPS))
    with pytest.raises(ValueError):
        evaluate.validate_selection(table, chosen(spark, [5, 100_000]))


def test_charts(spark, table):
    pick = chosen(spark, FPS)
    metrics = evaluate.evaluate_selection(table, pick)
    made = charts.all_charts(table, pick, metrics)
    assert {"selection", "coverage_histogram", "coverage_cdf", "coverage_box", "coverage_summary", "diversity_matrix", "diversity_histogram", "diversity_summary", "dashboard"} == set(made)
    assert made["selection"].where("selected").count() == 20 and made["coverage_cdf"].agg({"share": "max"}).first()[0] == 1.0
    assert "selection" not in charts.all_charts(table, pick, metrics, "umap")
    with pytest.raises(NotImplementedError):
        charts.projection(table, pick, "umap")
    assert charts.projection(table, pick, most=50).count() <= 70


def test_tsne_keeps_clouds_apart(spark, monkeypatch):
    monkeypatch.setattr(charts, "TSNE_ROWS", 80)
    rng = np.random.default_rng(5)
    m = np.concatenate([rng.normal(c, 0.2, (40, 6)) for c in (0, 4, 8)])
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, embedding array<double>")
    pick = spark.createDataFrame([(1, 0), (2, 50), (3, 100)], "rank int, id long")
    rows = charts.projection(df, pick, "tsne").collect()
    assert len(rows) == 80 and sum(r["selected"] for r in rows) == 3
    y, cloud = np.array([(r["x"], r["y"]) for r in rows]), np.array([r["id"] // 40 for r in rows])
    d = np.linalg.norm(y[:, None] - y[None], axis=2) + np.eye(len(y)) * 1e9
    assert (cloud[d.argmin(axis=1)] == cloud).all()


def test_comparison_is_each_methods_own_metrics(spark, table):
    picks = {"a": chosen(spark, FPS), "none": chosen(spark, FPS[:1]).limit(0), "b": chosen(spark, FPS[:3])}
    rows = {r["method"]: r.asDict(recursive=True) for r in evaluate.compare_selections(table, picks).collect()}
    assert list(rows) == ["a", "none", "b"] and rows["none"]["selected_images"] == 0 and rows["none"]["coverage_radius_max"] is None
    for name in ("a", "b"):
        alone = evaluate.evaluate_selection(table, picks[name]).first().asDict(recursive=True)
        assert all(rows[name][k] == v or abs(rows[name][k] - v) < 1e-9 for k, v in alone.items() if not isinstance(v, dict))
        assert rows[name]["distance_distribution"] == alone["distance_distribution"]


def test_pca_is_centred(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(80, 5)) * [5, 4, 3, 2, 1] + 100
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)] + [(99, None)], "id long, embedding array<double>")
    pca = CentredPCA.fit(df, 3)
    got = {r["id"]: r["reduced"] for r in pca.transform(df).collect()}
    c = m - m.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    assert got[99] is None
    assert np.allclose(np.abs([got[i] for i in range(80)]), np.abs(c @ vt[:3].T), atol=1e-8)
    assert np.allclose(pca.explained, (s**2 / (s**2).sum())[:3])
    with pytest.raises(ValueError):
        CentredPCA.fit(df, 6)


def test_pca_is_stored(spark, tmp_path):
    df = spark.createDataFrame([(i, [float(i), float(i % 3), 1.0]) for i in range(9)], "id long, embedding array<double>")
    pca = CentredPCA.fit(df, 2)
    pca.save(str(tmp_path / "m"))
    again = CentredPCA.load(spark, str(tmp_path / "m"))
    assert [r["reduced"] for r in pca.transform(df).orderBy("id").collect()] == [r["reduced"] for r in again.transform(df).orderBy("id").collect()]


def test_features_join_by_id(spark):
    a = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id long, embedding array<double>")
    b = spark.createDataFrame([(2, [20.0]), (1, [10.0]), (3, [30.0])], "id long, embedding array<double>")
    assert {r["id"]: r["embedding"] for r in combine_features(a, b).collect()} == {1: [1.0, 10.0], 2: [2.0, 20.0]}


def test_ranks_and_quantiles_are_global(spark):
    from harvestry.operators.rank import global_rank, quantiles

    values = np.random.default_rng(5).integers(0, 40, 500).astype(float)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(values)], "id long, x double").repartition(7)
    ranked = global_rank(df, "x", "id").collect()
    want = sorted((x, i) for i, x in enumerate(values))
    assert [(r["x"], r["id"]) for r in sorted(ranked, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in ranked) == list(range(1, 501))
    got = quantiles(df, "x", {"a": 0.0, "b": 0.13, "c": 0.5, "d": 1.0}).first()
    assert np.allclose(list(got), np.quantile(values, [0, 0.13, 0.5, 1]))
    assert tuple(quantiles(df.limit(0), "x", {"a": 0.5}).first()) == (None,)


@pytest.mark.parametrize("name", ["coverage_cdf", "boxplot_stats", "coverage_metrics"])
def test_distances_are_computed_once_for_a_query(spark, name, monkeypatch):
    """What ranks, quantiles and bins read again and again is a written table."""
    from harvestry.plans import queries

    own, seen = queries._near, []
    monkeypatch.setattr(queries, "_near", lambda *a: (seen.append(own(*a)), seen[-1])[1])
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 1 and all("/near-" in f for f in seen[0].inputFiles())
