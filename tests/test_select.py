from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.operators import select

SF = "/root/testdata/sf0.01/embeddings.parquet"
GOLDEN_FPS = [0, 188, 291, 152, 366, 49, 11, 132, 80, 14, 355, 296, 134, 308, 149, 459, 339, 267, 353, 419]


def frame(spark, m, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, embedding array<double>")


def ids(df) -> list[int]:
    return [r["id"] for r in df.orderBy("rank").collect()]


def plain_farthest(m: np.ndarray, k: int, first: int) -> list[int]:
    out = [first]
    while len(out) < min(k, len(m)):
        best = [(min(((m[i] - m[j]) ** 2).sum() for j in out), -i) for i in range(len(m)) if i not in out]
        out.append(-max(best)[1])
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 14), st.integers(0, 10**6))
def test_kernel_is_the_greedy_rule(n, k, seed):
    m = np.random.default_rng(seed).integers(0, 5, (n, 2)).astype(float)
    picks = select.farthest(m, k).tolist()
    assert picks == plain_farthest(m, k, 0)
    assert len(set(picks)) == len(picks) == min(n, k)
    assert select.farthest(m, max(1, k - 1)).tolist() == picks[: max(1, min(n, k - 1))]


@settings(max_examples=30, deadline=None)
@given(st.integers(4, 9), st.integers(0, 10**6))
def test_kernel_is_a_two_approximation(n, seed):
    import itertools

    m = np.random.default_rng(seed).normal(size=(n, 2))
    radius = lambda c: max(min(np.linalg.norm(m[i] - m[j]) for j in c) for i in range(n))
    assert radius(select.farthest(m, 3).tolist()) <= 2 * min(radius(c) for c in itertools.combinations(range(n), 3)) + 1e-9


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_golden_selections_do_not_depend_on_partitions(spark, parts):
    df = spark.read.parquet(SF).selectExpr("vec_id AS id", "embedding").repartition(parts)
    assert ids(select.fps_selection(df, 20)) == GOLDEN_FPS
    assert ids(select.random_selection(df, 8)) == [238, 322, 16, 369, 337, 229, 218, 327]


def test_more_than_there_are_and_unknown_method(spark):
    df = frame(spark, np.eye(4))
    for method in ("random", "fps", "hybrid"):
        assert sorted(ids(select.select_diverse(df, 9, method))) == [0, 1, 2, 3]
    assert set(ids(select.select_diverse(df, 9, "kmeans"))) <= {0, 1, 2, 3}
    with pytest.raises(ValueError):
        select.select_diverse(df, 2, "best")
    with pytest.raises(ValueError):
        select.select_diverse(df, 2, "")


def test_refine_keeps_order_and_adds_the_farthest(spark):
    df = frame(spark, [[0], [1], [10], [4], [11]])
    start = spark.createDataFrame([(1, 0)], "rank int, id long")
    assert ids(select.refine(df, start, 3)) == [0, 4, 3]
    assert ids(select.refine(df, start, 1)) == [0]
    assert ids(select.incremental_selection(df, start, 2)) == [0, 1, 4]
    assert ids(select.incremental_selection(df, start, 2, anchored=True)) == [0, 4, 3]


def test_medoids_take_the_lowest_of_ties(spark):
    df = frame(spark, [[1.0], [-1.0], [5.0]])
    centers = spark.createDataFrame([(0, [0.0]), (1, [5.0])], "cluster int, center array<double>")
    assert sorted((r["cluster"], r["id"]) for r in select.medoids(df, centers).collect()) == [(0, 0), (1, 2)]


def test_hybrid_quota_refinement_and_trim(spark):
    rng = np.random.default_rng(0)
    df = frame(spark, rng.normal(size=(60, 3))).selectExpr("*", "id % 6 AS cluster")
    assert len(ids(select.hybrid_from_clusters(df, 20, 6))) == 20
    assert len(ids(select.hybrid_from_clusters(df, 12, 6))) == 12
    assert len(ids(select.hybrid_from_clusters(df, 3, 6))) == 3


def test_kmeans_and_spectral_separate_clouds(spark):
    rng = np.random.default_rng(1)
    m = np.concatenate([rng.normal(c, 0.1, (15, 2)) for c in ((0, 8), (8, 0), (-8, -8))])
    for found in (select.kmeans_selection(frame(spark, m), 3), select.spectral_selection(frame(spark, m), 3, neighbours=8)):
        assert {i // 15 for i in ids(found)} == {0, 1, 2}
    assert len(ids(select.kmeans_selection(frame(spark, m), 10, top_up=True))) == 10


@pytest.mark.parametrize("candidates", [2, 7, 1000])
@pytest.mark.parametrize("anchored", [False, True])
def test_rounds_are_the_picks_of_one_task(spark, candidates, anchored, monkeypatch):
    m = np.random.default_rng(7).integers(0, 6, (150, 3)).astype(float)  # many ties and repeats
    df = frame(spark, m).repartition(4)
    anchors = frame(spark, [[0.0, 0.0, 5.0], [3.0, 3.0, 3.0]]) if anchored else None
    want = ids(select.fps_selection(df, 25, anchors=anchors))
    own = select._rounds
    monkeypatch.setattr(select, "_rounds", lambda df, k, first: own(df, k, first, candidates))
    assert ids(select.fps_selection(df, 25, anchors=anchors, task_numbers=0)) == want


def test_large_clusters_are_worked_off_in_rounds(spark):
    df = frame(spark, np.random.default_rng(0).normal(size=(60, 3))).selectExpr("*", "IF(id < 40, 0, id % 5) AS cluster")
    assert ids(select.hybrid_from_clusters(df, 20, 5, task_numbers=60)) == ids(select.hybrid_from_clusters(df, 20, 5))


def test_unusable_vectors_are_not_picked(spark):
    df = spark.createDataFrame([(0, None), (1, [float("nan"), 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (None, [5.0, 5.0])], "id long, embedding array<double>")
    assert ids(select.fps_selection(df, 9)) == [2, 3]
    assert set(ids(select.kmeans_selection(df, 2))) == {2, 3}


def test_kmeans_is_lloyds(spark):
    m = np.random.default_rng(3).normal(size=(200, 5))
    df = frame(spark, m).repartition(6)
    labelled, held = select.kmeans_clusters(df, 7)
    centres = np.array([r["center"] for r in held.orderBy("cluster").collect()])
    cell = np.array([r["cluster"] for r in labelled.orderBy("id").collect()])
    assert (cell == ((m[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert np.allclose(centres, [m[cell == c].mean(axis=0) for c in range(7)])


def test_core_set_covers_within_four_times_the_best(spark):
    m = np.random.default_rng(2).normal(size=(400, 4))
    df = frame(spark, m).repartition(7)
    radius = lambda c: max(np.linalg.norm(m[c] - x, axis=1).min() for x in m)
    assert radius(ids(select.fps_selection(df, 12, mode="coreset"))) <= 4 * radius(ids(select.fps_selection(df, 12)))


def test_empty_table(spark):
    df = frame(spark, np.eye(2)).limit(0)
    assert ids(select.random_selection(df, 3)) == [] and ids(select.fps_selection(df, 3)) == []


@pytest.mark.parametrize("k", [6, 20])
def test_copies_take_no_rounds_of_their_own(spark, k, monkeypatch):
    """Six vectors of 40 copies each: six picks need two rounds, and those at no distance are still the lowest ids."""
    m = np.repeat(np.random.default_rng(2).normal(size=(6, 3)), 40, axis=0)[np.random.default_rng(3).permutation(240)]
    df, own, rounds = frame(spark, m).repartition(3), select._rounds, []
    want = ids(select.fps_selection(df, k))
    send = type(spark.sparkContext).broadcast
    monkeypatch.setattr(select, "_rounds", lambda df, k, first: own(df, k, first, 18))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: (rounds.append(value), send(self, value))[1])
    assert ids(select.fps_selection(df, k, task_numbers=0)) == want
    assert k > 6 or len(rounds) <= 2
