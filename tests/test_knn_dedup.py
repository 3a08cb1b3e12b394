from __future__ import annotations

import numpy as np
import pytest

from harvestry.operators import dedup, knn

SF = "/root/testdata/{}/embeddings.parquet"


def frame(spark, m, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, embedding array<double>")


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("block", [7, 4096])
def test_nearest_equals_brute_force(spark, metric, block):
    m = np.random.default_rng(4).integers(-3, 4, (60, 3)).astype(float)
    got = knn.nearest(frame(spark, m).repartition(3), frame(spark, m).repartition(5), 6, metric, block=block).collect()
    n = np.linalg.norm(m, axis=1, keepdims=True)
    u = m / np.where(n == 0, 1, n)
    for i in range(len(m)):
        value = {"cosine": u @ u[i], "ip": m @ m[i], "l2": np.linalg.norm(m - m[i], axis=1)}[metric]
        mine = sorted((r for r in got if r["src_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5, 6]
        best = np.sort(value)[:6] if metric == "l2" else -np.sort(-value)[:6]
        assert np.allclose([r["value"] for r in mine], best)
        assert np.allclose([value[r["dst_id"]] for r in mine], best)


@pytest.mark.parametrize("place", [0, 3, 7])
def test_odd_lengths_and_unusable_vectors_cost_no_other_row(spark, place):
    """A vector of another length meets only its like; null and infinite numbers, NaN, null and empty vectors and null ids are left out."""
    good = [[1.0, float(i)] for i in range(7)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows[place:place] = [(100, [1.0, 2.0, 3.0])]
    rows += [(200, [1.0, None]), (201, [float("nan"), 1.0]), (202, [float("inf"), 1.0]), (203, None), (204, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    got = knn.nearest(df, df, 3).collect()
    assert {r["src_id"] for r in got} == {*range(7), 100} and [r["dst_id"] for r in got if r["src_id"] == 100] == [100]
    assert all(sum(r["src_id"] == i for r in got) == 3 for i in range(7))
    assert dedup.deduplicate(df, 0.9999).count() == len(rows)


def clouds(n: int, centres: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centres, 24))[rng.integers(0, centres, n)] + 0.25 * rng.normal(size=(n, 24))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_cells_find_what_they_are_fitted_for(spark, metric):
    df = frame(spark, clouds(3000, 12, 1)).repartition(5)
    index = knn.CellIndex.fit(df, 10, metric, cells=24)
    asked = df.where("id % 20 = 0")
    pairs = lambda i: {(r["src_id"], r["dst_id"]) for r in knn.nearest(asked, df, 10, metric, block=128, index=i).collect()}
    exact, found = pairs(None), pairs(index)
    assert len(exact & found) >= 0.9 * len(exact) and index.probes < 24


def test_cells_of_random_vectors_probe_as_many_as_they_need(spark):
    df = spark.read.parquet(SF.format("sf0.1")).selectExpr("vec_id AS id", "embedding")
    index = knn.CellIndex.fit(df, 10, cells=16)
    asked = df.where("id % 50 = 0")
    pairs = lambda i: {(r["src_id"], r["dst_id"]) for r in knn.nearest(asked, df, 10, index=i).collect()}
    exact = pairs(None)
    recall = len(exact & pairs(index)) / len(exact)
    print(f"recall {recall:.3f} with {index.probes} of 16 cells")
    assert recall >= 0.9


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.97])
def test_cells_lose_no_similar_pair(spark, threshold):
    m = clouds(600, 6, 2)
    df = frame(spark, m).repartition(3)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = u @ u.T
    want = {(i, j) for i in range(600) for j in range(i + 1, 600) if sims[i, j] > threshold}
    index = knn.CellIndex.fit(df, cells=16)
    for i in (None, index):
        rows = knn.similar_pairs(df, threshold, block=64, index=i).collect()
        assert {(r["src_id"], r["dst_id"]) for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("indexed", [False, True])
def test_no_cap_on_copies(spark, indexed):
    m = np.concatenate([np.repeat(clouds(4, 4, 3), 40, axis=0), clouds(60, 5, 4)])
    m = m[np.random.default_rng(0).permutation(len(m))]
    df = frame(spark, m).repartition(3)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    edges = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(u @ u.T > 0.9, 1)), strict=True)]
    index = knn.CellIndex.fit(df, cells=6) if indexed else None
    kept = {r["id"] for r in dedup.deduplicate(df, 0.9, None, index=index).collect()}
    assert kept == set(range(len(m))) - scan(edges)


def test_index_refuses_unlike_lengths_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, embedding array<double>")
    with pytest.raises(ValueError):
        knn.CellIndex.fit(df)
    assert knn.nearest(df.limit(0), df.limit(0), 3, index=knn.CellIndex.fit(df.limit(0))).collect() == []


def test_ties_go_to_the_lowest_id(spark):
    got = knn.nearest(frame(spark, [[1, 0]], 100), frame(spark, [[1, 0]] * 30).repartition(4), 5).orderBy("rank").collect()
    assert [r["dst_id"] for r in got] == [0, 1, 2, 3, 4]


def scan(edges: list[tuple[int, int]]) -> set[int]:
    gone: set[int] = set()
    for i in sorted({a for a, _ in edges}):
        if i not in gone:
            gone |= {b for a, b in edges if a == i}
    return gone


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("last_edges", [0, 20, 1 << 20])
def test_rounds_equal_the_scan(spark, seed, last_edges):
    rng = np.random.default_rng(seed)
    edges = sorted({(int(min(p)), int(max(p))) for p in rng.integers(0, 40, (70, 2)) if p[0] != p[1]})
    got = {r["id"] for r in dedup.greedy_dropped(spark.createDataFrame(edges, "src_id long, dst_id long"), last_edges).collect()}
    assert got == scan(edges)


def test_chain_keeps_every_other(spark):
    angle = np.arange(5) * 0.3
    df = frame(spark, np.column_stack([np.cos(angle), np.sin(angle)]))
    assert sorted(r["id"] for r in dedup.deduplicate(df, 0.95).collect()) == [0, 2, 4]


def test_the_cap_on_neighbours(spark):
    df = frame(spark, [[1.0, 0.0]] * 15)
    kept = sorted(r["id"] for r in dedup.deduplicate(df, 0.95, k=10).collect())
    # 0 drops 1..9; of 10..14 each has the ten lowest ids as its neighbours, none of them later
    assert kept == [0, 10, 11, 12, 13, 14]
    assert sorted(r["id"] for r in dedup.deduplicate(df, 0.95, k=15).collect()) == [0]


@pytest.mark.parametrize(("sf", "t", "kept"), [("sf0.01", 0.35, 332), ("sf0.01", 0.30, 202), ("sf0.1", 0.30, 477), ("sf0.1", 0.35, 799)])
def test_golden_counts(spark, sf, t, kept):
    df = spark.read.parquet(SF.format(sf)).selectExpr("vec_id AS id", "embedding")
    assert dedup.deduplicate(df, t).count() == kept


def test_zero_vectors_nulls_and_empty(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None)], "id long, embedding array<double>")
    assert sorted(r["id"] for r in dedup.deduplicate(df).collect()) == [0, 1, 2, 4]
    assert dedup.deduplicate(df.limit(0)).collect() == []


@pytest.mark.parametrize("sent_numbers", [0, 1 << 20])
def test_nearest_distance_is_the_least_of_all(spark, sent_numbers):
    """By rows sent to the tasks and by blocks: repeated ids, groups, vectors of other lengths (which meet their like alone) and unusable ones."""
    m = np.random.default_rng(6).integers(-3, 4, (90, 3)).astype(float)
    rows = [*((i % 80, v.tolist()) for i, v in enumerate(m)), (200, [1.0, 5.0]), (201, [1.0]), (202, None), (203, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    chosen = spark.createDataFrame([*((i, m[i].tolist(), "ab"[i % 2]) for i in range(12)), (20, [4.0, 1.0], "a")], "id long, embedding array<double>, grp string").repartition(4)
    want = {}
    for i, v in enumerate(m):
        for k in range(12):
            for key in ((i % 80, None), (i % 80, "ab"[k % 2])):
                want[key] = min(want.get(key, np.inf), float(np.linalg.norm(v - m[k])))
    want |= {(200, None): 5.0, (200, "a"): 5.0}
    got = [((r["id"], None), r["distance"]) for r in knn.nearest_distance(df, chosen, sent_numbers=sent_numbers).collect()]
    got += [((r["id"], r["grp"]), r["distance"]) for r in knn.nearest_distance(df, chosen, group="grp", sent_numbers=sent_numbers).collect()]
    assert len(got) == len(want) and dict(got).keys() == want.keys() and all(abs(want[k] - d) < 1e-12 for k, d in got)
    assert knn.nearest_distance(df, chosen.limit(0), sent_numbers=sent_numbers).count() == 0


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nearest_distance_reads_rows_once(spark, no_broadcast):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    m = np.random.default_rng(3).normal(size=(60, 4))
    df = frame(spark, m).repartition(6).mapInArrow(counted, "id long, embedding array<double>")
    assert len(knn.nearest_distance(df, frame(spark, m[:20]).repartition(5)).collect()) == 60 and read.value == 60


def test_norm_is_computed_once_a_row(spark):
    from harvestry.functions.vectors import l2_normalize

    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [])], "id long, v array<double>").select("id", l2_normalize("v").alias("u"))
    assert {r["id"]: r["u"] for r in df.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None, 4: []}
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1
