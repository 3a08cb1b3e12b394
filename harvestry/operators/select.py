"""Diverse selection: random, cluster medoids, farthest points, hybrid, spectral, incremental. Each gives (rank, id)."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.operators.knn import CellIndex, distances, matrix_of, nearest, nearest_distance, pack, usable
from harvestry.workdir import written

log = logging.getLogger(__name__)
METHODS = ("random", "kmeans", "fps", "hybrid", "spectral")
#: Numbers that one task may hold for the exact farthest-point kernel: half a GB of doubles. Beyond it the same points are found in rounds.
EXACT_NUMBERS = 1 << 26
#: Numbers of candidates' vectors that a round takes to the driver.
ROUND_NUMBERS = 1 << 18


def farthest(m: np.ndarray, k: int, first: int | None = 0, least: np.ndarray | None = None) -> np.ndarray:
    """Greedy k-centre over the rows of m: indices in order of selection, no row twice, ties to the lowest index.

    Each step updates the least squared distance to what is selected, so the cost is rows x k x length. With `least`, the squared distances to
    what is selected already, the first pick is the farthest row, as it is with first=None.
    """
    n = len(m)
    k = min(k, n)
    out = np.empty(k, dtype=np.int64)
    least = np.full(n, np.inf) if least is None else least.astype(float)
    for step in range(k):
        at = first if step == 0 and first is not None else int(least.argmax())
        out[step] = at
        np.minimum(least, ((m - m[at]) ** 2).sum(axis=1), out=least)
        least[out[: step + 1]] = -1
    return out


def random_selection(df: DataFrame, k: int, seed: int = 42, key: str = "id") -> DataFrame:
    """k rows without replacement, in the order of an MD5 of id and seed."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    top = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), draw.alias("draw")).orderBy("draw", "id").limit(k)
    return top.select(F.row_number().over(Window.orderBy("draw", "id")).alias("rank"), "id")


def _one_task(df: DataFrame, k: int, first_id: int | None) -> DataFrame:
    """df: (id, v, least), least null where nothing is selected yet."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        m, ids, least = np.stack(pdf["v"].to_numpy()).astype(float), pdf["id"].to_numpy(), pdf["least"].to_numpy(dtype=float)
        if np.isnan(least).all():
            picks = farthest(m, k, int(np.flatnonzero(ids == first_id)[0]) if first_id is not None and (ids == first_id).any() else 0)
        else:
            picks = farthest(m, k, None, np.nan_to_num(least, nan=np.inf))
        return pd.DataFrame({"rank": np.arange(1, len(picks) + 1, dtype=np.int32), "id": ids[picks]})

    return df.withColumn("g", F.lit("all")).groupBy("g").applyInPandas(run, "rank int, id long")


def _foremost(ids: np.ndarray, x: np.ndarray, far: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n farthest rows, ties to the lowest id; of equal vectors the first alone, as the others are at no distance once it is picked."""
    order = np.lexsort((ids, -far))
    _, first = np.unique(np.ascontiguousarray(x[order]).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_index=True)
    at = order[np.sort(first)[:n]]
    return ids[at], x[at], far[at]


def _rounds(df: DataFrame, k: int, first_id: int | None, candidates: int | None = None) -> DataFrame:
    """The same picks as in one task, in distributed rounds over (id, v, least).

    Each round finds the rows farthest from all picks so far, a bounded number of them, and takes them to the driver. There the greedy steps go on
    among them as long as the next pick is farther than the row that just missed the round was, which bounds all others, as distances only shrink. The picks,
    a selection of k rows, are sent to the tasks of the next round; nothing else is kept between rounds. Without anchors a task gives no more than its own foremost rows;
    equal vectors it leaves out come behind the first of them, and after it only rows at no distance, so steps at no distance begin a round each.
    """
    spark = df.sparkSession
    blocks = written(pack(df.select("id", "v"), "id", "v"), "blocks")
    start = written(df.where("least IS NOT NULL").select("id", "least"), "least")
    anchored = not start.isEmpty()
    dim = blocks.select("dim").first()
    if dim is None or k < 1:
        return spark.createDataFrame([], "rank int, id long")
    m = candidates or max(2, ROUND_NUMBERS // max(1, dim[0]))
    picks: list[tuple[int, np.ndarray]] = []
    if not anchored:
        own = df.where(F.col("id") == first_id) if first_id is not None else df.limit(0)
        row = own.select("id", "v").first() or df.orderBy("id").select("id", "v").first()
        picks.append((row[0], np.array(row[1], dtype=float)))
    while len(picks) < k:
        taken, held = np.array(sorted(i for i, _ in picks), dtype=np.int64), np.array([v for _, v in picks]).reshape(len(picks), dim[0])
        shared = spark.sparkContext.broadcast((taken, held))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            taken, held = shared.value  # noqa: B023
            out = lambda ids, x, far: pa.RecordBatch.from_arrays([pa.array(ids), pa.array([row.tobytes() for row in x], pa.binary()), pa.array(far)], names=["id", "v", "far"])
            kept, edge = None, -np.inf
            for batch in batches:
                for r in range(batch.num_rows):
                    ids, x = batch.column(0)[r].values.to_numpy(zero_copy_only=False), matrix_of(batch.column(2)[r].as_py(), batch.column(1)[r].as_py())
                    least = np.full(len(ids), np.inf)
                    for p in held:
                        np.minimum(least, ((x - p) ** 2).sum(axis=1), out=least)
                    free = np.flatnonzero(~np.isin(ids, taken) & (least >= edge))
                    own = ids[free], x[free], least[free]
                    if anchored:
                        yield out(*own)
                    elif len(free):
                        kept = _foremost(*(own if kept is None else (np.concatenate(c) for c in zip(kept, own, strict=True))), m + 1)
                        edge = kept[2][-1] if len(kept[2]) > m else -np.inf
            if kept is not None:
                yield out(*kept)

        far = blocks.mapInArrow(run, "id long, v binary, far double")
        if anchored:
            far = far.join(start, "id", "left").withColumn("far", F.least("far", F.coalesce("least", F.lit(float("inf"))))).drop("least")
        top = far.orderBy(F.desc("far"), "id").limit(m + 1).collect()
        if not top:
            break
        bound, rest = ((top[m]["far"], top[m]["id"]) if len(top) > m else (-np.inf, 0)), sorted(top[:m], key=lambda r: r["id"])
        ids, x, least = np.array([r["id"] for r in rest]), np.array([np.frombuffer(r["v"]) for r in rest]), np.array([r["far"] for r in rest])
        had = len(picks)
        while len(picks) < k:
            at = int(least.argmax())
            if least[at] < 0 or (least[at], -ids[at]) < (bound[0], -bound[1]) or (least[at] == 0 and len(picks) > had and not anchored):
                break
            picks.append((int(ids[at]), x[at]))
            np.minimum(least, ((x - x[at]) ** 2).sum(axis=1), out=least)
            least[at] = -1
    return spark.createDataFrame([(n + 1, i) for n, (i, _) in enumerate(picks[:k])], "rank int, id long")


def core_set(df: DataFrame, k: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """k farthest points of each partition, to choose from.

    A partition of one chunk (4 k + 8192 rows) gives a composable core-set, whose farthest points are a 4-approximation of the whole's. Longer
    partitions are cut down chunk by chunk, each time with an error of its own radius, so the bound is 4 only for partitions of one chunk and 2 more for each further
    one; the points also depend on how rows are partitioned. What meets in one task is k rows for each partition.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows = np.zeros(0, dtype=np.int64), None
        for pdf in frames:
            if not len(pdf):
                continue
            more = np.stack(pdf["v"].to_numpy()).astype(float)
            ids, rows = np.r_[ids, pdf["id"].to_numpy()], more if rows is None else np.vstack([rows, more])
            if len(ids) > 4 * k + 8192:
                order = np.argsort(ids, kind="stable")
                picks = farthest(rows[order], k)
                ids, rows = ids[order][picks], rows[order][picks]
        if rows is not None:
            order = np.argsort(ids, kind="stable")
            picks = farthest(rows[order], k)
            yield pd.DataFrame({key: ids[order][picks], vector: list(rows[order][picks])})

    own = df.where(usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL")
    return own.mapInPandas(run, f"`{key}` long, `{vector}` array<double>")


def fps_selection(df: DataFrame, k: int, first_id: int | None = None, anchors: DataFrame | None = None, mode: str = "exact", key: str = "id", vector: str = "embedding", task_numbers: int = EXACT_NUMBERS) -> DataFrame:
    """Farthest-point selection from the first id (default: the lowest), or away from the rows of `anchors`.

    mode exact: the greedy picks at any size, in one task while the vectors have at most `task_numbers` numbers in all, and in rounds beyond, which give the
    same picks. coreset: approximate, only if asked for; the core-set is then searched exactly. Anchors may be many: what is known of them is each row's distance to the nearest one.
    Rows without a usable vector (see `knn.usable`) are never picked; vectors should have one length.
    """
    if mode not in ("exact", "coreset"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "coreset":
        chosen = core_set(df, k, key, vector)
        if first_id is not None:
            chosen = chosen.unionByName(df.where(F.col(key) == first_id).select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))).dropDuplicates([key])
        df = written(chosen, "coreset")
    own = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    if anchors is None:
        own = own.withColumn("least", F.lit(None).cast("double"))
    else:
        near = nearest_distance(df, anchors, key, vector).select(F.col("id").alias("_id"), (F.col("distance") * F.col("distance")).alias("least"))
        own = written(own.join(near, F.col("id") == F.col("_id"), "left").drop("_id"), "anchored")
    size = own.select(F.sum(F.size("v").cast("long"))).first()[0] or 0
    return _one_task(own, k, first_id) if size <= task_numbers else _rounds(own, k, first_id)


def refine(df: DataFrame, initial: DataFrame, target: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """initial (rank, id), and then the rows farthest from all selected until there are `target`."""
    have = initial.count()
    if have >= target:
        return initial
    inside = df.join(initial.select(F.col("id").alias(key)), key, "left_semi")
    rest = df.join(initial.select(F.col("id").alias(key)), key, "left_anti")
    more = fps_selection(rest, target - have, anchors=inside, key=key, vector=vector)
    return initial.select(F.col("rank").cast("int"), "id").unionByName(more.select((F.col("rank") + have).cast("int").alias("rank"), "id"))


def _sums(keys: list[str]):
    """Adds the counts and vectors of a group of partial sums (cluster, salt, n, total)."""

    def run(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, dtype=np.float64) for t in table["total"].to_pylist())
        return pa.table([*(table[k][:1] for k in keys), pa.array([sum(table["n"].to_pylist())], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=[*keys, "n", "total"])

    return run


def kmeans_clusters(df: DataFrame, k: int, seed: int = 42, iterations: int = 100, key: str = "id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """((id, embedding, cluster), (cluster, center)) by Lloyd's rounds from k rows drawn by an MD5 of id and seed; as many clusters as rows at most.

    A round is one pass over packed blocks, whose sums of each cluster are added in two steps, and stops at `iterations` or once no center moves by more than 1e-12.
    Only the centers are held by the driver and sent to the tasks. A row goes to the first of equally near centers; a center without rows stays.
    """
    own = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("embedding"))
    k = min(k, own.count())
    spark = df.sparkSession
    if k < 2:
        one = own.agg(F.count("*").alias("n")).where("n > 0").select(F.lit(0).alias("cluster"), F.array().cast("array<double>").alias("center"))
        return own.withColumn("cluster", F.lit(0)), one
    first = random_selection(own, k, seed).join(own, "id").orderBy("rank").select("embedding").collect()
    centers = np.array([r[0] for r in first])
    blocks = written(pack(own), "blocks")

    def cells(centers: np.ndarray):
        shared = spark.sparkContext.broadcast(centers)

        def of(batch: pa.RecordBatch, r: int) -> tuple[list, np.ndarray, np.ndarray]:
            x = matrix_of(batch.column(2)[r].as_py(), batch.column(1)[r].as_py())
            return batch.column(0)[r].as_py(), x, distances(x, shared.value, "l2").argmin(axis=1)

        return of

    for _ in range(iterations):
        of = cells(centers)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(len(centers), dtype=np.int64), np.zeros_like(centers)  # noqa: B023
            for batch in batches:
                for r in range(batch.num_rows):
                    _, x, cell = of(batch, r)  # noqa: B023
                    np.add.at(total, cell, x)
                    count += np.bincount(cell, minlength=len(count))
            some = np.flatnonzero(count)
            salt = np.full(len(some), TaskContext.get().partitionId() % 64)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(count[some]), pa.array([total[c].tobytes() for c in some], pa.binary())], names=["cluster", "salt", "n", "total"])

        sums = blocks.mapInArrow(part, "cluster int, salt int, n long, total binary")
        sums = sums.groupBy("cluster", "salt").applyInArrow(_sums(["cluster", "salt"]), "cluster int, salt int, n long, total binary")
        moved = centers.copy()
        for r in sums.groupBy("cluster").applyInArrow(_sums(["cluster"]), "cluster int, n long, total binary").collect():
            moved[r["cluster"]] = np.frombuffer(r["total"], dtype=np.float64) / r["n"]
        shift, centers = float(np.abs(moved - centers).max()), moved
        if shift <= 1e-12:
            break
    of = cells(centers)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, x, cell = of(batch, r)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(cell.astype(np.int32))], names=["id", "embedding", "cluster"])

    held = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "cluster int, center array<double>")
    return blocks.mapInArrow(label, "id long, embedding array<double>, cluster int"), held


def medoids(df: DataFrame, centers: DataFrame, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(cluster, id, distance): the row of df nearest to each center (any row, as a center's search is over all), ties to the lowest id."""
    found = nearest(centers.select(F.col("cluster").cast("long").alias(key), F.col("center").alias(vector)), df, 1, "l2", key, vector)
    return found.select(F.col("src_id").alias("cluster"), F.col("dst_id").alias("id"), F.col("value").alias("distance"))


def _ranked(ids: DataFrame) -> DataFrame:
    return ids.select(F.row_number().over(Window.orderBy("id")).alias("rank"), "id")


def kmeans_selection(df: DataFrame, k: int, seed: int = 42, top_up: bool = False, key: str = "id", vector: str = "embedding", iterations: int = 100) -> DataFrame:
    """Distinct medoids of k clusters; with top_up, farthest points until there are k."""
    labelled, centers = kmeans_clusters(df, k, seed, iterations, key, vector)
    if k < 2:
        return _ranked(labelled.orderBy("id").limit(k).select("id"))
    chosen = _ranked(medoids(labelled, centers).select("id").distinct())
    return refine(df, chosen, min(k, labelled.count()), key, vector) if top_up else chosen


def hybrid_from_clusters(labelled: DataFrame, k: int, clusters: int, key: str = "id", vector: str = "embedding", cluster: str = "cluster", task_numbers: int = EXACT_NUMBERS) -> DataFrame:
    """Farthest points within each cluster by a quota, refined or trimmed by farthest points to k rows.

    The quota of a cluster is min(size, max(1, int((k // clusters) * 1.2))). A cluster of at most `task_numbers` numbers is one task's; each larger one (few can be, as all
    of them hold that much) is worked off by `fps_selection`'s rounds.
    """
    quota = max(1, int((k // max(1, clusters)) * 1.2))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        picks = farthest(np.stack(pdf["v"].to_numpy()).astype(float), min(quota, len(pdf)))
        return pd.DataFrame({"id": pdf["id"].to_numpy()[picks]})

    own = labelled.where(usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(cluster).alias("c")).where("id IS NOT NULL")
    large = [r["c"] for r in own.groupBy("c").agg(F.sum(F.size("v").cast("long")).alias("n")).where(F.col("n") > task_numbers).collect()]
    of_task = own.where(~F.coalesce(F.col("c").isin(large), F.lit(False))) if large else own
    chosen = of_task.groupBy("c").applyInPandas(run, "id long")
    for c in large:
        chosen = chosen.unionByName(fps_selection(own.where(F.col("c").eqNullSafe(F.lit(c))), quota, key="id", vector="v", task_numbers=task_numbers).select("id"))
    picks = written(chosen, "picks")
    have, total = picks.count(), own.count()
    k = min(k, total)
    if have > k:
        return fps_selection(labelled.join(picks.select(F.col("id").alias(key)), key, "left_semi"), k, key=key, vector=vector, task_numbers=task_numbers)
    return refine(labelled, _ranked(picks), k, key, vector)


def hybrid_selection(df: DataFrame, k: int, clusters: int | None = None, seed: int = 42, key: str = "id", vector: str = "embedding", iterations: int = 100) -> DataFrame:
    clusters = min(clusters or max(100, k // 10), df.count())
    labelled, _ = kmeans_clusters(df, clusters, seed, iterations, key, vector)
    return hybrid_from_clusters(labelled, k, max(1, clusters))


def spectral_selection(df: DataFrame, k: int, neighbours: int = 10, key: str = "id", vector: str = "embedding", index: CellIndex | None = None) -> DataFrame:
    """Power-iteration clusters over nearest-neighbour affinities, and the row nearest to each cluster's mean. With an index, neighbours are searched by cells."""
    own = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("embedding"))
    k = min(k, own.count())
    if k < 2:
        return _ranked(own.orderBy("id").limit(k).select("id"))
    edges = nearest(own, own, neighbours + 1, "cosine", index=index).where("src_id < dst_id").select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), F.greatest(F.lit(1e-6), F.col("value")).alias("weight"))
    labels = PowerIterationClustering(k=k, maxIter=20, initMode="degree", weightCol="weight").assignClusters(edges)
    rows = own.join(labels.select("id", F.col("cluster").alias("c")), "id").select("id", "c", F.posexplode("embedding").alias("i", "x"))
    centers = rows.groupBy("c", "i").agg(F.avg("x").alias("x")).groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("center"))
    return _ranked(medoids(own, centers.withColumnRenamed("c", "cluster")).select("id").distinct())


def select_diverse(df: DataFrame, k: int, method: str = "hybrid", seed: int = 42, key: str = "id", vector: str = "embedding", **more) -> DataFrame:
    """(rank, id) by the method's name; at most as many rows as df has, with a warning."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(METHODS)}")
    n = df.count()
    if k > n:
        log.warning("%d rows are asked for, there are %d", k, n)
        k = n
    if method == "random":
        return random_selection(df, k, seed, key)
    if method == "kmeans":
        return kmeans_selection(df, k, seed, key=key, vector=vector, **more)
    if method == "fps":
        return fps_selection(df, k, key=key, vector=vector, **more)
    if method == "hybrid":
        return hybrid_selection(df, k, seed=seed, key=key, vector=vector, **more)
    return spectral_selection(df, k, key=key, vector=vector, **more)


def incremental_selection(df: DataFrame, prior: DataFrame, more: int, anchored: bool = False, key: str = "id", vector: str = "embedding") -> DataFrame:
    """prior (rank, id), and `more` rows that it doesn't have; anchored: far from the prior ones too."""
    if anchored:
        return refine(df, prior, prior.count() + more, key, vector)
    rest = df.join(prior.select(F.col("id").alias(key)), key, "left_anti")
    have = prior.count()
    added = fps_selection(rest, more, key=key, vector=vector)
    return prior.select(F.col("rank").cast("int"), "id").unionByName(added.select((F.col("rank") + have).cast("int").alias("rank"), "id"))
