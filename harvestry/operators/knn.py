"""Nearest neighbours by blocks of vectors: exact over all blocks, or over the cells of a coarse index.

Rows are packed into blocks (ids and a float matrix as bytes, at most BLOCK rows each). A block of queries meets a block of the
base in one matrix product, and only the best k of each query leave it; a second step merges the blocks. What is shuffled is k rows
for each query and base block, never all pairs.

Exact search lets every block of queries meet every block of the base: work is rows x rows. With a `CellIndex` each row of the base is kept
in the cell of its nearest centre, and queries meet the blocks of their nearest cells only, so work falls by the number of cells over the
cells probed. Cells are dealt out in blocks, however many rows they have, so a cell with a third of all rows is many units of work.

Rows with a null key, and vectors that are null, empty, or hold a null, NaN or infinite number, are left out on both sides: they have no
neighbours and are none. Vectors meet only vectors of their own length. Rows that repeat an id are rows of their own; ties go to the lowest id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.workdir import written

BLOCK = 4096
#: Rows that centres are learned from, and the most centres: bounds of what reaches the driver.
SAMPLE, MOST_CELLS = 16_384, 4096
#: Numbers of selected rows' vectors that are sent to every task (8 MB of doubles), and distances that a task holds at once.
SENT_NUMBERS, MET_NUMBERS = 1 << 20, 1 << 21


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: numbers, and nothing but finite ones."""
    v = vector.cast("array<double>")
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def _own(df: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), *more)


def _matrix(rows: pa.Array) -> bytes:
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).tobytes()


def pack(df: DataFrame, key: str = "id", vector: str = "embedding", block: int = BLOCK, prefix: str = "", group: str | None = None) -> DataFrame:
    """(ids, dim, matrix, grp): rows of a partition in blocks of one vector length and, with `group`, of one value of that column."""
    names = [f"{prefix}{c}" for c in ("ids", "dim", "matrix", "grp")]

    def flush(ids: list, rows: list, dim: int, value: str | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([dim], pa.int32()), pa.array([np.asarray(rows, dtype=np.float64).tobytes()], pa.binary()), pa.array([value], pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[list, list]] = {}
        for batch in batches:
            for i, row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ids, rows = held.setdefault((len(row), value), ([], []))
                ids.append(i)
                rows.append(row)
                if len(ids) >= block:
                    yield flush(ids, rows, len(row), value)
                    del held[len(row), value]
        for (dim, value), (ids, rows) in held.items():
            yield flush(ids, rows, dim, value)

    own = _own(df, key, vector, (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("g"))
    return own.mapInArrow(run, f"{names[0]} array<long>, {names[1]} int, {names[2]} binary, {names[3]} string")


def matrix_of(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, dim)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows over their norms; zero rows stay."""
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Smaller is nearer: squared Euclidean distance, or the negative inner product."""
    if metric == "ip":
        return -(a @ b.T)
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0)


Meet = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def best(k: int, metric: str) -> Meet:
    """The k best of a block of the base for each query of a block: source ids, target ids and values."""
    near = "ip" if metric in ("cosine", "ip") else "l2"

    def run(qi: np.ndarray, a: np.ndarray, dst: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = distances(a, b, near)
        m = min(k, len(b))
        if m < len(b):  # all that tie with the m-th are sorted, so that the lowest ids win
            edge = np.partition(d, m - 1, axis=1)[:, m - 1 : m]
            found = [np.flatnonzero(row <= e) for row, e in zip(d, edge, strict=True)]
        else:
            found = [np.arange(len(b))] * len(a)
        found = [x[np.argsort(row[x], kind="stable")[:m]] for x, row in zip(found, d, strict=True)]
        pick, own = np.concatenate(found), np.repeat(np.arange(len(a)), m)
        value = -d[own, pick] if near == "ip" else np.sqrt(((a[own] - b[pick]) ** 2).sum(axis=1))
        return qi[own], dst[pick], value

    return run


def over(threshold: float) -> Meet:
    """All pairs of a smaller and a larger id whose inner product is over the threshold."""

    def run(qi: np.ndarray, a: np.ndarray, dst: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value = a @ b.T
        i, j = np.nonzero((value > threshold) & (qi[:, None] < dst[None, :]))
        return qi[i], dst[j], value[i, j]

    return run


def _met(blocks: DataFrame, meet: Meet, normalize: bool, grouped: bool) -> DataFrame:
    """(src_id, dst_id, value, grp) of all pairs of blocks in a row; blocks of unlike length have nothing in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                qi, qd, qm, bi, bd, bm, grp = (batch.column(c)[r] for c in ("qids", "qdim", "qmatrix", "bids", "bdim", "bmatrix", "bgrp"))
                if qd.as_py() != bd.as_py():
                    continue
                src, dst = qi.values.to_numpy(zero_copy_only=False), bi.values.to_numpy(zero_copy_only=False)
                a, b = matrix_of(qm.as_py(), qd.as_py()), matrix_of(bm.as_py(), bd.as_py())
                order = np.argsort(dst, kind="stable")
                b, dst = b[order], dst[order]
                if normalize:
                    a, b = unit(a), unit(b)
                for at in range(0, len(a), 512):
                    s, t, value = meet(src[at : at + 512], a[at : at + 512], dst, b)
                    yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(t), pa.array(value), pa.array([grp.as_py()] * len(s), pa.string())], names=["src_id", "dst_id", "value", "grp"])

    out = blocks.mapInArrow(run, "src_id long, dst_id long, value double, grp string")
    return out if grouped else out.drop("grp")


def kmeans(m: np.ndarray, k: int, rounds: int = 10, seed: int = 42) -> np.ndarray:
    """Centres of a bounded sample by Lloyd's rounds from random rows; empty cells keep their centre."""
    centres = m[np.random.default_rng(seed).choice(len(m), k, replace=False)].copy()
    for _ in range(rounds):
        cell = distances(m, centres, "l2").argmin(axis=1)
        count = np.bincount(cell, minlength=k)
        for j in range(m.shape[1]):
            total = np.bincount(cell, weights=m[:, j], minlength=k)
            centres[count > 0, j] = total[count > 0] / count[count > 0]
    return centres


@dataclass
class CellIndex:
    """Centres over (unit, for cosine) vectors of one length, and how many cells a query probes."""

    centres: np.ndarray
    probes: int
    normalize: bool = True

    @classmethod
    def fit(cls, df: DataFrame, k: int = 10, metric: str = "cosine", cells: int | None = None, recall: float = 0.95, sample: int = SAMPLE, block: int = BLOCK, seed: int = 42, key: str = "id", vector: str = "embedding") -> CellIndex:
        """Centres from at most `sample` rows drawn by a hash of their id, and as many probes as hold `recall` of the k nearest of 512 of them among the sample.

        cells defaults to one for each block of rows, MOST_CELLS and a sixteenth of the sample at most. ValueError for vectors of unlike lengths.
        """
        own = _own(df, key, vector)
        n, lo, hi = own.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
        if lo != hi:
            raise ValueError(f"vectors of {lo} to {hi} numbers")
        if not n:
            return cls(np.zeros((1, 1)), 1, metric == "cosine")
        rows = own.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).toArrow()["v"].combine_chunks()
        m = np.frombuffer(_matrix(rows), dtype=np.float64).reshape(-1, lo)
        m = unit(m) if metric == "cosine" else m
        centres = kmeans(m, min(cells or -(-n // block), MOST_CELLS, max(1, len(m) // 16)), seed=seed)
        cell, asked = distances(m, centres, "l2").argmin(axis=1), m[:512]
        d = distances(asked, m, "l2")
        near = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(m))]
        place = np.argsort(np.argsort(distances(asked, centres, "l2"), axis=1, kind="stable"), axis=1)
        at = np.take_along_axis(place, cell[near], axis=1).ravel()  # of each true neighbour's cell in its query's order
        return cls(centres, int(np.sort(at)[max(0, int(np.ceil(recall * len(at))) - 1)]) + 1, metric == "cosine")

    def cells(self, df: DataFrame, key: str, vector: str, reach: float | None = None, probes: int = 1) -> DataFrame:
        """(id, v, cell): each row in its `probes` nearest cells or, with `reach`, in all whose centre is at most that much farther off than the nearest one."""
        centres, normalize = self.centres, self.normalize

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    if not part.num_rows:
                        continue
                    m = np.frombuffer(_matrix(part.column(1)), dtype=np.float64).reshape(-1, centres.shape[1])
                    d = np.sqrt(distances(unit(m) if normalize else m, centres, "l2"))
                    if reach is None:
                        cell = np.argsort(d, axis=1, kind="stable")[:, :probes]
                        row = np.repeat(np.arange(len(m)), cell.shape[1])
                    else:
                        row, cell = np.nonzero(d <= d.min(axis=1, keepdims=True) + reach + 1e-9)
                    where = pa.array(row)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(where), part.column(1).take(where), pa.array(cell.ravel().astype(np.int32))], names=["id", "v", "cell"])

        return _own(df, key, vector).mapInArrow(run, "id long, v array<double>, cell int")

    def blocks(self, placed: DataFrame, prefix: str, block: int) -> DataFrame:
        """(cell, blk, ids, dim, matrix) of placed rows: a cell's rows are dealt by a hash of their id to as many blocks as it needs."""
        sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("of"))
        dealt = placed.join(F.broadcast(sizes), "cell").withColumn("blk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("of")))  # one row a cell, MOST_CELLS at most
        names = ["cell", f"{prefix}blk", f"{prefix}of", f"{prefix}ids", f"{prefix}dim", f"{prefix}matrix"]

        def run(table: pa.Table) -> pa.Table:
            rows = table["v"].combine_chunks()
            return pa.table([table["cell"][:1], table["blk"][:1], table["of"][:1], pa.array([table["id"].to_pylist()], pa.list_(pa.int64())), pa.array([len(rows[0])], pa.int32()), pa.array([_matrix(rows)], pa.binary())], names=names)

        return dealt.groupBy("cell", "blk").applyInArrow(run, f"cell int, {names[1]} long, {names[2]} long, {names[3]} array<long>, {names[4]} int, {names[5]} binary")

    def meetings(self, queries: DataFrame, base: DataFrame, block: int) -> DataFrame:
        """Each block of queries with each block of the base of the same cell, joined by cell and block, so a hot cell's pairs are dealt over tasks."""
        b = written(self.blocks(base, "b", block).withColumn("bgrp", F.lit(None).cast("string")), "cells")
        of = b.select("cell", "bof").distinct()
        q = self.blocks(queries, "q", block).join(F.broadcast(of), "cell").withColumn("bblk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bof") - 1))).drop("bof")
        return q.join(b, ["cell", "bblk"])


def _ranked(found: DataFrame, k: int, ascending: bool, *by: str) -> DataFrame:
    better = F.col("value").asc() if ascending else F.col("value").desc()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("src_id", *by).orderBy(better, "dst_id")))
    return ranked.where(F.col("rank") <= k)


def nearest(queries: DataFrame, base: DataFrame, k: int, metric: str = "cosine", key: str = "id", vector: str = "embedding", block: int = BLOCK, index: CellIndex | None = None, group: str | None = None) -> DataFrame:
    """(src_id, dst_id, rank, value): the k best of the base for each query, ties to the lowest id, the query itself included if it is in the base.

    metric: cosine (vectors are normalised; value is the similarity), ip, or l2 (value is the distance). Two steps: best k by pair of
    blocks, then best k of those. Without an index the search is exact. With one it is over the cells that it probes (cosine and l2 only), which finds about
    as many of the true neighbours as the index was fitted for. With `group` (exact search) the k best of each value of that column of the base, which comes out as `grp`.
    """
    ascending = metric == "l2"
    if index is None:
        blocks = pack(queries, key, vector, block, "q").drop("qgrp").crossJoin(pack(base, key, vector, block, "b", group))
    else:
        blocks = index.meetings(index.cells(queries, key, vector, probes=index.probes), index.cells(base, key, vector), block)
    found = _ranked(_met(blocks, best(k, metric), metric == "cosine", group is not None), k, ascending, *(["grp"] if group else []))
    return found.select("src_id", *(["grp"] if group else []), "dst_id", "rank", "value")


def similar_pairs(df: DataFrame, threshold: float, key: str = "id", vector: str = "embedding", block: int = BLOCK, index: CellIndex | None = None) -> DataFrame:
    """(src_id, dst_id, value) of all pairs src_id < dst_id whose cosine similarity is over the threshold, with no cap.

    With an index no pair is lost either: unit vectors with that similarity are at most e = sqrt(2 - 2 threshold) apart, so a row's home cell is among
    the cells whose centre is at most 2 e farther from its partner than the partner's nearest one, and each row visits all of those. Zero vectors are similar to none, for thresholds from 0 on.
    """
    if index is None:
        blocks = pack(df, key, vector, block, "q").drop("qgrp").crossJoin(pack(df, key, vector, block, "b"))
    else:
        reach = 2 * float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        placed = written(index.cells(df, key, vector, reach=reach), "placed")
        blocks = index.meetings(placed, index.cells(df, key, vector), block)
    return _met(blocks, over(threshold), True, False).select("src_id", "dst_id", "value")


def _least(sent: dict[int, dict[str | None, np.ndarray]], ids: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, grp, distance) of rows of one length to the nearest row of each group of that length."""
    for grp, base in sent.get(m.shape[1], {}).items():
        step = max(1, MET_NUMBERS // len(base))
        for at in range(0, len(m), step):
            a = m[at : at + step]
            pick = base[distances(a, base, "l2").argmin(axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + step]), pa.array([grp] * len(a), pa.string()), pa.array(np.sqrt(((a - pick) ** 2).sum(axis=1)))], names=["id", "grp", "distance"])


def nearest_distance(df: DataFrame, selected: DataFrame, key: str = "id", vector: str = "embedding", group: str | None = None, sent_numbers: int = SENT_NUMBERS) -> DataFrame:
    """(id, distance): Euclidean distance of each row to its nearest selected row; with `group`, (id, grp, distance) for each value of that column of the selected rows.

    The selected rows are packed and written once. While they have at most `sent_numbers` numbers in all they are sent to the tasks, and df is read once. Beyond it df
    is packed and written, too, and blocks meet blocks, so the selected rows may be many.
    """
    base = written(pack(selected, key, vector, prefix="b", group=group), "selected")
    by = ["id", *(["grp"] if group else [])]
    if (base.select(F.sum(F.length("bmatrix"))).first()[0] or 0) > 8 * sent_numbers:
        queries = written(pack(df, key, vector, prefix="q"), "queries")
        found = _met(queries.drop("qgrp").crossJoin(base), best(1, "l2"), False, True).withColumnsRenamed({"src_id": "id", "value": "distance"})
        return found.groupBy(*by).agg(F.min("distance").alias("distance"))
    parts: dict[int, dict[str | None, list[tuple[np.ndarray, np.ndarray]]]] = {}
    for r in base.collect():
        parts.setdefault(r["bdim"], {}).setdefault(r["bgrp"], []).append((np.array(r["bids"]), matrix_of(r["bmatrix"], r["bdim"])))
    sent = {dim: {grp: np.concatenate([m for _, m in own])[np.argsort(np.concatenate([i for i, _ in own]), kind="stable")] for grp, own in groups.items()} for dim, groups in parts.items()}
    shared = df.sparkSession.sparkContext.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column(1).offsets.to_numpy())
            for dim in np.unique(size).tolist():
                own = batch.filter(pa.array(size == dim))
                yield from _least(shared.value, own.column(0).to_numpy(), np.frombuffer(_matrix(own.column(1)), dtype=np.float64).reshape(-1, dim))

    return _own(df, key, vector).mapInArrow(run, "id long, grp string, distance double").groupBy(*by).agg(F.min("distance").alias("distance"))
