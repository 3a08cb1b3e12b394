"""Near duplicates: SetSketch registers, banded, estimated jointly by likelihood, then verified on full shingle sets.

A register holds the truncated, exponentially spaced level of the least of exponential variates over a set: level
floor(1 - log_b(h)), cut to 0..q+1. Sketches merge by the maximum of each register. Equality of registers is locality
sensitive, so bands of registers are hashed and joined.

Steps. (1) Equal sets become one class, whose node is its smallest doc_id; only classes are sketched further. (2) In each band
bucket the smallest node leads; candidates are the distinct pairs of a leader and a member, a number linear in the buckets' rows.
(3) Candidates are pruned by exact set sizes and by the likelihood estimate, and the rest is verified on the full texts. (4) Buckets whose
members those links haven't all joined are compared pair by pair, pairs of different components only, by sizes and by four bits of each register, which is cheap, so only
pairs that may reach the threshold leave the step. A bucket with more than HOT such pairs is split first: its members
must meet again in a band of another family over the same registers, up to SPLITS times, as long as that leaves fewer pairs; this parts pages that only share a template. Buckets
are dealt in blocks of ROWS_MET rows, and each two of a bucket's blocks meet, but for two blocks of its largest component; none of its pairs is left out, and no pair is
sent on, only groups that such pairs join, a row for each member. (5) A group is cut into blocks of TILE nodes (fewer if their sets are large). For each two blocks, but those inside one component, a task
finds the nodes that are in a likely pair by the likelihood estimate on full registers, and a second one counts the intersections of these nodes' full sets and returns only links that join components. No
text is sent for a node that is in no likely pair of the two blocks.
(6) Components come from alternating large-star and small-star steps over written edge tables; nothing of it reaches the driver but counts.

At the threshold 0.85 a pair is missed by all 42 bands of 6 registers of a family with a probability of 2e-9, the estimate's
margin of 0.12 is over five standard deviations, and that of the bits six.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.llm.common import map_batches, written
from harvestry.llm.kernel import LOWER, binary_column, blocks, mix, sets, tokens
from harvestry.operators.rank import running_total
from harvestry.workdir import discard

REGISTERS, BANDS, ROWS = 256, 42, 6
BASE, RATE, LEVELS = 1.02, 20.0, 4094
MARGIN = 0.12
TILE, LONG = 512, 1024
HOT, SPLITS, ROWS_MET, PAIRS, DEVIATIONS = 1 << 27, 4, 2048, 1 << 18, 6.0
SLICE, CHUNK, RARE = 2048, 4096, 16

_rng = np.random.default_rng(7)
_FACTOR = (_rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_BAND_SALT = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def least_hashes(values: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of the set under each register's hash function."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), SLICE):
        least = np.minimum(least, (x[at : at + SLICE, None] * _FACTOR + _SHIFT).min(axis=0))
    return least


def sketch(values: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    h = -np.log1p(-(least_hashes(values).astype(float) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LEVELS + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit key for each band of each sketch (rows x BANDS). Families deal the registers out to bands in orders of their own."""
    order = np.random.default_rng(family).permutation(REGISTERS) if family else np.arange(REGISTERS)
    r = registers[:, order[: BANDS * ROWS]].astype(np.uint64).reshape(-1, BANDS, ROWS)
    return mix((mix(r + np.uint64(1)) * _BAND_SALT).sum(axis=2, dtype=np.uint64) + np.uint64(family))


def register_marks(registers: np.ndarray) -> np.ndarray:
    """Four bits of each register, packed (rows x REGISTERS / 2 bytes): equal registers have equal bits, different ones in one of 16 cases."""
    four = (mix(registers.astype(np.uint64) + np.uint64(1)) & np.uint64(15)).astype(np.uint8)
    return four[:, ::2] << 4 | four[:, 1::2]


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many registers have equal marks, for each pair of rows of 64-bit words."""
    d = a ^ b
    d |= d >> np.uint64(1)
    d |= d >> np.uint64(2)
    d &= np.uint64(0x1111111111111111)
    return a.shape[1] * 16 - np.bitwise_count(d).sum(axis=1, dtype=np.int64)


def least_alike(least: float, registers: int) -> float:
    """The number of equal marks below which a pair of similarity `least` falls in a chance of DEVIATIONS standard deviations."""
    p = least + (1 - least) / 16
    return registers * p - DEVIATIONS * np.sqrt(registers * p * (1 - p))


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the registers of pairs (rows x REGISTERS) and the sets' sizes.

    The log likelihood of the counts of larger, smaller and equal registers is concave in the similarity; golden-section search.
    """
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - up - down
    u = size_a / (size_a + size_b)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        pa_, pb_ = p(u - v * j), p(v - u * j)
        return up * np.log(pa_) + down * np.log(pb_) + same * np.log(np.clip(1 - pa_ - pb_, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(32):
        c, d = hi - g * (hi - lo), lo + g * (hi - lo)
        left = log_likelihood(c) > log_likelihood(d)
        lo, hi = np.where(left, lo, c), np.where(left, d, hi)
    return (lo + hi) / 2


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                found = sets(tokens(block), width)
                one, two = (np.array([int(f(s)) for s in found], dtype=np.uint64).view(np.int64) for f in (lambda s: s.sum(dtype=np.uint64), lambda s: mix(s).sum(dtype=np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first, block.rows), pa.array([len(s) for s in found], pa.int64()), pa.array(one), pa.array(two), binary_column([sketch(s).tobytes() if len(s) else b"" for s in found])],
                    names=["id", "n", "d1", "d2", "registers"],
                )

    return run


def _bands(family: int):
    """(key, node) of all bands; the keys of a later family are bound to the bucket that a row comes from, its parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                registers = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                keys = band_keys(registers, family)
                if family:
                    keys = mix(keys + mix(part.column(2).to_numpy().view(np.uint64))[:, None])
                row = pa.array(np.repeat(np.arange(part.num_rows), BANDS))
                columns = [pa.array(keys.ravel().view(np.int64)), part.column(0).take(row), *([part.column(2).take(row)] if family else [])]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "parent"][: len(columns)])

    return run


def _with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        registers = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary_column([b.tobytes() for b in register_marks(registers)])], names=["node", "n", "marks"])


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the pairs (i, j) have joined their rows' groups; a group's label is its least row."""
    while True:
        x, y = label[i], label[j]
        apart = x != y
        if not apart.any():
            return label
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _meetings(percent: int):
    """Groups (a, b) of rows (key, node, n, marks, component), sorted by key: rows of one key, of different components, that may reach the threshold, are joined, and each row of a group is paired with its least node.

    So what leaves the step is at most a pair for each row, however many pairs meet in it.
    """
    first_words = 4
    some, least = least_alike(percent / 100, 16 * first_words), least_alike(percent / 100, REGISTERS)

    def groups(table: pa.Table) -> pa.RecordBatch:
        key, node, n, own = (table[c].to_numpy() for c in ("key", "node", "n", "component"))
        marks = np.frombuffer(b"".join(table["marks"].to_pylist()), dtype=np.uint64).reshape(-1, REGISTERS // 16)
        order = np.lexsort((node, key))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))  # rows by key and node, so that the least row is the least node
        order = np.lexsort((own, key))
        key, rank, n, own, marks = key[order], rank[order], n[order], own[order], marks[order]
        head = marks[:, :first_words].copy()
        # a row's partners are the rows of its bucket after its component
        turns = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]), True])
        first = np.repeat(turns[1:], np.diff(turns))
        opens = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        count = np.repeat(opens[1:], np.diff(opens)) - first
        total, at, label = np.cumsum(count), 0, np.arange(len(rank))
        while at < len(count):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
            size = count[at:to]
            i = np.repeat(np.arange(at, to), size)
            j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size - first[at:to], size)
            near = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (label[rank[i]] != label[rank[j]])
            i, j = i[near], j[near]
            near = alike(head[i], head[j]) >= some
            i, j = i[near], j[near]
            near = alike(marks[i], marks[j]) >= least
            label, at = joined(label, rank[i[near]], rank[j[near]]), to
        node = node[np.lexsort((node, table["key"].to_numpy()))]
        others = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(node[label[others]], table["node"].type), pa.array(node[others], table["node"].type)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column(0)[batch.num_rows - 1].as_py()
            whole = int(np.searchsorted(batch.column(0).to_numpy(), last))  # the last bucket may go on
            if whole:
                yield groups(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held = []
            held.append(batch.slice(whole))
        if held:
            yield groups(pa.Table.from_batches(held))

    return run


def _likely(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for k in (3, 5))
                na, nb = (batch.column(k).to_numpy().astype(float) for k in (2, 4))
                j = similarity(ra, rb, na, nb)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(j >= least))

    return run


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def similar(a: str, b: str, width: int, percent: int) -> bool:
    """Whether the sets of the words' own shingles reach the threshold, with no hash."""
    one, two = (_WORD.findall(t.encode().translate(bytes(LOWER))) for t in (a, b))
    x, y = ({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for w in (one, two))
    both = len(x & y)
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _verified(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                one, two = ([s for block in blocks(part.column(k)) for s in sets(tokens(block), width)] for k in (2, 3))
                keep = []
                for r, (x, y) in enumerate(zip(one, two, strict=True)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                    keep.append(linked and similar(part.column(2)[r].as_py(), part.column(3)[r].as_py(), width, percent))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return run


def intersections(rows: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (each sorted and distinct), as a square matrix.

    Elements of few sets are counted as pairs, the others by products of 0/1 matrices of CHUNK columns.
    """
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    values = np.concatenate(rows) if n else np.zeros(0, dtype=np.uint64)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=np.int64)
    held = np.diff(np.r_[first, len(values)])
    out = np.zeros(n * n)
    for d in range(2, RARE + 1):
        at = first[held == d]
        for a in range(0, len(at), 1 << 14):
            who = owner[at[a : a + (1 << 14), None] + np.arange(d)]
            out += np.bincount((who[:, :, None] * n + who[:, None, :]).ravel(), minlength=n * n)
    out = out.reshape(n, n)
    many = np.flatnonzero(held > RARE)
    for a in range(0, len(many), CHUNK):
        part = many[a : a + CHUNK]
        x = np.zeros((n, len(part)), dtype=np.float32)
        column = np.repeat(np.arange(len(part)), held[part])
        index = np.repeat(first[part], held[part]) + np.arange(len(column)) - np.repeat(np.cumsum(held[part]) - held[part], held[part])
        x[owner[index], column] = 1
        out += x @ x.T
    return out


def _near(percent: int):
    """Rows (cluster, x, y, node) of a tile (with component, n and registers) that are in a likely pair of different components, by sizes, equal registers and the likelihood estimate."""
    t = percent / 100
    least = REGISTERS * t - DEVIATIONS * np.sqrt(REGISTERS * t * (1 - t))

    def run(table: pa.Table) -> pa.Table:
        own, n = table["component"].to_numpy(), table["n"].to_numpy()
        registers = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        near = np.zeros(len(n), dtype=bool)
        for i in range(len(n) - 1):
            j = i + 1 + np.flatnonzero((own[i + 1 :] != own[i]) & (100 * np.minimum(n[i], n[i + 1 :]) >= percent * np.maximum(n[i], n[i + 1 :])))
            j = j[~(near[i] & near[j])]  # what a pair would tell of two rows that are in one each
            j = j[(registers[j] == registers[i]).sum(axis=1) >= least]
            if len(j):
                j = j[similarity(np.broadcast_to(registers[i], (len(j), REGISTERS)), registers[j], np.full(len(j), float(n[i])), n[j].astype(float)) >= t - MARGIN]
                near[j] = True
                near[i] |= len(j) > 0
        return table.select(["cluster", "x", "y", "node"]).filter(pa.array(near))

    return run


def _tile(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, own, texts = table["node"].to_numpy(), table["component"].to_numpy(), table["text"].combine_chunks()
        rows = [s for block in blocks(texts) for s in sets(tokens(block), width)]
        size = np.array([len(r) for r in rows], dtype=float)
        both = intersections(rows)
        linked = (both > 0) & (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (own[:, None] != own[None, :])
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = c = root[root[c]]
            return c

        a, b = [], []
        for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
            p, q = find(int(own[i])), find(int(own[j]))
            if p != q and similar(texts[i].as_py(), texts[j].as_py(), width, percent):
                root[max(p, q)] = min(p, q)
                a.append(min(ids[i], ids[j]))
                b.append(max(ids[i], ids[j]))
        return pa.table({"a": pa.array(a, table["node"].type), "b": pa.array(b, table["node"].type)})

    return run


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """One star step over edges (a, b) with a < b. Large: each node's larger neighbours get its least neighbour; small: its smaller ones.

    The least neighbours are aggregated map-side and written before the join, so that the join reads plain exchanges and a hub that
    a third of all edges share can be split over tasks.
    """
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = written(both.groupBy(F.col("u").alias("a")).agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
        return edges.join(least, "a").select(F.col("m").alias("a"), "b").distinct()
    least = written(edges.groupBy("b").agg(F.min("a").alias("m")), f"{name}-least")
    joined = edges.join(least, "b")
    return joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(joined.select(F.col("m").alias("a"), "b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two edges to lesser nodes, or edges to lesser and to larger ones."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("a", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 OR (child = 1 AND parent = 1)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every node but the least of each component, from edges a < b: the least node it can reach.

    The edges should be stored ones, as each step reads them more than once. A table is written after each step, until the edges are stars.
    """
    while not _settled(edges):
        edges = written(_star(written(_star(edges, True, name), name), False, name), name)
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))


def _labelled(nodes: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """nodes with the component of `column`; a node without links is its own."""
    named = labels.select(F.col("id").alias("_id"), F.col("component").alias("_component"))
    return nodes.join(named, F.col(column) == F.col("_id"), "left").withColumn(out, F.coalesce("_component", column)).drop("_id", "_component")


class _Verifier:
    def __init__(self, nodes: DataFrame, texts: DataFrame, width: int, percent: int, id_type: str) -> None:
        self.nodes, self.texts, self.width, self.percent, self.id_type = nodes, texts, width, percent, id_type

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose similarity may reach the threshold, by sizes and by the likelihood estimate."""
        side = lambda c: self.nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("registers").alias(f"r{c}"))
        sized = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
        return map_batches(sized.select("a", "b", "na", "ra", "nb", "rb"), _likely(self.percent / 100 - MARGIN), f"a {self.id_type}, b {self.id_type}")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose similarity reaches the threshold: by sizes, by the estimate, and then by full sets."""
        text = lambda c: self.texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}"))
        full = self.likely(pairs).join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb")
        return map_batches(full, _verified(self.width, self.percent), f"a {self.id_type}, b {self.id_type}")

    def _apart(self, entries: DataFrame, labels: DataFrame) -> DataFrame:
        """Rows (key, node, component, parent) of the buckets that hold several components, with the bucket's rows, its pairs of different components and its largest component."""
        own = written(_labelled(entries, labels, "node", "component"), "own")
        parts = own.groupBy("key", "component").agg(F.count("*").alias("c"), F.min("parent").alias("parent"))
        sizes = parts.groupBy("key").agg(F.sum("c").alias("rows"), F.sum(F.col("c") * F.col("c")).alias("same"), F.max(F.struct("c", "component")).alias("most"))
        sizes = sizes.where("rows > most.c").select("key", "rows", F.floor((F.col("rows") * F.col("rows") - F.col("same")) / 2).alias("cross"), F.col("most.c").alias("n_major"), F.col("most.component").alias("major"))
        out = written(own.join(sizes, "key"), "apart")
        discard(own)
        return out

    def unjoined(self, buckets: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs (a, b) that join the nodes of different components that share a bucket (key, node) and may reach the threshold."""
        entries, ready = self._apart(buckets.withColumn("parent", F.lit(0).cast("long")), labels), []
        for family in range(1, SPLITS + 1):
            hot = entries.where(F.col("cross") > HOT)
            if hot.isEmpty():
                break
            keyed = hot.select("node", "key").join(self.nodes.select("node", "registers"), "node").select("node", "registers", "key")
            parts = self._apart(map_batches(keyed, _bands(family), f"key long, node {self.id_type}, parent long"), labels)
            cost = parts.select("key", "parent", "cross").distinct().groupBy("parent").agg(F.sum("cross").alias("after"))
            split = written(hot.select("key", "cross").distinct().join(cost, F.col("key") == F.col("parent"), "left").where(F.coalesce("after", F.lit(0)) < F.col("cross")).select(F.col("key").alias("parent")), "split")
            ready.append(entries.join(split.withColumnRenamed("parent", "key"), "key", "left_anti"))
            entries = written(parts.join(split, "parent", "left_semi"), "entries")
        rows = entries
        for more in ready:
            rows = rows.unionByName(more)
        # blocks of the largest component, which need not meet each other, and then those of the rest
        majors, others = F.ceil(F.col("n_major") / ROWS_MET), F.ceil((F.col("rows") - F.col("n_major")) / ROWS_MET)
        whole = F.col("rows") <= ROWS_MET
        is_major, drawn = F.col("component") == F.col("major"), F.xxhash64("node", F.lit(1))
        dealt = rows.withColumn("x", F.when(whole, 0).when(is_major, F.pmod(drawn, majors)).otherwise(majors + F.pmod(drawn, others)))
        dealt = dealt.withColumn("y", F.explode(F.sequence(F.when(is_major & ~whole, majors).otherwise(0), F.when(whole, 0).otherwise(majors + others - 1))))
        dealt = dealt.select(F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("key"), "node", "component")
        marks = map_batches(self.nodes.select("node", "n", "registers"), _with_marks, f"node {self.id_type}, n long, marks binary")
        met = dealt.join(marks, "node").select("key", "node", "n", "marks", "component").repartition("key").sortWithinPartitions("key")
        return map_batches(met, _meetings(self.percent), f"a {self.id_type}, b {self.id_type}").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id): one row for each row of df, by an integer key.

    Two texts are linked if their sets of `width`-word shingles have a Jaccard similarity of percent/100 or more (words: runs
    without ASCII white space, A-Z in lower case; a text with fewer words is one shingle). component_id is the smallest key
    that links lead to. Null, empty and wordless texts have no shingle and are their own component. A null key has a null
    component. Rows that repeat a key count as one document that holds each of their texts. Ties need no rule, as a component is named by its
    smallest key. Very long texts and words are whole, as shingles of hashes; a row decides the memory of its block. An empty table gives an empty
    one. Only key and text are read, so other columns can't clash. Sets are of 64-bit hashes of whole shingles, every byte mixed with its place; each link is confirmed on the words themselves,
    and equal sets are those with equal numbers and equal 128-bit sums.
    """
    id_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError("the key must be an integer")
    table = written(map_batches(rows, _sketches(width), f"id {id_type}, n long, d1 long, d2 long, registers binary"), "sketches")
    some = table.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = written(some.groupBy("d1", "d2", "n").agg(F.min("id").alias("node")), "classes")
    nodes = written(some.withColumnRenamed("id", "node").join(classes, ["d1", "d2", "n", "node"], "left_semi").select("node", "n", "registers").distinct(), "nodes")
    bands = written(map_batches(nodes.select("node", "registers"), _bands(0), f"key long, node {id_type}"), "bands")
    leaders = bands.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last").select("key", "leader")
    shared = written(bands.join(leaders, "key").distinct(), "buckets")
    discard(bands)
    wanted = written(shared.select("node").distinct().join(nodes.groupBy("node").agg(F.max("n").alias("n")), "node"), "wanted")
    texts = written(rows.where(F.col("id").isNotNull()).join(wanted, F.col("id") == F.col("node"), "left_semi").dropDuplicates().select(F.col("id").alias("node"), "text"), "texts")
    verifier = _Verifier(written(nodes.join(wanted, "node", "left_semi"), "sketched"), texts, width, percent, id_type)

    pairs = written(shared.where("node > leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = written(verifier.links(pairs), "links")
    labels = components(links, "labels")

    met = written(verifier.unjoined(shared.select("key", "node"), labels), "met", sparse=True)
    if not met.isEmpty():
        groups = components(met, "clusters")
        groups = written(groups.union(groups.select("component", "component").distinct()).toDF("node", "cluster"), "groups")
        placed = _labelled(groups.join(wanted, "node"), labels, "node", "component")
        run = running_total(placed, F.greatest("n", F.lit(LONG)), "cluster", "component", "node", out="total")
        placed = written(run.select("node", "component", "cluster", F.floor((F.col("total") - 1) / (TILE * LONG)).cast("long").alias("block")), "placed")  # a block of two clusters counts as two
        parts = placed.groupBy("cluster", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        other = parts.select("cluster", F.col("block").alias("y"), F.col("lo").alias("ylo"), F.col("hi").alias("yhi"))
        tiles = parts.withColumnRenamed("block", "x").join(other, "cluster").where("x <= y AND NOT (lo = hi AND ylo = yhi AND lo = ylo)")
        tiles = tiles.select("cluster", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
        members = tiles.join(placed, ["cluster", "block"]).select("cluster", "x", "y", "node", "component")
        sketched = members.join(verifier.nodes, "node").select("cluster", "x", "y", "node", "component", "n", "registers")
        near = written(sketched.groupBy("cluster", "x", "y").applyInArrow(_near(percent), f"cluster {id_type}, x long, y long, node {id_type}"), "near")
        texted = near.join(placed.select("node", "component"), "node").join(texts, "node").select("cluster", "x", "y", "node", "component", "text")
        more = written(texted.groupBy("cluster", "x", "y").applyInArrow(_tile(width, percent), f"a {id_type}, b {id_type}"), "links")
        if not more.isEmpty():
            labels = components(more.unionByName(labels.select(F.col("component").alias("a"), F.col("id").alias("b"))), "labels")

    ids = some.select("id", "d1", "d2", "n").join(classes, ["d1", "d2", "n"]).select("id", "n", "node")
    if not some.groupBy("id").agg(F.min("d1").alias("x"), F.max("d1").alias("y"), F.min("d2").alias("z"), F.max("d2").alias("w")).where("x < y OR z < w").isEmpty():
        ties = ids.where("node < id").select(F.col("node").alias("a"), F.col("id").alias("b")).distinct()  # a repeated key ties the classes of its texts together
        labels = components(written(ties.unionByName(labels.select(F.col("component").alias("a"), F.col("id").alias("b"))), "ties"), "labels")
    done = _labelled(ids, labels, "node", "component_id").select("id", F.col("n").alias("n_shingles"), "component_id")
    none = table.where((F.col("n") == 0) | F.col("id").isNull()).select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return done.unionByName(none).withColumnRenamed("id", key)


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: three-word shingles, similarity of 0.85 or more."""
    found = near_duplicates(docs.select("doc_id", "text"), width=3, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group of near duplicates: the one with the smallest doc_id. Columns as they were.

    Rows with a null doc_id stay; rows that repeat a kept doc_id stay together.
    """
    found = near_duplicates(docs.select("doc_id", "text"), width=width, percent=percent)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
