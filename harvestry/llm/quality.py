"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed in numpy passes over blocks of whole texts. Trees are complete binary trees of equal depth, stored
as three arrays (feature, threshold, leaf) in heap order, and a batch walks all rows through a level of a tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import held_out, map_batches, sampled_texts, training_labels
from harvestry.llm.kernel import LOWER, SPACE, Block, blocks, range_hash, spans_of, tokens

TRAINING_ROWS = 20000
THRESHOLD = 0.7

_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "punct", "symbol", "lead", "tail")
_CLASS = np.full(256, 7, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 0, 1, 2, 3, 4
_CLASS[list(b".!?")], _CLASS[list(b",;:'\"-()")] = 5, 6
_CLASS[192:], _CLASS[128:192] = 8, 9

FEATURES = (
    *(f"share_{c}" for c in _CLASSES), "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word",
    "distinct_pairs", "top_pair", "repeated_next", "capitalised", "upper_words", "symbol_words", "stop_words_end", "words_per_stop", "log_lines",
    "words_per_line", "distinct_lines", "repeated_line_chars", "word_entropy", "longest_word",
)


def _per_row(row: np.ndarray, n: int, value: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weights=value, minlength=n).astype(float)


def _repeats(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each row, the count of the most frequent one, and the entropy of the counts in bits."""
    if not len(row):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])])
    counts, owner = np.diff(np.r_[first, len(r)]), r[first]
    top = np.zeros(n)
    np.maximum.at(top, owner, counts)
    total = _per_row(row, n)
    p = counts / total[owner]
    return _per_row(owner, n), top, _per_row(owner, n, -p * np.log2(p))


def statistics(block: Block) -> np.ndarray:
    """A row of FEATURES for each text of the block; empty texts have zeros."""
    n, size = block.rows, np.diff(block.offsets)
    row_of_byte = np.repeat(np.arange(n), size)
    kind = _CLASS[block.data]
    classes = np.bincount(row_of_byte * 10 + kind, minlength=n * 10).reshape(n, 10).astype(float)
    chars = np.maximum(classes[:, :9].sum(axis=1), 1)
    tok = tokens(block)
    row, words = tok.row, np.maximum(np.diff(tok.bounds), 1).astype(float)
    length = (tok.end - tok.start).astype(float)
    mean = _per_row(row, n, length) / words
    spread = np.sqrt(np.maximum(_per_row(row, n, length**2) / words - mean**2, 0))
    distinct, top, entropy = _repeats(row, tok.hash, n)
    same = row[1:] == row[:-1]
    pair = (tok.hash[1:] * np.uint64(0xD6E8FEB86659FD93) + tok.hash[:-1])[same]
    pairs, top_pair, _ = _repeats(row[1:][same], pair, n)
    several = np.maximum(words - 1, 1)
    again = _per_row(row[1:][same & (tok.hash[1:] == tok.hash[:-1])], n) / several
    inside = lambda k: np.concatenate([[0], np.cumsum(kind == k)])
    upper, symbol, low = inside(0), inside(7), inside(1)
    ups, syms, lows = (c[tok.end] - c[tok.start] for c in (upper, symbol, low))
    opens = kind[tok.start] == 0 if len(tok.start) else np.zeros(0, dtype=bool)
    stops = kind[tok.end - 1] == 5 if len(tok.end) else np.zeros(0, dtype=bool)
    a, b = spans_of(block.data != 10, block.offsets)
    filled = np.concatenate([[0], np.cumsum(~SPACE[block.data])])
    full = filled[b] > filled[a]
    a, b = a[full], b[full]
    line_row = np.searchsorted(block.offsets, a, "right") - 1
    line = range_hash(LOWER[block.data], a, b)
    lines = _per_row(line_row, n)
    order = np.lexsort((line, line_row))
    lr, lv, ll = line_row[order], line[order], (b - a)[order].astype(float)
    known = np.r_[False, (lr[1:] == lr[:-1]) & (lv[1:] == lv[:-1])] if len(lr) else np.zeros(0, dtype=bool)
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    some = np.maximum(lines, 1)
    out = [
        *(classes / chars[:, None]).T, np.log1p(classes[:, :9].sum(axis=1)), np.log1p(np.diff(tok.bounds)), mean, spread, distinct / words, top / words,
        pairs / several, top_pair / several, again, _per_row(row[opens], n) / words, _per_row(row[(ups > 1) & (lows == 0)], n) / words, _per_row(row[syms > 0], n) / words,
        _per_row(row[stops], n) / words, words / (1 + _per_row(row[stops], n)), np.log1p(lines), words / some, (lines - _per_row(lr[known], n)) / some,
        _per_row(lr[known], n, ll[known]) / np.maximum(size, 1), entropy, np.log1p(longest),
    ]
    x = np.column_stack(out)
    x[np.diff(tok.bounds) == 0] = 0
    return x


def statistics_of(column: pa.Array) -> np.ndarray:
    parts = [statistics(b) for b in blocks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Forest:
    """feature and threshold have 2**depth - 1 entries a tree, leaf has 2**depth; a row goes right if its value is above the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while inner and at[:1].size and at[0] < inner:  # every row is on the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            z += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, penalty: float = 2.0, least: float = 3.0) -> Forest:
    """Boosted trees for the logistic loss, split by gradient histograms over quantile bins. One label only: a constant."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start, inner = float(np.log(share / (1 - share))), 2**depth - 1
    feature, threshold, leaf = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if len(y) < 20 or len(np.unique(y)) < 2:
        return Forest(feature[:1], threshold[:1], leaf[:1], start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    flat = binned + np.arange(x.shape[1]) * bins
    z, width = np.full(len(y), start), x.shape[1] * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            base, nodes = 2**level - 1, 2**level
            key = ((at - base)[:, None] * width + flat).ravel()
            gh = [np.bincount(key, weights=np.repeat(v, x.shape[1]), minlength=nodes * width).reshape(nodes, x.shape[1], bins).cumsum(axis=2) for v in (g, h)]
            gt, ht = (v[:, :, -1:] for v in gh)
            gain = gh[0] ** 2 / (gh[1] + penalty) + (gt - gh[0]) ** 2 / (ht - gh[1] + penalty) - gt**2 / (ht + penalty)
            gain[(gh[1] < least) | (ht - gh[1] < least)] = -1
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, base + k], threshold[t, base + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        at -= inner
        leaf[t] = rate * np.bincount(at, weights=g, minlength=inner + 1) / (np.bincount(at, weights=h, minlength=inner + 1) + penalty)
        z += leaf[t, at]
    return Forest(feature, threshold, leaf, start)


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Forest:
    """Trees from at most `limit` labelled rows that are not held out, whose ids may be of any type (one that repeats in docs counts once); only their statistics reach the driver (limit x 30 doubles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics_of(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), type=pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    sample = sampled_texts(docs, training_labels(labels, "quality", limit)).select("doc_id", "y", "text")
    found = map_batches(sample, run, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y int, x array<double>").toArrow()
    if not found.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x, y = np.array(found["x"].to_pylist()), found["y"].to_numpy()
    order = np.lexsort((*x.T, found["doc_id"].to_numpy(zero_copy_only=False)))
    return fit(x[order], y[order].astype(float))


def score_quality(df: DataFrame, forest: Forest, text: str = "text", out: str = "quality_score") -> DataFrame:
    """df with a double column `out` from 0 to 1; null and empty texts are scored as texts whose statistics are all zero.

    A column named `out` is replaced; others pass through. Rows that repeat have equal scores, texts are read whole, and an empty table gives an empty one.
    """
    base = df.drop(out)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"`{out}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(statistics_of(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, type=pa.float64())], names=[*batch.schema.names, out])

    return map_batches(base, run, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, for each row of documents."""
    scored = score_quality(docs.select("doc_id", "text"), learn(docs, labels), out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
