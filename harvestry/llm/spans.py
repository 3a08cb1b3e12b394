"""Substring deduplication by sliding sentence spans.

A text is cut into sentences (after . ! ? or at a line end). From every sentence a run goes on until it has three sentences and 20 words, and to
every sentence at which none ends one comes from as far back as that; so a passage with that much is covered to both its ends. Runs are hashed
and joined globally. The first occurrence of a run, by document and place, stays; sentences covered by any other occurrence go.

A passage that starts or ends inside a sentence is found by its words, as its sentences alone would leave its ends, or all of it where it has
no three whole sentences; that is why a sentence may lose a part. Of the hashes of 20 consecutive words every one that is the least of
some REACH consecutive ones is a mark, so any passage of 50 words holds the same mark wherever it stands. Marks are joined with the runs. Occurrences of
a mark that have the same words as far as the next mark (or the text's end) on a side repeat these, too, and the first of them leads; where a mark has several leads on a side, each
gives all runs of 20 words that start within REACH on it, and these runs are joined too. So a passage is covered word by
word to both its ends, whatever surrounds it.

Runs are equal if their 64-bit hashes are: words are mixed byte by byte and runs word by word, so a false repeat has a chance of 2**-64 for each
pair of different runs, which is 2**-13 for one run among a corpus of 2**51 of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import clash_free, map_batches, written
from harvestry.llm.kernel import Block, Tokens, blocks, mix, sequence_hash, tokens
from harvestry.workdir import discard

RUN, MIN_WORDS = 3, 20
#: Words of a passage that is found wherever it starts, and the hashes of MIN_WORDS words in it.
SEEN = 50
REACH = SEEN - MIN_WORDS + 1
_ODD, _MARK = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x5851F42D4C957F2D)
FOUND = ["run", "id", "at", "again", "length", "back", "ahead", "left", "right"]
_END = np.zeros(256, dtype=bool)
_END[list(b".!?")] = True


@dataclass
class Sentences:
    """Sentences of a block: first and last word (exclusive), byte span, hash, and the sentences of row r as bounds[r]:bounds[r+1]."""

    words: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def sentences(block: Block, tok: Tokens | None = None) -> Sentences:
    tok = tok or tokens(block)
    n = len(tok.start)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return Sentences(empty, empty, empty, empty.astype(np.uint64), np.zeros(block.rows + 1, dtype=np.int64))
    opens = np.zeros(n, dtype=bool)
    opens[tok.bounds[:-1][tok.bounds[:-1] < n]] = True
    opens[1:] |= _END[block.data[tok.end[:-1] - 1]]
    lines = np.concatenate([[0], np.cumsum(block.data == 10)])
    opens[1:] |= lines[tok.start[1:]] > lines[tok.end[:-1]]
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], n]
    return Sentences(last - first, tok.start[first], tok.end[last - 1], sequence_hash(tok.hash, first, last), np.searchsorted(first, tok.bounds))


def runs(block: Block, tok: Tokens | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first sentence (within the row), length in sentences and hash of every run."""
    s = sentences(block, tok)
    n = len(s.hash)
    total = np.concatenate([[0], np.cumsum(s.words)])
    row = np.repeat(np.arange(block.rows), np.diff(s.bounds))
    at = np.arange(n)
    end = np.maximum(at + RUN, np.searchsorted(total, total[:-1] + MIN_WORDS))
    ahead = end <= s.bounds[row + 1]
    start = np.minimum(at + 1 - RUN, np.searchsorted(total, total[1:] - MIN_WORDS, "right") - 1)
    back = start >= s.bounds[row]
    ended = np.zeros(n + 1, dtype=bool)
    ended[end[ahead]] = True
    back &= ~ended[1:]  # else a run ahead covers a passage to this end
    first, last, owner = np.r_[at[ahead], start[back]], np.r_[end[ahead], at[back] + 1], np.r_[row[ahead], row[back]]
    return owner, first - s.bounds[owner], last - first, sequence_hash(s.hash, first, last)


def slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every `width` consecutive values."""
    have = 1
    while have < width and len(x):
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def windows(tok: Tokens) -> np.ndarray:
    """Hash of the MIN_WORDS words from each word on, put together from those of fewer words; those that cross a row's end mean nothing."""
    n = max(0, len(tok.hash) - MIN_WORDS + 1)
    own, out, have, width = tok.hash, None, 0, 1
    while width <= MIN_WORDS:
        if MIN_WORDS & width:
            out = own[:n] if out is None else mix(out[:n] * _ODD + own[have : have + n])
            have += width
        own, width = mix(own[:-width] * _ODD + own[width:]) if len(own) > width else own[:0], 2 * width
    return out[:n]


def marks(tok: Tokens) -> tuple[np.ndarray, ...]:
    """Row, first word (within the block) and hash of every mark, the first word and the end of what lies between it and the marks beside it, and the hashes of both sides."""
    value, row = windows(tok), tok.row
    e = np.zeros(0, dtype=np.int64)
    if len(row) < SEEN:
        return e, e, e.astype(np.uint64), e, e, e.astype(np.uint64), e.astype(np.uint64)
    least = slide(value, REACH, np.minimum)
    least[row[: len(least)] != row[SEEN - 1 :]] = 0
    edge = np.zeros(REACH - 1, dtype=np.uint64)
    most = slide(np.concatenate([edge, least, edge]), REACH, np.maximum)
    at = np.flatnonzero((most == value) & (most > 0))
    own = row[at]
    beside = own[1:] == own[:-1]
    first, last = tok.bounds[own].copy(), tok.bounds[own + 1].copy()
    first[1:][beside] = at[:-1][beside]
    last[:-1][beside] = at[1:][beside] + MIN_WORDS
    return own, at, value[at], first, last, sequence_hash(tok.hash, first, at + MIN_WORDS), sequence_hash(tok.hash, at, last)


def _again(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the row has the value at a lesser place, too."""
    order = np.lexsort((at, value, row))
    out = np.zeros(len(row), dtype=bool)
    out[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (value[order[1:]] == value[order[:-1]])
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (with a length, in sentences) and marks (with what lies beside them, and no length), in one pass over the texts."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            tok = tokens(block)
            row, at, length, value = runs(block, tok)
            none, ids = len(row), batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), ids.take(pa.array(row + block.first)), pa.array(at.astype(np.int32)), pa.array(_again(row, at, value)), pa.array(length.astype(np.int32)), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64())],
                names=FOUND,
            )
            row, at, value, first, last, left, right = marks(tok)
            numbers = [np.int32(at - tok.bounds[row]), _again(row, at, value)]
            sides = [np.int32(at - first), np.int32(last - at), left.view(np.int64), right.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array((value ^ _MARK).view(np.int64)), ids.take(pa.array(row + block.first)), *map(pa.array, numbers), pa.nulls(len(row), pa.int32()), *map(pa.array, sides)], names=FOUND)


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of MIN_WORDS words that start within REACH before or after given words."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            tok = tokens(block)
            value, row = windows(tok), tok.row
            keep = np.zeros(len(value), dtype=bool)
            for column, steps in ((2, np.arange(1 - REACH, 0)), (3, np.arange(1, REACH))):
                part = batch.column(column).slice(block.first, block.rows)
                own = np.repeat(np.arange(block.rows), part.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
                at = (tok.bounds[own] + part.flatten().to_numpy(zero_copy_only=False))[:, None] + steps
                inside = (at >= tok.bounds[own][:, None]) & (at + MIN_WORDS <= tok.bounds[own + 1][:, None])
                keep[at[inside]] = True
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(value[at].view(np.int64)), batch.column(0).take(pa.array(row[at] + block.first)), pa.array((at - tok.bounds[row[at]]).astype(np.int32)), pa.array(_again(row[at], at, value[at]))], names=FOUND[:4])


def _repeated(found: DataFrame) -> DataFrame:
    """Occurrences of runs that occur more than once, with `later`: whether the occurrence isn't the run's first one.

    A document's own repeats are known where its text is read, so the smallest and largest id of a run tell the rest; these are aggregated map-side
    and written before they are joined, so the rows of a run that a third of all documents share are dealt over tasks.
    `found` is a written table, which is deleted once its hits are written.
    """
    several = found.groupBy("run").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.max("again").alias("any")).where("least < most OR any")
    hits = found.join(written(several.select("run", "least"), "repeated"), "run").withColumn("later", F.col("again") | (F.col("id") > F.col("least")))
    hits = written(hits.drop("least", "again"), "hits")
    discard(found)
    return hits


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All but the first occurrences: (id, at, length) of runs, by sentences, and (id, a, b) of words (end exclusive), which cover any passage of SEEN words whole."""
    kind = df.schema[key].dataType.simpleString()
    base = df.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    hits = _repeated(written(map_batches(base, _found, f"run long, id {kind}, at int, again boolean, length int, back int, ahead int, left long, right long"), "runs"))
    marked, kept = hits.where("length IS NULL").withColumn("place", F.struct("id", "at")), []
    for side in ("left", "right"):
        leads = written(hits.where("length IS NULL").groupBy("run", side).agg(F.min(F.struct("id", "at")).alias(f"{side}_lead")), f"{side}s")
        kept.append(leads)
        several = leads.groupBy("run").agg((F.count("*") > 1).alias(f"{side}_differs"))
        marked = marked.join(leads.join(several, "run"), ["run", side])
    marked = written(marked.select("id", "at", "back", "ahead", "later", *(c for side in ("left", "right") for c in ((F.col("place") == F.col(f"{side}_lead")).alias(f"{side}_lead"), f"{side}_differs"))), "sides")
    for leads in kept:
        discard(leads)
    whole = marked.where("later").select("id", (F.col("at") - F.when(F.col("left_lead"), 0).otherwise(F.col("back"))).alias("a"), (F.col("at") + F.when(F.col("right_lead"), MIN_WORDS).otherwise(F.col("ahead"))).alias("b"))
    end = lambda side: F.collect_set(F.when(F.col(f"{side}_lead") & F.col(f"{side}_differs"), F.col("at"))).alias(f"{side}s")
    ends = marked.where("left_lead AND left_differs OR right_lead AND right_differs").groupBy("id").agg(end("left"), end("right"))
    near = base.join(written(ends, "ends"), F.col(key) == F.col("id")).select("id", F.col(text).alias("text"), "lefts", "rights")
    parts = _repeated(written(map_batches(near, _beside, f"run long, id {kind}, at int, again boolean"), "beside"))
    words = whole.unionByName(parts.where("later").select("id", F.col("at").alias("a"), (F.col("at") + MIN_WORDS).alias("b")))
    return hits.where("later AND length IS NOT NULL").select("id", "at", "length"), words


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("n_sentences", "n_removed")) -> DataFrame:
    """df with repeated sentences and passages taken out of its text, and two columns: the sentences it had and those that lost words.

    A null text stays null, an empty one empty, both with zero sentences. Rows with a null key take no part and keep their text.
    Rows that repeat a key count as one document: a place is first in each of them or in none. Columns named as the two counts are replaced; others
    pass through whatever their names. Texts are read whole, whatever their length; an empty table gives an empty one.
    """
    base = df.drop(*counts)
    pair = lambda a, b: F.shiftleft(F.col(a).cast("long"), 32) + b
    whole, words = repeats(base, key, text)
    whole = whole.select("id", pair("at", F.col("at") + F.col("length")).alias("at"), F.lit(None).cast("long").alias("words"))
    words = words.select("id", F.lit(None).cast("long").alias("at"), pair("a", F.col("b")).alias("words"))
    gone = written(whole.unionByName(words).groupBy("id").agg(F.struct(F.collect_set("at").alias("at"), F.collect_set("words").alias("words")).alias("gone")), "gone")
    mine, theirs = clash_free(base.schema, "gone"), clash_free(base.schema, "id_gone")
    joined = base.join(gone.select(F.col("id").alias(theirs), F.col("gone").alias(mine)), F.col(key) == F.col(theirs), "left").drop(theirs)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"`{c}` int" for c in counts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            column, dropped = batch.column(place), batch.column(batch.schema.get_field_index(mine))
            texts, had, lost = [], [], []
            for block in blocks(column):
                tok = tokens(block)
                s = sentences(block, tok)
                opens = np.concatenate([[0], np.cumsum(s.words)])
                for r in range(block.rows):
                    had.append(s.bounds[r + 1] - s.bounds[r])
                    marked = dropped[block.first + r]
                    if not marked.is_valid:
                        lost.append(0)
                        texts.append(column[block.first + r].as_py())
                        continue
                    low, high = tok.bounds[r], tok.bounds[r + 1]
                    whole, words = (marked[c].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "words"))
                    ends = opens[np.minimum(s.bounds[r] + np.r_[whole >> 32, whole & 0xFFFFFFFF], s.bounds[r + 1])] - low  # a row that repeats a key may be shorter
                    change = np.zeros(high - low + 1, dtype=np.int64)
                    np.add.at(change, np.minimum(np.r_[ends[: len(whole)], words >> 32], high - low), 1)
                    np.add.at(change, np.minimum(np.r_[ends[len(whole) :], words & 0xFFFFFFFF], high - low), -1)
                    away = np.cumsum(change[:-1]) > 0
                    lost.append(len(np.unique(np.searchsorted(opens, low + np.flatnonzero(away), "right"))))
                    texts.append(cut(block, tok, r, away))
            rest = [c for k, c in enumerate(batch.columns) if batch.schema.names[k] != mine]
            rest[place] = pa.array(texts, type=pa.string())
            yield pa.RecordBatch.from_arrays([*rest, pa.array(had, pa.int32()), pa.array(lost, pa.int32())], names=[*(n for n in batch.schema.names if n != mine), *counts])

    return map_batches(joined, run, schema)


def cut(block: Block, tok: Tokens, row: int, away: np.ndarray) -> str:
    """The row's text without the marked words and the white space after each."""
    start = np.r_[tok.start[tok.bounds[row] : tok.bounds[row + 1]], block.offsets[row + 1]]
    turns = np.flatnonzero(np.diff(np.r_[False, away, False]))
    parts, at = [], block.offsets[row]
    for a, b in zip(turns[::2], turns[1::2], strict=True):
        parts.append(block.data[at : start[a]].tobytes())
        at = start[b]
    parts.append(block.data[at : block.offsets[row + 1]].tobytes())
    return b"".join(parts).decode()


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_chars, text: one row for each row of documents, with what is left of its text."""
    left = remove_repeats(docs.select("doc_id", "text"))
    return left.select("doc_id", "n_sentences", "n_removed", F.length("text").cast("long").alias("n_chars"), "text")
