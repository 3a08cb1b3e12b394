"""Benchmark decontamination by template canonicalisation.

Words lose punctuation at their ends and letter case (Latin, Greek, Cyrillic). Numbers, numbers with a unit, units after a number, and capitalised words inside a
sentence become typed placeholders. Windows of five canonical words, of which at least two are no placeholders, are hashed
and joined with those of the benchmark. A document is contaminated by an item if it holds at least 0.8 of the item's distinct windows
and the slots agree: along one alignment, or over all of them, each value of a slot type in the item stands for one value in the
document, and the other way round. So a question with other numbers or names is caught, and a chance mix of windows is not.

Items and documents are read in two ways, with names as placeholders and with names as words, so that a passage in capitals or title case is
found whatever text is around it. A text in which half of the words or more are in capitals shows no names and is read in the second way only.
Capitals of all scripts whose case is folded open names.

Items without any such window (fewer than five words, or hardly a plain word among them) are held against the documents word by word: those of five words or more
by windows of their very words, of which 0.8 must be there as well, shorter ones as a whole sentence or line of the document.

Only documents that hold one of an item's rarest windows can hold 0.8 of them, so pairs of a document and an item come from these few windows alone, and windows that very many documents share pair nothing up by
themselves; places are joined for the pairs that are left.

The benchmark's windows are broadcast as hashes only if there are at most BROADCAST_WINDOWS of them; beyond that, windows of
the documents are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.llm.common import clash_free, map_batches, written
from harvestry.llm.kernel import LOWER, Block, blocks, chained, mix, range_hash, tokens

WIDTH, SHARE, PLAIN = 5, 0.8, 2
BROADCAST_WINDOWS = 1 << 20

#: Units, fixed values.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs pound pounds oz ounce ounces ton tons tonne tonnes ml l litre litres liter liters gallon gallons "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years c f k celsius fahrenheit kelvin degree degrees mph kmh kph "
    "percent dollar dollars euro euros cent cents usd eur gbp hz khz mhz ghz w kw mw kwh j kj v a kb mb gb tb byte bytes bit bits pa kpa bar n rpm"
).split()

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:")] = True
_SENTENCE = _STOP.copy()
_SENTENCE[ord(";")] = True
_EXACT = np.uint64(0x7F4A7C159E3779B9)
_WORD, _NUMBER, _QUANTITY, _UNIT, _NAME = range(5)
_PLACEHOLDER = mix(np.arange(5, dtype=np.uint64) + np.uint64(0x1234567))
_UNIT_HASHES: list[np.ndarray] = []


def unit_hashes() -> np.ndarray:
    if not _UNIT_HASHES:
        raw = " ".join(UNITS)
        _UNIT_HASHES.append(np.unique(tokens(next(blocks(pa.array([raw])))).hash))
    return _UNIT_HASHES[0]


@dataclass
class Canonical:
    """Canonical words of a block: byte spans of their cores, type, hash (of the placeholder for slots), hash of the word itself, row bounds, and whether a sentence or line begins before a word and ends after it."""

    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    hash: np.ndarray
    value: np.ndarray
    bounds: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with capitals of Latin (ASCII and Latin-1), Greek and Cyrillic in lower case; lengths stay."""
    out = LOWER[data]
    for lead, low, high, up, step in ((0xC3, 0x80, 0x9E, 0, 32), (0xCE, 0x91, 0x9F, 0, 32), (0xCE, 0xA0, 0xA9, 1, -32), (0xD0, 0x90, 0x9F, 0, 32), (0xD0, 0xA0, 0xAF, 1, -32)):
        at = np.flatnonzero(data[:-1] == lead)
        at = at[(data[at + 1] >= low) & (data[at + 1] <= high) & (data[at + 1] != 0x97 if lead == 0xC3 else True)]
        out[at] += up
        out[at + 1] = (out[at + 1].astype(np.int64) + step).astype(np.uint8)
    return out


def canonical(block: Block) -> Canonical:
    """The block's canonical words, with names as placeholders."""
    return readings(block)[0]


def readings(block: Block) -> tuple[Canonical, Canonical]:
    """The block's canonical words in two ways: with capitalised words as names, and as words."""
    tok = tokens(block)
    data = block.data
    solid = np.flatnonzero(_ALNUM[data])
    if not len(solid) or not len(tok.start):
        e = np.zeros(0, dtype=np.int64)
        none = Canonical(e, e, e, e.astype(np.uint64), e.astype(np.uint64), np.zeros(block.rows + 1, dtype=np.int64), e.astype(bool), e.astype(bool))
        return none, none
    i, j = np.searchsorted(solid, tok.start), np.searchsorted(solid, tok.end)
    full = np.flatnonzero(j > i)
    start, end = solid[i[full]], solid[j[full] - 1] + 1
    low = folded(data)
    value = range_hash(low, start, end)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    letters = np.concatenate([[0], np.cumsum(_ALNUM[data] & ~_DIGIT[data])])
    d, c = digits[end] - digits[start], letters[end] - letters[start]
    kind = np.zeros(len(full), dtype=np.int64)
    kind[(d > 0) & (c == 0)] = _NUMBER
    kind[(d > 0) & (c > 0) & (c <= 4) & _DIGIT[data[start]] & ~_DIGIT[data[end - 1]]] = _QUANTITY
    row = tok.row[full]
    opens = np.ones(len(full), dtype=bool)
    opens[1:] = (row[1:] != row[:-1]) | _STOP[data[tok.end[full[:-1]] - 1]]
    after = np.minimum(start + 1, len(data) - 1)
    upper = (low[start] != data[start]) | ((data[start] >= 0xC3) & (low[after] != data[after]))
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    large = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    loud, lettered = (large[end] > large[start]) & (small[end] == small[start]), c > 0
    shouted = np.bincount(row[loud], minlength=block.rows) * 2 >= np.maximum(np.bincount(row[lettered], minlength=block.rows), 1)
    named = kind.copy()
    named[(kind == _WORD) & upper & ~opens & ~shouted[row]] = _NAME
    bounds = np.searchsorted(full, tok.bounds)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    cut = (row[1:] != row[:-1]) | _SENTENCE[data[tok.end[full[:-1]] - 1]] | _SENTENCE[data[tok.end[full[1:] - 1] - 1]] | (lines[tok.start[full[1:]]] > lines[tok.end[full[:-1]]])
    begins, ends = np.r_[True, cut], np.r_[cut, True]
    out = []
    for kinds in (named, kind):
        unit = np.zeros(len(full), dtype=bool)
        follows = np.flatnonzero((kinds[1:] == _WORD) & (kinds[:-1] == _NUMBER) & (row[1:] == row[:-1])) + 1 if len(full) > 1 else np.zeros(0, dtype=np.int64)
        if len(follows):
            unit[follows] = np.isin(value[follows], unit_hashes())
        kinds[unit] = _UNIT
        out.append(Canonical(start, end, kinds, np.where(kinds == _WORD, value, _PLACEHOLDER[kinds]), value, bounds, begins, ends))
    return out[0], out[1]


def windows(words: Canonical) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word within the row, length and hash of every window. A row with fewer than WIDTH words, but any, is one window."""
    n = len(words.hash)
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    if n >= WIDTH:
        value, plain = chained(words.hash, WIDTH), np.zeros(n - WIDTH + 1, dtype=np.int64)
        for k in range(WIDTH):
            plain += words.kind[k : n - WIDTH + 1 + k] == _WORD
        at = np.flatnonzero((row[: len(value)] == row[WIDTH - 1 :]) & (plain >= PLAIN))
        return row[at], at - words.bounds[row[at]], np.full(len(at), WIDTH), value[at]
    e = np.zeros(0, dtype=np.int64)
    return e, e, e, e.astype(np.uint64)


def exact_windows(words: Canonical, lengths: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, place and hash of runs of so many words as they are: all of WIDTH words, shorter ones that are whole sentences or lines."""
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    for n in lengths:
        value = chained(words.value, n)
        inside = row[: len(value)] == row[n - 1 :] if len(value) else np.zeros(0, dtype=bool)
        if n < WIDTH:
            inside &= words.begins[: len(value)] & words.ends[n - 1 :]
        at = np.flatnonzero(inside)
        yield row[at], at - words.bounds[row[at]], mix(value[at] + _EXACT * np.uint64(n))


def bare_windows(words: tuple[Canonical, Canonical]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, place and hash of the words as they are of rows without a template window: runs of WIDTH words or, of rows with fewer, all of them."""
    own, size = words[1], np.diff(words[1].bounds)
    none = np.ones(len(size), dtype=bool)
    for w in words:
        none[windows(w)[0]] = False
    for n in range(1, WIDTH + 1):
        which = np.flatnonzero(none & (size == n if n < WIDTH else size >= n))
        if len(which):
            row = np.repeat(which, size[which] - n + 1)
            at = np.concatenate([np.arange(k) for k in size[which] - n + 1])
            yield row, at, mix(chained(own.value, n)[own.bounds[row] + at] + _EXACT * np.uint64(n))


_SLOTS = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.int64())]))
WINDOW_COLUMNS = "w long, at int, slots array<struct<kind:int,value:long>>, readings array<int>"


def _slots(words: Canonical, row: np.ndarray, at: np.ndarray) -> pa.Array:
    """For each window the types of its words and the hashes of their values, in order; words that are no slots are left out."""
    index = (words.bounds[row] + at)[:, None] + np.arange(WIDTH)
    kind, value = words.kind[index], words.value[index].view(np.int64)
    slot = kind != _WORD
    offsets = np.concatenate([[0], np.cumsum(slot.sum(axis=1))]).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(kind[slot].astype(np.int32)), pa.array(value[slot])], names=["kind", "value"])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def _both(words: tuple[Canonical, Canonical]) -> Iterator[tuple[Canonical, list[int], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Words, readings, and row, place and hash of the windows that are alike in both readings, and of those that only one has."""
    changed = np.concatenate([[0], np.cumsum(words[0].kind != words[1].kind)])
    for k in (0, 1):
        row, at, _, value = windows(words[k])
        first = words[k].bounds[row] + at
        differs = changed[first + WIDTH] != changed[first]
        for which, own in ((~differs, [0, 1]), (differs, [k])):
            if k == 0 or own == [1]:
                yield words[k], own, (row[which], at[which], value[which])


def template_windows(df: DataFrame, key: str, text: str = "text", only: np.ndarray | None = None, exact: tuple[int, ...] = (), bare: bool = False) -> DataFrame:
    """(key, w, at, slots, readings): every template window, or those whose hash is among `only` (sorted), and the readings (0: names, 1: words) that it is in.

    Words as they are, as reading 2 and without slots: runs of the lengths `exact`, and with `bare` those of rows that have no template window.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                both = readings(block)
                plain = ((both[1], [2], found) for found in (bare_windows(both) if bare else exact_windows(both[1], exact)))
                for words, own, (row, at, value) in chain(_both(both), plain):
                    value = value.view(np.int64)
                    if shared is not None and len(value):
                        known = shared.value
                        if len(known):
                            hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value)
                        else:
                            hit = np.zeros(0, dtype=np.int64)
                        row, at, value = row[hit], at[hit], value[hit]
                    if len(value):
                        ways = pa.array([own] * len(value), pa.list_(pa.int32()))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + block.first)), pa.array(value), pa.array(at.astype(np.int32)), _slots(words, row, at) if own != [2] else pa.array([[]] * len(value), _SLOTS), ways], names=[key, "w", "at", "slots", "readings"])

    return map_batches(df.select(key, text), run, f"`{key}` {kind}, {WINDOW_COLUMNS}")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(id, item_id, coverage): the pairs of a document and a benchmark item that it holds.

    Rows without a key or text take no part, empty texts hold nothing, and an item without a word is in no document. Rows that repeat an id count as one document (or item) with all of their windows; a tie of several readings
    or items tells the best coverage of each pair. Other columns aren't read. Empty tables give an empty one.
    """
    bench = benchmark.where(F.col("item_id").isNotNull())
    items = written(template_windows(bench, "item_id", bare=True).withColumn("reading", F.explode("readings")).drop("readings"), "items", sparse=True)
    item = ["item_id", "reading"]
    sizes = items.groupBy(*item).agg(F.countDistinct("w").alias("size"))
    base = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    distinct = items.select("w").distinct()
    count = distinct.count()
    exact = () if items.where("reading = 2").isEmpty() else tuple(range(1, WIDTH + 1))
    if count <= broadcast_windows:
        known = np.sort(distinct.toArrow()["w"].to_numpy().astype(np.int64))
        found = template_windows(base, "id", only=known, exact=exact)
    else:
        found = template_windows(base, "id", exact=exact).join(distinct, "w", "left_semi")
    found = written(found.withColumn("way", F.explode("readings")).drop("readings"), "windows", sparse=True)
    pair = ["id", "way", *item]
    # an item's rarest windows, so many that a document without them holds too few of the others
    own, held = items.select(*item, "w").distinct(), written(found.select("id", "way", "w").distinct(), "held")
    often = own.join(held.groupBy("w").agg(F.count("*").alias("often")), "w", "left").join(sizes, item)
    place = F.row_number().over(Window.partitionBy(*item).orderBy(F.coalesce("often", F.lit(0)), "w"))
    rare = written(often.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(share * F.col("size")) + 1).select(*item, "w"), "rare")
    maybe = held.join(rare, "w").where("way <= reading").select(*pair).distinct()
    many = maybe.join(own, item).join(held, ["id", "way", "w"]).groupBy(*pair).agg(F.count("*").alias("n")).join(sizes, item).where(F.col("n") >= share * F.col("size"))
    many = written(many, "many", sparse=True)
    met = many.join(items.select(*item, "w", F.col("at").alias("item_at"), F.col("slots").alias("item_slots")), item).join(found, ["id", "way", "w"])
    met = written(met.withColumn("shift", F.col("at") - F.col("item_at")), "met")
    by_shift = [*pair, "shift"]
    along = met.groupBy(*by_shift).agg(F.countDistinct("w").alias("m"), F.max("size").alias("size")).where(F.col("m") >= share * F.col("size")).select(*by_shift)
    slots = lambda by: met.select(*by, F.explode(F.arrays_zip("item_slots", "slots")).alias("z")).select(*by, F.col("z.item_slots.kind").alias("kind"), F.col("z.item_slots.value").alias("x"), F.col("z.slots.value").alias("y")).distinct()

    def clashing(by: list[str]) -> DataFrame:
        one = slots(by).groupBy(*by, "kind", "x").agg(F.count("*").alias("c")).where("c > 1").select(*by)
        two = slots(by).groupBy(*by, "kind", "y").agg(F.count("*").alias("c")).where("c > 1").select(*by)
        return one.union(two).distinct()

    aligned = along.join(clashing(by_shift), by_shift, "left_anti").select(*pair)
    loose = many.select(*pair).join(clashing(pair), pair, "left_anti")
    agreed = aligned.union(loose).distinct()
    return many.join(agreed, pair, "left_semi").groupBy("id", "item_id").agg(F.max(F.col("n") / F.col("size")).alias("coverage"))


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids, ascending, comma-joined), coverage (the best, else 0): a row for each row of documents."""
    found = leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    per = written(found.groupBy("id").agg(F.sort_array(F.collect_list("item_id")).alias("ids"), F.max("coverage").alias("coverage")), "leaks")
    joined = docs.select("doc_id").join(per, F.col("doc_id") == F.col("id"), "left")
    return joined.select(
        "doc_id", F.col("ids").isNotNull().alias("contaminated"), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")).alias("items"), F.coalesce(F.round("coverage", 6), F.lit(0.0)).alias("coverage"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark item; columns as they were."""
    mine = clash_free(docs.schema, "leaked")
    bad = written(leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).select(F.col("id").alias(mine)).distinct(), "leaked")
    return docs.join(bad, F.col("doc_id") == F.col(mine), "left_anti")
