from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from harvestry.llm import neardup
from harvestry.llm.kernel import blocks, sets, tokens

SCHEMA = "doc_id long, text string"


def brute(rows: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, tuple[int, int]]:
    found = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        found[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    own = {i: i for i in found}

    def find(a: int) -> int:
        while own[a] != a:
            a = own[a]
        return a

    ids = sorted(found)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(found[a] & found[b])
            if both and 100 * both >= percent * len(found[a] | found[b]):
                p, q = find(a), find(b)
                own[max(p, q)] = min(p, q)
    return {i: (len(found[i]), find(i)) for i in ids}


def words_of(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


def family(rng: random.Random, first: int, n: int, length: int, most: int) -> list[tuple[int, str]]:
    base, out = words_of(rng, length), []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, most)):
            text[rng.randrange(length)] = words_of(rng, 1)[0]
        out.append((first + i, " ".join(text)))
    return out


@pytest.mark.parametrize("tile", [8, 512])
def test_components_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", tile)
    rng = random.Random(3)
    rows = family(rng, 0, 90, 120, 14) + family(rng, 1000, 40, 60, 5) + [(2000 + k, " ".join(words_of(rng, 40))) for k in range(30)]
    rows += [(3000 + k, rows[0][1].upper()) for k in range(25)] + [(4000, None), (4001, ""), (4002, " \t\n"), (4003, "one two"), (4004, "One  two"), (4005, "one")]
    rng.shuffle(rows)
    found = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), width=3, percent=85).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows, 3, 85)


def test_empty_null_and_repeated_keys(spark):
    assert neardup.near_duplicate_report(spark.createDataFrame([], SCHEMA)).collect() == []
    long = " ".join(words_of(random.Random(1), 30))
    df = spark.createDataFrame([(1, long, "x"), (1, long, "y"), (None, long, "z"), (2, long, None), (3, "other words here now", "k")], "doc_id long, text string, kept string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in neardup.near_duplicate_report(df).collect())
    assert got == [(-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    left = neardup.keep_one_of_each(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 1, 3]


def test_a_repeated_key_ties_its_texts(spark):
    rng = random.Random(2)
    a, b = " ".join(words_of(rng, 30)), " ".join(words_of(rng, 30))
    df = spark.createDataFrame([(5, a), (5, b), (1, a), (2, b)], SCHEMA)
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, width=3).collect()} == {5: 1, 1: 1, 2: 1}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    one, two = rng.integers(0, 1 << 63, 900, dtype=np.uint64), rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    a, b = np.unique(one), np.unique(np.r_[one[:850], two])
    assert (neardup.merge(neardup.sketch(a), neardup.sketch(b)) == neardup.sketch(np.union1d(a, b))).all()
    j = neardup.similarity(neardup.sketch(a)[None], neardup.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(j - 850 / 1000) < 0.1


def test_intersections_count_all_pairs():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 300, rng.integers(0, 200)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(x, y)) for y in rows] for x in rows]
    got = neardup.intersections(rows)
    off = ~np.eye(len(rows), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


def test_words_and_shingles_of_blocks():
    texts = ["A b C", "", "x", None, "é Ünï\tcode one  two", "a b c a b c"]
    (block,) = blocks(pa.array(texts))
    tok = tokens(block)
    assert np.diff(tok.bounds).tolist() == [3, 0, 1, 0, 4, 6]
    assert [len(s) for s in sets(tok, 3)] == [1, 0, 1, 0, 2, 3]
    assert tok.hash[0] == tokens(next(blocks(pa.array(["a"])))).hash[0]


def test_components_of_a_chain(spark):
    n = 60
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)], "a long, b long")
    assert {(r["id"], r["component"]) for r in neardup.components(edges).collect()} == {(k, 0) for k in range(1, n + 1)}


def test_words_that_swap_two_letters_everywhere_are_unlike(spark):
    one = "a"
    for _ in range(10):
        one += "".join("b" if c == "a" else "a" for c in one)
    two = "".join("b" if c == "a" else "a" for c in one)
    words = [one[k : k + 1] * 3 for k in range(64)]  # the same order of two words
    rows = [(1, f"x y {one} z q"), (2, f"x y {two} z q"), (3, " ".join(words)), (4, " ".join("bbb" if w == "aaa" else "aaa" for w in words))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicate_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows, 3, 85)
    assert got[2][1] == 2


def test_pages_of_one_template_are_compared_in_the_bucket_that_they_share(spark, monkeypatch):
    """With tiny limits: buckets are split by families and dealt in blocks, and no link is lost."""
    monkeypatch.setattr(neardup, "HOT", 400)
    monkeypatch.setattr(neardup, "ROWS_MET", 32)
    rng = random.Random(17)
    frame = words_of(rng, 120)
    rows = [(i, " ".join(frame + words_of(rng, 60))) for i in range(150)]
    near = words_of(rng, 200)
    for i in range(150, 260):  # a group around the threshold, whose first member links to few
        own = list(near)
        for k in rng.sample(range(200), rng.randint(4, 10)):
            own[k] = words_of(rng, 1)[0]
        rows.append((i, " ".join(own)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicate_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows, 3, 85)


def test_very_long_texts_and_words(spark):
    rng = random.Random(2)
    long = " ".join(words_of(rng, 60_000))
    rows = [(1, long), (2, long + " tail"), (3, "w" * 3_000_000), (4, "w" * 2_999_999 + "v"), (5, long)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicate_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
