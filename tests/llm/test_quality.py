from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from harvestry.llm import quality


def kind(byte: int) -> str:
    if byte >= 192:
        return "lead"
    if byte >= 128:
        return "tail"
    c = chr(byte)
    for name, chars in (("newline", "\n"), ("space", " \t\x0b\x0c\r"), ("stop", ".!?"), ("punct", ",;:'\"-()")):
        if c in chars:
            return name
    return "upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if c.isdigit() else "symbol"


def plain_statistics(text: str) -> dict[str, float]:
    low = lambda b: bytes(x + 32 if 65 <= x <= 90 else x for x in b)
    data = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    kinds, own = Counter(map(kind, data)), [low(w) for w in words]
    counts, pairs = Counter(own), Counter(zip(own, own[1:], strict=False))
    n, chars, several = len(words), len(text), max(1, len(words) - 1)
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\x0b\x0c\r")]
    seen, again = set(), 0
    for line in lines:
        again += len(line) if low(line) in seen else 0
        seen.add(low(line))
    stops, size = sum(kind(w[-1]) == "stop" for w in words), [len(w) for w in words]
    p = np.array(list(counts.values())) / n
    has = lambda w, k: sum(kind(b) == k for b in w)
    return {f"share_{c}": kinds[c] / chars for c in quality._CLASSES} | {
        "log_chars": np.log1p(chars), "log_words": np.log1p(n), "word_length": np.mean(size), "word_length_spread": np.std(size), "distinct_words": len(counts) / n, "top_word": max(counts.values()) / n,
        "distinct_pairs": len(pairs) / several, "top_pair": max(pairs.values(), default=0) / several, "repeated_next": sum(a == b for a, b in zip(own, own[1:], strict=False)) / several,
        "capitalised": sum(kind(w[0]) == "upper" for w in words) / n, "upper_words": sum(has(w, "upper") > 1 and not has(w, "lower") for w in words) / n,
        "symbol_words": sum(has(w, "symbol") > 0 for w in words) / n, "stop_words_end": stops / n, "words_per_stop": n / (1 + stops), "log_lines": np.log1p(len(lines)), "words_per_line": n / max(1, len(lines)),
        "distinct_lines": len(seen) / max(1, len(lines)), "repeated_line_chars": again / len(data), "word_entropy": -(p * np.log2(p)).sum(), "longest_word": np.log1p(max(size)),
    }


def test_statistics_equal_plain_python():
    rng = random.Random(0)
    texts = ["Hello world. Hello again!\nhello world.\nA line\na line", "", None, "x", "ÉTÉ été #tag 12 34\n\n  \n", "the the the the", "W " * 5000, " \n\t "]
    texts += ["".join(rng.choice(["Ab", "b.", "\n", " ", " ", "#d", "12", "é", "X", "X ", "ab ", "(q)", "\t", "ab\n", "—"]) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    x = quality.statistics_of(pa.array(texts))
    assert x.shape == (len(texts), len(quality.FEATURES))
    for row, text in zip(x, texts, strict=True):
        if not (text or "").strip(" \t\n"):
            assert not row.any()
            continue
        want = plain_statistics(text)
        assert set(want) == set(quality.FEATURES)
        assert np.allclose(row, [want[f] for f in quality.FEATURES]), text


def test_a_split_has_the_best_gain():
    """One tree of depth one against every split of every feature."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, (80, 4)).astype(float)
    y = ((x[:, 2] > 6) | (rng.random(80) < 0.1)).astype(float)
    forest = quality.fit(x, y, trees=1, depth=1, rate=1.0)
    p = y.mean()
    g, h = y - p, np.full(80, p * (1 - p))
    gain = {}
    for j in range(4):
        for t in sorted(set(x[:, j]))[:-1]:
            left = x[:, j] <= t
            if h[left].sum() >= 3 and h[~left].sum() >= 3:
                gain[j, t] = sum(g[s].sum() ** 2 / (h[s].sum() + 2.0) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 2.0)
    best = max(gain, key=gain.get)
    assert forest.feature[0, 0] == best[0] and ((x[:, best[0]] > forest.threshold[0, 0]) == (x[:, best[0]] > best[1])).all()
    left = x[:, best[0]] <= best[1]
    assert np.allclose(forest.leaf[0], [g[s].sum() / (h[s].sum() + 2.0) for s in (left, ~left)])


def test_ids_of_any_type_long_texts_repeats_and_clashing_columns(spark):
    rows = [(f"d{i}", "BUY!! ### " * 9 if i % 3 else "one two three four five. " * (20_000 if i < 6 else 6), "k", 0.1) for i in range(120)]
    rows += [("d0", "again", "k", 0.1)] * 40
    docs = spark.createDataFrame(rows, "doc_id string, text string, score string, quality_score double")
    labels = spark.createDataFrame([(f"d{i}", int(i % 3 == 0), 0) for i in range(120)], "doc_id string, quality int, toxic int")
    report = quality.quality_report(docs, labels)
    assert report.columns == ["doc_id", "held_out", "score", "predicted"] and report.count() == len(rows)
    out = quality.score_quality(docs, quality.learn(docs, labels, 50))
    assert out.columns == ["doc_id", "text", "score", "quality_score"] and out.select("score").distinct().count() == 1


def test_blocks_do_not_matter():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["Aa", "b.", "c\n", "#d", "12"], k=rng.randint(0, 60))) for _ in range(200)]
    one = quality.statistics_of(pa.array(texts))
    many = np.concatenate([quality.statistics_of(pa.array([t])) for t in texts])
    assert np.allclose(one, many)


def walk(forest: quality.Forest, row: np.ndarray) -> float:
    z = forest.start
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
        at = 0
        while at < len(feature):
            at = 2 * at + 1 + int(row[feature[at]] > threshold[at])
        z += leaf[at - len(feature)]
    return 1 / (1 + np.exp(-z))


def test_trees_learn_and_vectorised_walk_is_the_plain_one():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = quality.fit(x[:1500], y[:1500])
    score = forest.score(x[1500:])
    assert ((score >= 0.5) == y[1500:]).mean() > 0.95
    assert np.allclose(score[:50], [walk(forest, r) for r in x[1500:1550]])


def test_one_label_or_none_is_a_constant():
    assert np.allclose(quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.ones((2, 3))), 0.5)
    assert quality.fit(np.zeros((30, 3)), np.ones(30)).score(np.ones((1, 3)))[0] > 0.99


def test_report(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choices(["one", "two", "three", "Four", "five.", "six", "seven"], k=40))
    bad = lambda: "BUY!! NOW!! ### " * rng.randint(5, 20)
    rows = [(i, bad() if i % 4 == 0 else good(), int(i % 4 != 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (None, "x")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = [r for r in quality.quality_report(docs, labels).collect()]
    assert len(got) == 303 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["predicted"] == y and by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, y in rows)
    assert by[1000]["score"] == by[1001]["score"]
    assert quality.quality_report(docs.limit(0), labels.limit(0)).collect() == []
