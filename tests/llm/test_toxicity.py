from __future__ import annotations

import random
import zlib

import numpy as np

from harvestry.llm import toxicity
from harvestry.llm.common import held_out, training_labels

MODEL = toxicity.Model({"idiot": 3.0, "clown": 2.0, "trash": 2.0, "scum": 2.0, "scumbag": 4.0}, curve=(-3.0, 2.0, 0.5, 1.0))


def found(text: str) -> list[str]:
    return [text[a:b] for a, b, _ in MODEL.hits(text)]


def test_folding_and_boundaries():
    assert found("You IDIOT, 1d10t! іdiоt ｉｄｉｏｔ id!ot $cum") == ["IDIOT", "1d10t", "іdiоt", "ｉｄｉｏｔ", "id!ot", "$cum"]
    assert found("idiotic antitrash trash1 strash") == []
    assert found("idiot!!! (trash)") == ["idiot", "trash"]
    assert found("scumbag") == ["scumbag"]


def test_exceptions():
    assert found("the trash can is a clown fish") == []
    assert found("the trash can hide trash") == ["trash"]


def test_length_normalises():
    short, long = MODEL.score(["idiot here", "idiot here " + "word " * 500])
    assert short > long > MODEL.score([""])[0]
    assert MODEL.score([None])[0] == MODEL.score([""])[0]


def corpus(n: int = 400) -> list[tuple[int, str, int]]:
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijk", k=5)) for _ in range(300)]
    out = []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(words, k=40)
        if toxic:
            text += rng.choices(["zorgon", "idiot", "mufwit"], k=3)
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_learns_words_and_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert {"zorgon", "mufwit", "idiot"} <= set(model.weights)
    got = {r["doc_id"]: r for r in toxicity.toxicity_report(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, _, y in rows:
        assert got[i]["predicted"] == y and 0 <= got[i]["score"] <= 1
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    kept = toxicity.drop_toxic(docs.withColumnRenamed("text", "text").selectExpr("*", "1 AS toxicity"), labels)
    assert kept.columns == ["doc_id", "text", "toxicity"] and {r["doc_id"] for r in kept.collect()} == {i for i, _, y in rows if not y}


def test_no_labels_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "you idiot"), (4, "x " * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(docs, none).collect()
    assert len(got) == 4 and all(r["held_out"] in (True, False) for r in got)
    assert toxicity.toxicity_report(docs.limit(0), none).collect() == []


def test_training_rows_are_bounded_and_never_held_out(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, toxic int")
    rows = training_labels(labels, "toxic", 50).collect()
    assert len(rows) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows)
    every = training_labels(labels, "toxic", 10_000).collect()
    assert len({r["doc_id"] for r in every}) == len(every)
    out = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", held_out(toxicity.F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)


def test_curve_separates():
    x = np.r_[np.zeros((50, 2)), np.ones((50, 2))]
    w = toxicity.fit_curve(x, np.r_[np.zeros(50), np.ones(50)])
    assert w[0] < 0 < w[0] + w[1] + w[2]


def plain_hits(model: toxicity.Model, text: str) -> list[tuple[int, int, float]]:
    """Every word of the lexicon looked for at every place, in both foldings."""
    counted, spared = {}, []
    for k, form in enumerate((toxicity.fold, toxicity.fold_digits)):
        if k and not any(c in "013456789@$!|" for c in text):
            continue
        own = form(text)
        for word, weight in [*model.weights.items(), *((p, None) for p in model.exceptions)]:
            for a in range(len(text) - len(word) + 1):
                b = a + len(word)
                if own[a:b] == form(word) and not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum()):
                    if weight is None:
                        spared.append((a, b))
                    else:
                        counted[a, b] = max(weight, counted.get((a, b), weight))
    out: list[tuple[int, int, float]] = []
    for a, b in sorted(counted, key=lambda s: (s[0], -s[1])):
        if all(b > y for _, y, _ in out) and not any(x <= a and b <= y for x, y in spared):
            out.append((a, b, counted[a, b]))
    return out


def test_automata_equal_a_plain_scan():
    rng = random.Random(6)
    model = toxicity.Model({"idiot": 3.0, "clown": 2.0, "trash": 2.0, "scum": 2.0, "scumbag": 4.0, "bag": 1.0, "ill": 1.0}, ("trash can", "clown fish", "scumbag bag"))
    swaps = {"i": "1!|іі", "o": "0оο", "s": "$5ѕ", "a": "4@а", "c": "сϲ", "l": "1|", "t": "7т"}
    for _ in range(400):
        text = "".join(rng.choice([*model.weights, *model.exceptions, "word", "antitrash", "x", "can", "fish"]) + rng.choice([" ", " ", "", "-", "9", "!"]) for _ in range(rng.randint(0, 9)))
        text = "".join(rng.choice(swaps[c]) if c in swaps and rng.random() < 0.2 else c.upper() if rng.random() < 0.1 else c for c in text)
        assert model.hits(text) == plain_hits(model, text), text


def test_ids_of_any_type_repeated_ids_and_clashing_columns(spark):
    rows = corpus()
    docs = spark.createDataFrame([(f"d{i}", t, "k", 0.5) for i, t, _ in rows] + [(f"d{k}", "again and again", "k", 0.5) for k in (1, 1, 1, 3)], "doc_id string, text string, score string, toxicity double")
    labels = spark.createDataFrame([(f"d{i}", 1, y) for i, _, y in rows], "doc_id string, quality int, toxic int")
    assert toxicity.sample_texts(docs, labels, "toxic", 100).count() == 100
    assert toxicity.toxicity_report(docs, labels).count() == len(rows) + 4
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.select("score", "toxicity").distinct().count() == 1
