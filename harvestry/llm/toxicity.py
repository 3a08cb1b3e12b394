"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding, normalised by length, with exception phrases.

Folding keeps the number of code points. Letters of other scripts that look like Latin ones become those; in a second variant
digits and signs that stand for letters are folded as well (with i and l as one letter, as 1 stands for both). A match must
not have letters or digits of the original text beside it. Matches inside an exception phrase don't count.

Weights are smoothed log odds of a word's document frequencies in a bounded sample of labelled rows; near copies in it count
once. Seed words without support in the sample keep a prior weight. A logistic curve over the total weight, the weight per
100 words and the number of hits gives the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import clash_free, held_out, map_batches, sampled_texts, training_labels, written
from harvestry.llm.kernel import blocks, shingles, tokens
from harvestry.session import reachable

TRAINING_ROWS = 8000
THRESHOLD = 0.3
PRIOR_WEIGHT = 2.0
LEXICON_SIZE = 500

SEEDS = (
    "asshole bastard bitch clown coward creep cretin cunt degenerate dimwit disgusting dumbass fool freak garbage hateful idiot "
    "imbecile jerk kys loser lowlife maggot moron parasite pathetic pig pigs retard scum scumbag shithead slut stupid subhuman "
    "trash ugly useless vermin whore worthless"
).split()
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "white trash compactor", "clown fish", "class clown award", "idiot proof", "garbage collection", "garbage collector", "garbage truck", "guinea pig", "guinea pigs", "parasite host", "jerk chicken", "ugly duckling")

#: Look-alikes of a-z in Cyrillic, Greek and Armenian, and accented forms used to hide a letter.
_ALIKE = {"a": "аαɑ", "b": "Ьв", "c": "сϲ", "d": "ԁ", "e": "еεёє", "g": "ɡ", "h": "һհ", "i": "іιїı", "j": "јϳ", "k": "кκ", "l": "ӏⅼ", "m": "м", "n": "ո", "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ"}
FOLD = {ord(c): latin for latin, alike in _ALIKE.items() for c in alike}
FOLD |= {0xFF21 + k: chr(97 + k) for k in range(26)} | {0xFF41 + k: chr(97 + k) for k in range(26)} | {65 + k: chr(97 + k) for k in range(26)}
DIGITS = FOLD | {ord(a): b for a, b in zip("013456789@$!|lL", "oieasgtbgasiiii", strict=True)}
_STANDS_IN = re.compile(r"[013456789@$!|]")
_WORD = re.compile(r"[^\W\d_]{3,}")


def fold(text: str) -> str:
    """Latin look-alikes and A-Z to a-z, one code point for one."""
    return text.translate(FOLD)


def fold_digits(text: str) -> str:
    """fold, and digits and signs to the letters they stand for; l becomes i."""
    return text.translate(DIGITS)


@dataclass
class Model:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-4.0, 1.0, 0.5, 2.0)
    _automata: list = field(default_factory=list, repr=False)

    def automata(self) -> list:
        """Automata of the plain and of the digit-folded forms; a payload is (length, weight), with weight None for exceptions."""
        import ahocorasick

        if not self._automata:
            for form in (fold, fold_digits):
                a = ahocorasick.Automaton()
                for word, w in self.weights.items():
                    a.add_word(form(word), (len(word), w))
                for phrase in self.exceptions:
                    a.add_word(form(phrase), (len(phrase), None))
                if len(a):
                    a.make_automaton()
                    self._automata.append((form, a))
        return self._automata

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automata": []}

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of what counts; nested matches count once, with the longest."""
        found: dict[tuple[int, int], float] = {}
        spared: list[tuple[int, int]] = []
        n = len(text)
        for k, (form, automaton) in enumerate(self.automata()):
            if k and not _STANDS_IN.search(text):
                break
            for last, (length, weight) in automaton.iter(form(text)):
                a, b = last + 1 - length, last + 1
                if (a and text[a - 1].isalnum()) or (b < n and text[b].isalnum()):
                    continue
                if weight is None:
                    spared.append((a, b))
                else:
                    found[a, b] = max(weight, found.get((a, b), weight))
        out, reach = [], -1
        for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
            if b > reach and not any(x <= a and b <= y for x, y in spared):
                out.append((a, b, found[a, b]))
                reach = b
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        """Total weight, weight per 100 words, and hits, all damped."""
        hits = self.hits(text) if text else []
        if not hits:
            return 0.0, 0.0, 0.0
        total, words = sum(w for _, _, w in hits), text.count(" ") + text.count("\n") + 1
        return float(np.log1p(total)), float(np.log1p(100 * total / words)), float(np.log(len(hits)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t or "") for t in texts], dtype=float).reshape(-1, 3)
        z = self.curve[0] + x @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sample_texts(docs: DataFrame, labels: DataFrame, column: str, limit: int) -> DataFrame:
    """The texts of the training rows (doc_id, y, text), written once, at most `limit` of them: an id that repeats in docs counts once."""
    reachable(docs.sparkSession)
    return written(sampled_texts(docs, training_labels(labels, column, limit)).select("doc_id", "y", "text"), "training", sparse=True)


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        signature: list[int] = []
        for block in blocks(pa.array(pdf["text"], type=pa.string())):
            rows, values = shingles(tokens(block), 3)
            least = np.full(block.rows, 0, dtype=np.uint64)
            if len(rows):
                at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                least[rows[at]] = np.minimum.reduceat(values, at)
            signature += (least >> np.uint64(1)).astype(np.int64).tolist()
        out = [(w, int(y), s) for text, y, s in zip(pdf["text"], pdf["y"], signature, strict=True) for w in set(_WORD.findall(fold(text or "")))]
        yield pd.DataFrame(out, columns=["word", "y", "signature"])


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Model:
    """Lexicon and curve from at most `limit` labelled rows, which ids of any type name. Without toxic or without clean rows the seeds keep their priors.

    A word enters if at least 5 and at least 1 % of the toxic texts hold it and its log odds reach 2.5; texts with the same
    smallest shingle hash count as one, so a group of copies can't make its words look toxic.
    """
    sample = sample_texts(docs, labels, "toxic", limit)
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    weights = dict.fromkeys(SEEDS, PRIOR_WEIGHT)
    if not toxic or not clean:
        return Model(weights)
    in_texts = sample.mapInPandas(_words, "word string, y int, signature long").groupBy("word", "y").agg(F.countDistinct("signature").alias("n"))
    counts = in_texts.groupBy("word").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c"))
    odds = F.log((F.col("t") + 0.1) / (toxic + 0.2)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    strong = (F.col("t") >= max(5, toxic // 100)) & (odds >= 2.5)
    known = F.col("word").isin(SEEDS) & (F.col("t") + F.col("c") >= 5)
    for r in counts.where(strong | known).select("word", odds.alias("w")).orderBy(F.desc("w"), "word").limit(LEXICON_SIZE).collect():
        weights[r["word"]] = max(0.0, float(r["w"]))
    model = Model({w: x for w, x in weights.items() if x > 0})
    rows = sorted((r["doc_id"], r["y"], r["a"], r["b"], r["c"]) for r in sample.mapInPandas(_features(model), f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y int, a double, b double, c double").collect())
    model.curve = fit_curve(np.array([r[2:] for r in rows]), np.array([r[1] for r in rows]))
    return model


def _features(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array([model.features(t or "") for t in pdf["text"]], dtype=float).reshape(-1, 3)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})

    return run


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression with an L2 penalty by Newton's method; slopes are kept from going below zero."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [0.1] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_toxicity(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """df with a double column `out` from 0 to 1; null and empty texts get the curve's value without any hit.

    A column named `out` is replaced; others pass through. Rows that repeat have equal scores, texts are read whole, and an empty table gives an empty one.
    """
    base = df.drop(out)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"`{out}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, scores = batch.column(batch.schema.get_field_index(text)), []
            for at in range(0, batch.num_rows, 256):
                scores.append(model.score(column.slice(at, 256).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else [], type=pa.float64())], names=[*batch.schema.names, out])

    return map_batches(base, run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, for each row of documents."""
    scored = score_toxicity(docs.select("doc_id", "text"), learn(docs, labels), out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score THRESHOLD or more; columns as they were, whatever their names. Null and empty texts stay, as do null ids; repeated rows stay or go together."""
    out = clash_free(docs.schema, "toxicity")
    return score_toxicity(docs, learn(docs, labels), out=out).where(F.col(out) < THRESHOLD).drop(out)
