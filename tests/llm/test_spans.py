from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from harvestry.llm import spans
from harvestry.llm.kernel import blocks, tokens

SCHEMA = "doc_id long, text string"


def pieces(text: str) -> tuple[list[str], list[tuple[int, int]], list[int]]:
    """Words in lower case, their places, and the first word of each sentence, the plain way."""
    words, places, first, last = [], [], [], None
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if last is None or text[last.end() - 1] in ".!?" or "\n" in text[last.end() : m.start()]:
            first.append(len(words))
        words.append("".join(c.lower() if "A" <= c <= "Z" else c for c in m[0]))
        places.append(m.span())
        last = m
    return words, places, first


def later(found: list[tuple[tuple, int, int, int]]) -> dict[int, set[int]]:
    """Words (by id) of all spans (words, id, a, b) but the first of each."""
    first: dict[tuple, tuple[int, int]] = {}
    out: dict[int, set[int]] = {}
    for words, i, a, b in sorted(found):
        if first.setdefault(words, (i, a)) != (i, a):
            out.setdefault(i, set()).update(range(a, b))
    return out


def brute(rows: list[tuple[int, str | None]]) -> tuple[dict[int, set[int]], dict[int, set[int]]]:
    """Words that have to go (repeated runs of sentences, passages of SEEN words), and words that may go (repeats of MIN_WORDS words as well)."""
    found, long, short = [], [], []
    for i, text in rows:
        words, _, first = pieces(text or "")
        cuts, n = [*first, len(words)], len(first)
        enough = lambda a, b, cuts=cuts: b - a >= spans.RUN and cuts[b] - cuts[a] >= spans.MIN_WORDS
        ahead = {(a, b) for a in range(n) for b in range(a, n + 1) if enough(a, b) and not enough(a, b - 1)}
        ends = {b for _, b in ahead}
        back = {(a, b) for a in range(n) for b in range(a, n + 1) if b not in ends and enough(a, b) and not enough(a + 1, b)}
        shape = lambda a, b, w=words, c=cuts: tuple(tuple(w[c[k] : c[k + 1]]) for k in range(a, b))
        found += [(shape(a, b), i, cuts[a], cuts[b]) for a, b in ahead | back]
        for size, into in ((spans.SEEN, long), (spans.MIN_WORDS, short)):
            into += [(tuple(words[k : k + size]), i, k, k + size) for k in range(len(words) - size + 1)]
    runs, must, may = later(found), later(long), later(short)
    ids = [i for i, _ in rows]
    return {i: runs.get(i, set()) | must.get(i, set()) for i in ids}, {i: runs.get(i, set()) | may.get(i, set()) for i in ids}


def cut(text: str | None, gone: set[int]) -> tuple[int, int, str | None]:
    """Sentences, those that lost words, and the text without the words and the white space after each."""
    _, places, first = pieces(text or "")
    touched = {max(k for k, a in enumerate(first) if a <= w) for w in gone}
    left, at = "", 0
    for w in sorted(gone):
        left += (text or "")[at : places[w][0]]
        at = places[w + 1][0] if w + 1 < len(places) else len(text or "")
    return len(first), len(touched), None if text is None else left + text[at:]


def sentence(rng: random.Random, most: int = 18) -> str:
    return " ".join("".join(rng.choices("abcdeé", k=4)) for _ in range(rng.randint(1, most))).capitalize() + rng.choice([". ", "! ", "?\n", ".\n\n"])


def test_equals_brute_force(spark):
    rng = random.Random(9)
    passages = ["".join(sentence(rng) for _ in range(6)) for _ in range(4)]
    long = " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(60)) + ". "
    rows: list[tuple[int, str | None]] = []
    for i in range(120):
        text = "".join(sentence(rng) for _ in range(rng.randint(0, 12)))
        if i % 3 == 0:
            text += rng.choice(passages) + "".join(sentence(rng) for _ in range(3))
        if i % 10 == 0:
            text = text + long + sentence(rng)
        if i % 17 == 0:
            text += "Again and again and more words here. " * 8
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " \n"), (203, rows[5][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    runs, words = spans.repeats(df)
    gone: dict[int, set[int]] = {i: set() for i, _ in rows}
    texts = dict(rows)
    for r in runs.collect():
        _, places, first = pieces(texts[r["id"]])
        gone[r["id"]] |= set(range(first[r["at"]], [*first, len(places)][r["at"] + r["length"]]))
    for r in words.collect():
        gone[r["id"]] |= set(range(r["a"], r["b"]))
    must, may = brute(rows)
    assert all(must[i] <= gone[i] <= may[i] for i in gone)
    assert sum(map(len, must.values())) > 1000
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in spans.span_report(df).collect()}
    assert got == {i: cut(t, gone[i]) for i, t in rows}


@pytest.mark.parametrize("words", [51, 60, 120])
def test_a_passage_of_one_long_sentence_goes(spark, words):
    passage = " ".join(f"w{k}" for k in range(words)) + "."
    rows = [(1, "Head one here. " + passage + " Tail one."), (2, "Other start now.\n" + passage + " Something else.")]
    got = {r["doc_id"]: r["text"] for r in spans.span_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == rows[0][1] and got[2] == "Other start now.\nSomething else."


def test_a_passage_inside_sentences_goes_but_for_its_ends(spark):
    passage = " ".join(f"v{k}" for k in range(120))
    rows = [(1, "a few words before " + passage + " and some words after"), (2, "quite another beginning of the text " + passage + " with its own end")]
    got = {r["doc_id"]: r["text"] for r in spans.span_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == rows[0][1]
    assert len(re.findall(r"v\d+", got[2])) < 40 and got[2].startswith("quite another beginning") and got[2].endswith("its own end")


def test_a_passage_of_very_short_sentences_goes(spark):
    passage = " ".join(f"W{k}!!" for k in range(55))
    rows = [(1, "Some head. " + passage), (2, "Another head here. " + passage + " Tail.")]
    got = {r["doc_id"]: r["text"] for r in spans.span_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: rows[0][1], 2: "Another head here. Tail."}


def test_null_keys_repeats_and_clashing_columns(spark):
    passage = "one two three four five six seven. eight nine ten eleven twelve thirteen. fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(None, passage, 1), (1, passage, 2), (1, passage, 2), (2, passage, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int")
    out = spans.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "gone", "n_sentences", "n_removed"]
    assert sorted((r["gone"], r["text"]) for r in out.collect()) == [(1, passage), (2, passage), (2, passage), (3, "")]
    assert spans.span_report(df.limit(0)).collect() == []


@pytest.mark.parametrize("stops", [True, False])
def test_passages_inside_sentences_of_unlike_contexts_go_whole(spark, stops):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    prose = lambda n: " ".join(word() + ("." if stops and rng.random() < 0.1 else "") for _ in range(n))
    rows, want = [], {}
    for k in range(120):
        passage = " ".join([word(), prose(rng.choice([49, 58, 78])), word()])
        for copy in range(3):
            a, b = prose(rng.randint(3, 30)) + " " + word(), word() + " " + prose(rng.randint(3, 30))
            # the third copy is longer than the first by words that only the second shares
            more = f"{word()} {word()} {word()}" if copy == 1 else more if copy == 2 else ""
            rows.append((3 * k + copy, " ".join(x for x in (a, more, passage, b) if x)))
            want[3 * k + copy] = rows[-1][1] if copy == 0 else f"{a} {more} {b}" if copy == 1 else f"{a} {b}"
    got = {r["doc_id"]: r["text"] for r in spans.span_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == want
