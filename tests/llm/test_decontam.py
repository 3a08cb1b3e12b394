from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from harvestry.llm import decontam
from harvestry.llm.kernel import blocks

ITEM = "A farmer named Jones has 12 sheep and 30 cows; how many legs do the animals of Jones have in total if each has 4 legs?"
OTHER = "The quick brown fox jumps over the lazy dog while seven wizards quietly watch from behind the old stone wall near home."
BENCH = [(1, ITEM), (2, OTHER), (3, None), (4, "too short")]


def found(spark, docs, bench=BENCH, **more):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    return sorted((r["id"], r["item_id"]) for r in decontam.leaks(d, b, **more).collect())


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_leaks(spark, limit):
    text = "Some words come first. "
    changed = ITEM.replace("12", "77").replace("30", "41").replace("Jones", "Smith")
    clash = ITEM.replace("of Jones", "of Smith")
    docs = [
        (1, text + ITEM + " And more."), (2, OTHER.upper().capitalize().lower()), (3, text + changed), (4, text + clash), (5, "nothing of the kind is in here at all, not a word of it"), (6, None), (7, ""),
        (None, ITEM), (8, " ".join(OTHER.split()[:9])), (9, OTHER.replace(" ", "\n")), (10, "filler words go here " * 3000 + ITEM), (11, ITEM + " " + OTHER), (12, "SHOUTED WORDS ARE HERE! " + ITEM.upper()), (1, text + ITEM + " And more."),
    ]
    assert found(spark, docs, broadcast_windows=limit) == [(1, 1), (2, 2), (3, 1), (9, 2), (10, 1), (11, 1), (11, 2), (12, 1)]


def test_twice_with_other_values_is_seen_by_alignment(spark):
    one, two = ITEM, ITEM.replace("12", "50").replace("Jones", "Brown")
    assert found(spark, [(1, f"{one} {two}")]) == [(1, 1)]


def test_canonical_types():
    (block,) = blocks(pa.array(["We saw Anna run 5 km, 10kg or 3.5 apples. Then Öre left É. x", "", "..."]))
    c = decontam.canonical(block)
    words = [block.data[a:b].tobytes().decode() for a, b in zip(c.start, c.end, strict=True)]
    kinds = dict(zip(words, c.kind.tolist(), strict=True))
    assert kinds == {"We": 0, "saw": 0, "Anna": 4, "run": 0, "5": 1, "km": 3, "10kg": 2, "or": 0, "3.5": 1, "apples": 0, "Then": 0, "Öre": 4, "left": 0, "É": 4, "x": 0}
    assert c.bounds.tolist() == [0, 15, 15, 15]


def test_letter_case_of_other_scripts():
    for text in ("Éàß×Þ Größe", "Ελληνικά ΑΩΡΣ", "Русский ЯЁ Текст"):
        (block,) = blocks(pa.array([text]))
        got = decontam.folded(block.data).tobytes().decode()
        assert got == "".join(c if c in "Ёά" else c.lower() for c in text)


def test_report_and_filter(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean text of some words here", "b"), (None, None, "c")], "doc_id long, text string, leaked string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in decontam.decontamination_report(docs, bench).collect()}
    assert got == {1: (True, 1, "1", 1.0), 2: (False, 0, "", 0.0), None: (False, 0, "", 0.0)}
    left = decontam.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r["leaked"] for r in left.collect()) == ["b", "c"]
    assert decontam.decontamination_report(docs.limit(0), bench.limit(0)).collect() == []


def test_a_passage_in_capitals_or_title_case_inside_a_longer_text(spark):
    text = "some quiet words in lower case that go on and on for a while. " * 20
    docs = [(1, text + OTHER.upper() + " " + text), (2, text + OTHER.title()), (3, text + ITEM.upper() + " " + text), (4, text + "The Quick Brown Fox Jumps Over Some Other Things Of This Kind.")]
    assert found(spark, docs) == [(1, 2), (2, 2), (3, 1)]


def test_names_of_other_scripts_are_placeholders(spark):
    russian = "однажды утром старый учитель Иванов купил в магазине три яблока и отдал соседу Иванов половину, сколько осталось у него теперь"
    greek = "ένα πρωί ο δάσκαλος Γιώργος αγόρασε τρία μήλα από την αγορά και έδωσε τα μισά στον γείτονα, πόσα έμειναν τώρα"
    docs = [(1, "до того " + russian.replace("Иванов", "Петров") + " и потом"), (2, greek.replace("Γιώργος", "Νίκος"))]
    assert found(spark, docs, [(1, russian), (2, greek)]) == [(1, 1), (2, 2)]


def test_short_items_are_found_as_whole_sentences(spark):
    items = [(1, "What is 12 + 30?"), (2, "Who wrote Hamlet?"), (3, "12 + 30 = 42, 7 * 8 = 56"), (4, "..."), (5, "Yes.")]
    docs = [
        (1, "Some text. What is 12 + 30? It is 42."), (2, "What is 12 + 31? Not that."), (3, "a question:\nwho wrote hamlet\nand more"), (4, "the man who wrote Hamlet died. What is 12 + 30 more?"),
        (5, "see 12 + 30 = 42, 7 * 8 = 56 there"), (6, "12 + 30 = 43, 7 * 8 = 56"), (7, "Yes"), (8, "yes men"), (9, ""),
    ]
    assert found(spark, docs, items) == [(1, 1), (3, 2), (5, 3), (7, 5)]


def reading(text: str) -> list[tuple[str, int, int, bool, bool]]:
    """(word, kind with names, kind without, begins, ends) the plain way."""
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        core = re.search(r"[0-9A-Za-z\x80-\U0010ffff](?:.*[0-9A-Za-z\x80-\U0010ffff])?", m[0])
        if core:
            out.append((core[0], m[0], m.start()))
    loud = [re.search("[A-Z]", c) and not re.search("[a-z]", c) for c, _, _ in out]
    lettered = [re.search(r"[^\d\W_]|[\x80-\U0010ffff]", c) for c, _, _ in out]
    shouted = 2 * sum(map(bool, loud)) >= max(1, sum(map(bool, lettered)))
    kinds: list[list[int]] = [[], []]
    for k, (core, _, _) in enumerate(out):
        digits, letters = len(re.findall("[0-9]", core)), sum(len(c.encode()) for c in core if not c.isascii() or c.isalpha())
        kind = 1 if digits and not letters else 2 if digits and letters <= 4 and core[0].isdigit() and not core[-1].isdigit() else 0
        opens = k == 0 or out[k - 1][1][-1] in ".!?:"
        kinds[1].append(kind)
        kinds[0].append(4 if kind == 0 and core[0] != core[0].lower() and not opens and not shouted else kind)
    units = set(decontam.UNITS)
    for own in kinds:
        own[:] = [3 if k and kind == 0 and own[k - 1] == 1 and out[k][0].lower() in units else kind for k, kind in enumerate(own)]
    cut = [k == 0 or bool(re.search(r"[.!?:;]$", out[k - 1][1])) or "\n" in text[out[k - 1][2] : out[k][2]] for k in range(len(out))] + [True]
    return [(c.lower(), a, b, cut[k], cut[k + 1]) for k, ((c, _, _), a, b) in enumerate(zip(out, *kinds, strict=True))]


def plain_windows(words: list, way: int) -> list[tuple[int, tuple, list]]:
    """(place, template, slots) of every window in a reading; reading 2: words as they are, and whole sentences of fewer."""
    if way == 2:
        five = [(k, tuple(w[0] for w in words[k : k + 5]), []) for k in range(len(words) - 4)]
        return five + [(k, tuple(w[0] for w in words[k : k + n]), []) for n in range(1, 5) for k in range(len(words) - n + 1) if words[k][3] and words[k + n - 1][4]]
    out = []
    for k in range(len(words) - 4):
        part = [(w[0], w[1 + way]) for w in words[k : k + 5]]
        if sum(kind == 0 for _, kind in part) >= 2:
            out.append((k, tuple((w if kind == 0 else kind) for w, kind in part), [(kind, w) for w, kind in part if kind]))
    return out


def agree(pairs: list[tuple[list, list]]) -> bool:
    there, back = {}, {}
    return all(there.setdefault(x, y) == y and back.setdefault((y[0], y[1]), x) == x for a, b in pairs for x, y in zip(a, b, strict=True))


def plain_leaks(docs, items) -> set[tuple[int, int, float]]:
    out: dict[tuple[int, int], float] = {}
    for j, item in items:
        words = reading(item)
        ways = {r: plain_windows(words, r) for r in (0, 1)}
        if not ways[0] and not ways[1]:
            ways = {2: [w for w in plain_windows(words, 2) if len(w[1]) == 5] if len(words) >= 5 else [(0, tuple(w[0] for w in words), [])] if words else []}
        for r, own in ways.items():
            size = len({t for _, t, _ in own})
            for i, text in docs:
                for way in [w for w in (0, 1, 2) if (r == 2) == (w == 2) and w <= r]:
                    there = plain_windows(reading(text), way)
                    met = [(k - a, t, x, y) for k, t, y in there for a, u, x in own if t == u]
                    n = len({t for _, t, _, _ in met})
                    if not size or n < decontam.SHARE * size:
                        continue
                    shifts = {s for s, _, _, _ in met}
                    fits = agree([(x, y) for _, _, x, y in met]) or any(
                        len({t for s, t, _, _ in met if s == shift}) >= decontam.SHARE * size and agree([(x, y) for s, _, x, y in met if s == shift]) for shift in shifts
                    )
                    if fits:
                        out[i, j] = max(out.get((i, j), 0), n / size)
    return {(i, j, round(c, 9)) for (i, j), c in out.items()}


def test_equals_a_plain_reading(spark):
    rng = random.Random(12)
    names, units, plain = ["Anna", "Bob", "Öre", "Zed"], ["km", "kg", "hours"], ["how", "many", "left", "the", "trains", "sold", "then", "apples", "Über", "so"]

    def sentence() -> str:
        words = [rng.choice(plain) for _ in range(rng.randint(1, 9))]
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice([rng.choice(names), str(rng.randint(1, 20)), f"{rng.randint(1, 9)} {rng.choice(units)}", f"{rng.randint(1, 9)}kg"]))
        return " ".join(words).replace("the", "The", 1) + rng.choice(["?", ".", "", ":"])

    items = [(j, " ".join(sentence() for _ in range(rng.randint(1, 3)))) for j in range(30)]
    docs = []
    for i in range(60):
        text = rng.choice(items)[1]
        for _ in range(rng.randint(0, 3)):  # other values, some of them at odds
            old = rng.choice([*names, *map(str, range(1, 21))])
            text = re.sub(rf"\b{old}\b", rng.choice([*names, *map(str, range(1, 21))]) if rng.random() < 0.5 else old, text, count=rng.randint(1, 3))
        text = rng.choice([str, str.upper, str.title, str.lower])(text) if rng.random() < 0.3 else text
        docs.append((i, rng.choice(["", sentence() + " ", sentence() + "\n"]) + text + rng.choice(["", " " + sentence(), "\n" + sentence()])))
    want = plain_leaks(docs, items)
    assert len(want) > 30
    for limit in (decontam.BROADCAST_WINDOWS, 0):
        rows = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_windows=limit).collect()
        assert {(r["id"], r["item_id"], round(r["coverage"], 9)) for r in rows} == want


def test_repeats_empties_and_strings_as_ids(spark):
    docs = spark.createDataFrame([("a", ITEM), ("a", ITEM), ("a", None), ("b", ""), (None, ITEM)], "doc_id string, text string")
    bench = spark.createDataFrame([("x", ITEM), ("x", ITEM), (None, ITEM), ("y", None), ("z", "")], "item_id string, text string")
    assert [(r["id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()] == [("a", "x")]
