from __future__ import annotations

import re

import pytest

from harvestry.llm import pii

SCHEMA = "doc_id long, text string"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def out_of(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["doc_id"]: r for r in pii.pseudonymise(df, count="n", **more).collect()}


def test_formats_types_and_coreference(spark):
    rows = [
        (1, "Call +1 (407) 555-7710 or write Jane.Doe7@mail.example.com from 10.20.30.40, not 8.8.4.4."),
        (2, "jane.doe7@mail.example.com and +1 407 555 7710; card 4539 1488 0343 6467 or 4539148803436467, 123-45-6789"),
        (3, "4785380592391139"),
        (5, "+33 1 23 45 67 89, (407) 555-7710 or 407-555-7710"),
        (4, "nothing here, 24be64439e3e49cf46b2d7c90f3602a3 and 12345"),
    ]
    got = out_of(spark, rows)
    assert [got[k]["n"] for k in (1, 2, 3, 4, 5)] == [4, 5, 1, 0, 3]
    assert got[4]["text"] == rows[4][1]
    five = re.fullmatch(r"(\+3\d \d \d\d \d\d \d\d \d\d), (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", got[5]["text"])
    assert re.sub(r"\D", "", five[2]) == re.sub(r"\D", "", five[3]) != "4075557710"
    one = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or write ([A-Z][a-z]{3}\.[A-Z][a-z]{2}\d@[a-z]{4}\.[a-z]{7}\.com) from (10\.\d+\.\d+\.\d+), not ((?:\d+\.){3}\d+)\.", got[1]["text"])
    two = re.fullmatch(r"(\S+@\S+) and (\+1 \d{3} \d{3} \d{4}); card (4\d{3} \d{4} \d{4} \d{4}) or (4\d{15}), (\d{3}-\d{2}-\d{4})", got[2]["text"])
    assert one and two
    digits = lambda s: re.sub(r"\D", "", s)
    assert one[2].lower() == two[1] and digits(one[1]) == digits(two[2]) and digits(two[3]) == two[4]
    assert one[4] != "8.8.4.4" and two[1] != "jane.doe7@mail.example.com" and two[4] != "4539148803436467"
    assert luhn("4539148803436467") and luhn(two[4])
    assert luhn(got[3]["text"]) == luhn("4785380592391139")
    assert all(0 <= int(o) <= 255 for o in (one[3] + "." + one[4]).split("."))


def test_names_keep_gender_script_and_parts(spark):
    rows = [(1, "Mary Smith met James Smith and Mr. Smith."), (2, "Анна Иванова, Сергей Иванова"), (3, "Frau Weber"), (4, "Μαρία Παπαδοπούλου")]
    got = out_of(spark, rows)
    one = re.fullmatch(r"(\w+) (\w+) met (\w+) (\w+) and Mr\. (\w+)\.", got[1]["text"])
    assert one[2] == one[4] == one[5] != "Smith"
    assert one[1].endswith("a") and not one[3].endswith("a")
    two = re.fullmatch(r"(\w+) (\w+), (\w+) (\w+)", got[2]["text"])
    assert two[2] == two[4] and re.fullmatch(r"[Ѐ-ӿ]+", "".join(two.groups())) and two[1].endswith("а")
    assert re.fullmatch(r"Frau [A-Z][a-z]+", got[3]["text"]) and got[3]["text"] != "Frau Weber"
    assert re.fullmatch(r"[Ͱ-Ͽἀ-῾]+ [Ͱ-Ͽἀ-῾]+", got[4]["text"])


def test_same_key_same_surrogates_other_key_others(spark):
    rows = [(1, "a.b@c.org 81.2.3.4")]
    first, again, other = (out_of(spark, rows, key=k)[1]["text"] for k in ("x", "x", "y"))
    assert first == again != other


def test_surrogates_are_distinct_and_no_entity(spark, monkeypatch):
    names = [f"{a}.{b}.{c}.9" for a in range(11, 31) for b in range(1, 11) for c in range(1, 4)]
    entities = spark.createDataFrame([("ip", n) for n in names], "kind string, name string")
    few = lambda name, s: pii.F.concat(pii.F.lit("11.1."), (1 + pii.F.pmod(pii._number(s, pii.F.lit(1)), pii.F.lit(40))).cast("string"), pii.F.lit("."), (1 + pii.F.pmod(pii._number(s, pii.F.lit(2)), pii.F.lit(200))).cast("string"))
    monkeypatch.setattr(pii, "_ip", few)
    got = [(r["name"], r["surrogate"]) for r in pii.assign(entities).collect()]
    assert len(got) == len(names) and len({s for _, s in got}) == len(names)
    assert not {s for _, s in got} & set(names)


def test_nulls_empties_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x@y.org", "c"), (3, "x@y.org", "d"), (3, "x@y.org", "d"), (4, "x@y.org " * 3000, "e")], "doc_id long, text string, swap string")
    out = pii.pseudonymise(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert len(rows) == 6
    texts = {r["swap"]: r["text"] for r in rows}
    assert texts["a"] is None and texts["b"] == "" and texts["c"] == texts["d"] != "x@y.org"
    assert texts["e"] == (texts["c"] + " ") * 3000
    assert pii.surrogate_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_main_path_has_no_python(spark):
    plan = pii.surrogate_report(spark.createDataFrame([(1, "x@y.org")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("text", ["1.2.3.4.5", "a@b", "+12", "+12 5 6", "4785-3805", "300.1.1.1", "x1234567890123456y", "1234567890123456789"])
def test_what_is_no_entity_stays(spark, text):
    assert out_of(spark, [(1, text)])[1]["text"] == text


def test_names_of_many_forms_go(spark):
    names = ["Emma Watson", "Priya Sharma", "Wei Zhang", "MARY SMITH", "Mary O'Neil", "Mary Ann Johnson", "Dr John Paul Lopez", "John Q. Smith", "Ludwig van Beethoven", "Mr Պետրոսյան", "Արմեն Պետրոսյան", "Ana María de la Cruz"]
    texts = [f"we met {n}, they said" for n in names]
    texts[8] = "my name is Ludwig van Beethoven, they said"
    got = out_of(spark, list(enumerate(texts)))
    for k, name in enumerate(names):
        assert got[k]["n"] == 1, name
        left = got[k]["text"]
        assert not [w for w in re.findall(r"[^\W\d_]{2,}", name) if w not in ("Mr", "Dr", "van", "de", "la", "Neil") and re.search(rf"\b{w}\b", left)], (name, left)
    assert re.search(r"[A-Z]{4,} [A-Z]{4,}", got[3]["text"])
    assert re.search(r"Mr [Ա-Ֆ][ա-և]+,", got[9]["text"]) and re.search(r"[Ա-Ֆ][ա-և]+ [Ա-Ֆ][ա-և]+,", got[10]["text"])
    assert re.search(r" Q\. ", got[7]["text"]) and " van " in got[8]["text"]


def test_a_surname_alone_follows_its_bearer(spark):
    got = out_of(spark, [(1, "Mary Smith came. Smith went, and so did SMITH, Smithson and Blacksmith."), (2, "Smith is a word here.")])
    one = re.fullmatch(r"(\w+) (\w+) came\. (\w+) went, and so did SMITH, Smithson and Blacksmith\.", got[1]["text"])
    assert one and one[2] == one[3] != "Smith" and got[1]["n"] == 1
    assert got[2]["text"] == "Smith is a word here."


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_numbers_of_many_forms(spark):
    rows = [(1, "DE89 3704 0044 0532 0130 00 and DE89370400440532013000"), (2, "fe80::1ff:fe23:4567:890a or 2001:0db8:85a3:0000:0000:8a2e:0370:7334"), (3, "030 1234567"), (4, "3782 822463 10005"), (5, "at 12:34:56, a::b, 3:2")]
    got = out_of(spark, rows)
    one = re.fullmatch(r"(DE\d\d(?: \d{4}){4} \d\d) and (DE\d{20})", got[1]["text"])
    assert one and one[1].replace(" ", "") == one[2] != "DE89370400440532013000" and mod97(one[2]) == 1
    two = re.fullmatch(r"(fe80::[0-9a-f]{3}:[0-9a-f]{4}:[0-9a-f]{4}:[0-9a-f]{4}) or (2001(?::[0-9a-f]{4}){7})", got[2]["text"])
    assert two and two[1] != "fe80::1ff:fe23:4567:890a"
    assert re.fullmatch(r"0\d\d \d{7}", got[3]["text"]) and got[3]["text"] != rows[2][1]
    assert re.fullmatch(r"3\d{3} \d{6} \d{5}", got[4]["text"]) and luhn(re.sub(" ", "", got[4]["text"])) and got[4]["text"] != rows[3][1]
    assert got[5]["text"].startswith("at 12:34:56, ") and got[5]["text"].endswith(", 3:2")


def test_domains_stay_apart(spark):
    rows = [(i, f"someone@{c}.com and other@{c}.com") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    texts = [r["text"] for r in out_of(spark, rows).values()]
    domains = [set(re.findall(r"@(\S+)", t)) for t in texts]
    assert all(len(d) == 1 for d in domains) and len(set().union(*domains)) == 26
    assert not set().union(*domains) & {f"{c}.com" for c in "abcdefghijklmnopqrstuvwxyz"}


def test_a_full_range_swaps_its_values(spark):
    names = [f"192.168.{a}.{b}" for a in range(1, 181) for b in range(1, 251)]  # 45,000 of the range's 64,516
    entities = spark.createDataFrame([("ip", n) for n in names] + [("ip", "10.1.1.1")], "kind string, name string")
    got = {r["name"]: r["surrogate"] for r in pii.assign(entities).collect()}
    assert set(got) == {*names, "10.1.1.1"} and len(set(got.values())) == len(got)
    assert all(s != n and s.rsplit(".", 2)[0] == n.rsplit(".", 2)[0] or n == "10.1.1.1" for n, s in got.items())


def test_patterns_share_their_beginnings():
    words = ["Ana", "Anna", "An", "Bo", "Bob", "C"]
    assert all(re.fullmatch(pii.one_of(words), w) for w in words) and not re.fullmatch(pii.one_of(words), "Ann")
    assert pii.one_of(["ab"]) == "ab" and pii.one_of(["a", "ab"]) == "a(?:b)?"


def test_equals_a_plain_reading(spark):
    """Mentions are found by another engine, text by text; each must have become a like one, one entity one surrogate, and nothing else may change."""
    import random

    import regex

    rng = random.Random(4)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    people = ["Mary Smith", "James Weber", "Dr. Weber", "Frau Lopez", "ANNA WEBER", "Ольга Иванова", "Νίκος Παππάς", "Priya Sharma"]
    pool = (
        [f"{rng.choice('abcx')}{k}.{rng.choice('yz')}@{rng.choice(['a.org', 'mail.b.com', 'C.net'])}" for k in range(20)] + [f"+1 ({digits(3)}) 555-{digits(4)}" for _ in range(10)] + [f"10.{k}.3.4" for k in range(10)]
        + [f"8.8.{k}.1" for k in range(5)] + [f"4{digits(3)} {digits(4)} {digits(4)} {digits(4)}" for _ in range(10)] + [f"{digits(3)}-{digits(2)}-{digits(4)}" for _ in range(5)] + people
    )
    plain = ["the", "word", "Again", "and 12", "x1", "24be64439e3e49cf", "Über", "no. 5", "(so)", "end."]
    rows = [(i, " | ".join(rng.choice(pool if rng.random() < 0.3 else plain) + rng.choice(["", ",", ""]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    pattern = regex.compile(pii.PATTERN)
    got = out_of(spark, rows)
    entity: dict[str, str] = {}
    for i, text in rows:
        mentions = [m.span() for m in pattern.finditer(text)]
        assert got[i]["n"] == len(mentions)
        before, after = text.split(" | "), got[i]["text"].split(" | ")
        assert len(before) == len(after)
        for old, new in zip(before, after, strict=True):
            assert old.endswith(",") == new.endswith(",")
            old, new = old.rstrip(","), new.rstrip(",")
            if not pattern.fullmatch(old):
                assert old == new
                continue
            assert entity.setdefault(old, new) == new != old
            if "@" in old:
                assert "@" in new and old.rsplit(".", 1)[1].lower() == new.rsplit(".", 1)[1].lower()
            elif old[0].isdigit() or old[0] in "+(":
                assert re.sub(r"\d", "9", old) == re.sub(r"\d", "9", new) or old.count(".") == 3
                if old.count(".") == 3:
                    assert all(0 <= int(o) <= 255 for o in new.split(".")) and old.startswith("10.") == new.startswith("10.")
                elif len(re.sub(r"\D", "", old)) == 16:
                    assert luhn(re.sub(r"\D", "", old)) == luhn(re.sub(r"\D", "", new)) and old[0] == new[0]
    canonical = lambda m: m.lower() if "@" in m else m
    assert len({canonical(m) for m in entity}) == len({canonical(n) for n in entity.values()})
    assert not {canonical(m) for m in entity} & {canonical(n) for n in entity.values()}
    words = {}
    for old, new in entity.items():
        if old[0].isalpha() and "@" not in old:
            for x, y in zip(old.lower().split(), new.lower().split(), strict=True):
                assert words.setdefault(x, y) == y
