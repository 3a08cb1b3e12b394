from __future__ import annotations

import random

import pytest

import corpus_pipeline
from harvestry.llm import queries
from tests.llm.test_neardup import words_of

BENCH = "Which of these seven planets has the largest number of known moons according to the most recent survey of the sky"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents with one case of each stage, beside clean ones."""
    rng = random.Random(8)
    out = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, " ".join(words_of(rng, 60)), ("en", "de")[i % 2], f"src{i % 3}", 0) for i in range(200)]
    insult = [(i, text + " you idiot, stupid moron idiot", lang, src, 0) if i % 10 == 0 else (i, text, lang, src, 0) for i, text, lang, src, _ in rows]
    insult += [(300, insult[1][1], "de", "src0", 0), (301, insult[1][1] + " end", "de", "src0", 0), (302, "Before it. " + BENCH, "en", "src1", 0)]
    insult += [(303, " ".join(words_of(rng, 40)) + " write to a.b@c.org", "en", "src1", 0), (304, None, "en", None, None), (305, "", None, "src2", 0)]
    spark.createDataFrame(insult, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_take_effect(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert name == "mixing" or docs.columns == columns
        kept.append(before - {r["doc_id"] for r in docs.collect()})
    assert kept == [set(range(0, 200, 10)), {300, 301}, {302}, set(), set()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "a.b@c.org" not in texts[303] and "@" in texts[303] and texts[304] is None
    assert docs.columns == [*columns, "rate"]


def test_run_is_the_stages_in_order(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == ({i for i in range(200) if i % 10} | {303, 304, 305})


def test_queries_are_named_by_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Columns named as those that operators make, nulls in every column, repeated rows and ids, ties, a very long text and a very long word."""
    rng = random.Random(3)
    out = str(tmp_path_factory.mktemp("odd"))
    prose = [" ".join(words_of(rng, 50)) for _ in range(40)]
    rows = [(i, t, ("en", "de")[i % 2], "s", 9, "x", "y", "z", 0.5, 7) for i, t in enumerate(prose)]
    rows += [rows[3], rows[3], (3, prose[4] + " x", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (None, prose[5], "en", "s", 1, "x", "y", "z", 0.5, 7)]
    rows += [(100, " ".join(words_of(rng, 60_000)), "de", "s", 2, "x", "y", "z", 0.5, 7), (101, "w" * 2_000_000, "de", "s", 2, "x", "y", "z", 0.5, 7), (102, "", "en", "s", 0, "x", "y", "z", 0.5, 7), (103, " \n ", "en", "s", 3, "x", "y", "z", 0.5, 7)]
    rows += [(104, "write to a.b@c.org. " + prose[0][:20], "en", "s", 3, "x", "y", "z", 0.5, 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, leaked string, hits string, rate double, tokens long"
    spark.createDataFrame(rows, schema).write.parquet(f"{out}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (3, None, None), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, BENCH), (None, BENCH), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_odd_rows_and_clashing_columns_go_through(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, odd_dir), name)
        assert sorted(docs.columns) == sorted(columns) and (name == "mixing" or docs.columns == columns)
        if name != "mixing":
            assert docs.where("toxicity <> 'x' OR leaked <> 'y' OR hits <> 'z' OR rate <> 0.5 OR tokens <> 7").count() == 0
    rows = docs.collect()
    ids = [r["doc_id"] for r in rows]
    # 3 and 4 are one component through the row that repeats 3 with 4's text; the rows of 3 stay together
    assert ids.count(3) == 4
    assert 4 not in ids and len(rows) == before - 1
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert len(texts[101]) == 2_000_000 and texts[102] == "" and texts[103] == " \n " and "a.b@c.org" not in texts[104]
    assert sum(r["doc_id"] is None for r in rows) == 2 and any(r["text"] is None for r in rows)


def test_empty_tables_go_through(spark, odd_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    spark.read.parquet(f"{odd_dir}/documents.parquet").write.parquet(f"{tmp_path}/two/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/two/{name}.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/two").collect()
    assert len(rows) > 40 and {r["rate"] for r in rows} == {1.0}


def test_stages_equal_brute_force(spark, sf_dir):
    """Each stage on its own input against the plain readings of its operator's tests."""
    from tests.llm.test_decontam import plain_leaks
    from tests.llm.test_neardup import brute
    from tests.llm.test_toxicity import plain_hits
    from harvestry.llm import toxicity

    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.learn(docs, labels)
    model.hits = lambda text: plain_hits(model, text)
    want = {i for i, t in texts.items() if model.score([t])[0] < toxicity.THRESHOLD}
    after = corpus_pipeline.written(corpus_pipeline.drop_toxic(spark, docs, sf_dir), "t")
    assert {r["doc_id"] for r in after.collect()} == want
    found = brute([(i, texts[i]) for i in want], 5, 80)
    kept = corpus_pipeline.written(corpus_pipeline.drop_near_duplicates(spark, after, sf_dir), "t")
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in found.items() if i == c}
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    bad = {i for i, _, _ in plain_leaks([(i, t) for i, t in left.items() if t is not None], [(1, BENCH)])}
    clean = corpus_pipeline.drop_benchmark(spark, kept, sf_dir)
    assert bad and {r["doc_id"] for r in clean.collect()} == set(left) - bad
