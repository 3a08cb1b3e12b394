from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from harvestry.llm import mixing
from harvestry.llm.common import sampled_texts, training_labels
from harvestry.llm.kernel import blocks, tokens

WORDS = {"a": "the of and to in", "b": "der die und das ist", "c": "le la et un les"}


def tables(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(240):
        d = "aaaabbc"[i % 7]
        rows.append((i, " ".join(rng.choice(WORDS[d].split(), 20 + i % 30)), d))
        if i % 2:
            labels.append((i, 1, 0))
    rows += [(900, None, "a"), (901, "", "b"), (None, "the of", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def dense(posterior, k: int) -> list[float]:
    out = [0.0] * k
    for x in posterior:
        out[x["domain"]] = x["share"]
    return out


@pytest.mark.parametrize("chunk", [2, 64])
def test_posteriors_equal_plain_naive_bayes(spark, chunk, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    docs, labels = tables(spark)
    labelled = mixing.labelled_languages(docs, labels)
    model = mixing.learn_domains(docs, labelled)
    texts, of = {r["doc_id"]: r["text"] or "" for r in docs.collect()}, {r["doc_id"]: r["domain"] for r in labelled.collect()}
    bucket = lambda w: int(tokens(next(blocks(pa.array([w])))).hash[0] % np.uint64(mixing.BUCKETS))
    known = {w: bucket(w) for t in texts.values() for w in t.split()}
    counts, prior = {d: np.full(mixing.BUCKETS, 0.1) for d in "abc"}, dict.fromkeys("abc", 1)
    for i, d in of.items():
        prior[d] += 1
        for w in texts[i].split():
            counts[d][known[w]] += 1
    asked = [texts[i] for i in list(texts)[:40]] + ["", "the der la"]
    n, got = model.posteriors(pa.array(asked))
    for text, words, p in zip(asked, n, got.to_pylist(), strict=True):
        own = text.split()
        z = [math.log(prior[d] / sum(prior.values())) + sum(math.log(counts[d][known[w]] / counts[d].sum()) for w in own) * (min(len(own), mixing.SHARPNESS) / max(len(own), 1)) for d in "abc"]
        q = np.exp(np.array(z) - max(z))
        assert words == len(own) and np.allclose(dense(p, 3), q / q.sum(), atol=1e-6)


def test_any_number_of_domains(spark):
    rows = [(i, f"word{i % 200} again{i % 200} more{i % 200} " * 8, f"d{i % 200:03d}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    mix = mixing.mixed(docs, mixing.labelled_languages(docs, labels), keep_posterior=True)
    assert len(mix.domains) == 200 and max(map(abs, mix.gap.values())) < 1e-4
    assert all(max(r["posterior"], key=lambda x: x["share"])["domain"] == r["doc_id"] % 200 for r in mix.rows.collect())


def test_a_target_that_cannot_be_met_is_told(spark):
    docs = spark.createDataFrame([(i, "same words here", "ab"[i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    mix = mixing.mixed(docs, mixing.labelled_languages(docs, labels), {"a": 0.9, "b": 0.1})
    assert mix.rows.count() == 40 and max(map(abs, mix.gap.values())) > 0.1


@pytest.mark.parametrize("targets", [None, {"a": 0.2, "b": 0.3, "c": 0.5}])
def test_expected_totals_meet_targets(spark, targets):
    docs, labels = tables(spark)
    mix = mixing.mixed(docs, mixing.labelled_languages(docs, labels), targets, keep_posterior=True)
    rows, domains = mix.rows.collect(), mix.domains
    assert len(rows) == docs.count() and domains == ["a", "b", "c"] and max(map(abs, mix.gap.values())) < 1e-5
    p, n, r = np.array([dense(x["posterior"], 3) for x in rows]), *(np.array([x[c] for x in rows], dtype=float) for c in ("tokens", "rate"))
    got = (p * (n * r)[:, None]).sum(axis=0)
    weights = np.array([1, 1, 1]) / 3 if targets is None else np.array([0.2, 0.3, 0.5])
    assert np.allclose(got / n.sum(), weights, atol=1e-5) and (r >= 0).all()
    assert np.allclose(p.sum(axis=1), 1)
    assert all(q[domains.index(x["lang"])] > 0.9 for x, q in zip(rows, p, strict=True) if x["tokens"] > 10)


def test_rates_equal_a_dense_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.5] * 3, 200)
    n = rng.integers(0, 500, 200)
    goal = np.array([0.7, 0.3, 0.0])
    table = spark.createDataFrame([(int(a), [(k, float(x)) for k, x in enumerate(b)]) for a, b in zip(n, p, strict=True)], f"tokens long, posterior {mixing.POSTERIOR}")
    fit = mixing.fit_rates(table, ["x", "y", "z"], {"x": 0.7, "y": 0.3}, steps=25, tolerance=0)
    got = mixing.rates(mixing.sparse(p), fit.residuals)
    sizes = (p * n[:, None]).sum(axis=0)
    rate = np.ones(200)
    for _ in range(25):
        now = (p * (n * rate)[:, None]).sum(axis=0)
        rate = np.maximum(0, rate - p @ ((now - goal * sizes.sum()) / sizes))
    assert len(fit.residuals) == 25 and np.allclose(np.sort(got), np.sort(rate), atol=1e-8) and (got == 0).any()


def test_no_labels_and_empty_tables(spark):
    docs, labels = tables(spark)
    rows = mixing.mixing_report(docs, labels.limit(0)).collect()
    assert len(rows) == docs.count() and {r["rate"] for r in rows} == {1.0}
    assert mixing.mixing_report(docs.limit(0), labels).collect() == []


def test_clashing_columns_stay(spark):
    docs, labels = tables(spark)
    more = docs.selectExpr("*", "'k' AS tokens", "'q' AS posterior")
    rated = mixing.mixed(more, mixing.labelled_languages(more, labels)).rows
    assert rated.columns == [*more.columns, "rate"] and rated.first()["tokens"] == "k"
    again = mixing.mixed(rated, mixing.labelled_languages(rated, labels)).rows
    assert again.columns == rated.columns


def test_repeated_ids_and_rows_stay_within_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {k}", "a") for k in range(3000)] + [(2, "other", "b")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    rows = sampled_texts(docs, training_labels(labels, "quality", 1000))
    assert {(r["doc_id"], r["text"]) for r in rows.collect()} == {(1, "text 0"), (2, "other")}
    assert mixing.mixing_report(docs, labels).count() == 3001
