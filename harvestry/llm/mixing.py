"""Soft-membership mixing of sources to target weights.

A naive Bayes classifier over hashed words, fitted on a bounded sample of a labelled table, gives each document a posterior
over domains. Nonnegative rates r_i are then fitted to min sum_d (T_d - t_d)^2 / S_d, with T_d = sum_i r_i tokens_i p_id the
expected tokens of domain d, t_d its target and S_d its tokens at rate one, by projected gradient steps from r_i = 1 in the
metric of the documents' tokens: r_i <- max(0, r_i - sum_d p_id (T_d - t_d) / S_d).

A rate depends on the document's posterior and on the residuals of the steps so far (a few numbers per step), so a step is
one distributed sum over a written table, nothing per document is kept between steps, and any executor can be lost.
The steps are contractions (their matrix has rows that sum to one), so step size 1 needs no search.

There may be any number of domains: posteriors are sparse (shares under LEAST_SHARE of a document are spread over its others), word counts are sparse, and a
worker holds the log probabilities of CHUNK domains at a time.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import clash_free, map_batches, remainder, sampled_texts, written
from harvestry.llm.kernel import blocks, tokens

log = logging.getLogger(__name__)

TRAINING_ROWS, BUCKETS, SHARPNESS = 8000, 1 << 14, 20.0
STEPS, TOLERANCE, CHUNK, LEAST_SHARE = 60, 1e-9, 64, 1e-7
POSTERIOR = "array<struct<domain:int,share:double>>"
_POSTERIOR = pa.list_(pa.struct([("domain", pa.int32()), ("share", pa.float64())]))


@dataclass
class DomainModel:
    """Counts of words by (domain, bucket), sorted by domain, and of texts by domain."""

    domains: list[str]
    domain: np.ndarray
    bucket: np.ndarray
    count: np.ndarray
    texts: np.ndarray
    _held: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_held": {}}

    def log_words(self, first: int) -> np.ndarray:
        """Log probabilities of the words' buckets in CHUNK domains from `first` on (BUCKETS x domains); the last chunk asked for is held."""
        if first not in self._held:
            self._held.clear()
            a, b = np.searchsorted(self.domain, [first, first + CHUNK])
            counts = np.full((BUCKETS, min(CHUNK, len(self.domains) - first)), 0.1)
            counts[self.bucket[a:b], self.domain[a:b] - first] += self.count[a:b]
            self._held[first] = np.log(counts / counts.sum(axis=0))
        return self._held[first]

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Words of each text, and its posterior: the mean log probability of a word counts as SHARPNESS words (fewer if the text has fewer)."""
        toks = [tokens(block) for block in blocks(column)]
        n = np.concatenate([np.diff(t.bounds) for t in toks]) if toks else np.zeros(0, dtype=np.int64)
        z = np.zeros((len(n), len(self.domains)))
        for first in range(0, len(self.domains), CHUNK):
            table, row = self.log_words(first), 0
            for t in toks:
                some = np.flatnonzero(np.diff(t.bounds) > 0)
                if len(some):
                    per = table[(t.hash % np.uint64(BUCKETS)).astype(np.int64)]
                    z[row + some, first : first + CHUNK] = np.add.reduceat(per, t.bounds[:-1][some], axis=0)
                row += len(t.bounds) - 1
        z = np.log(self.texts / self.texts.sum()) + z * (np.minimum(n, SHARPNESS) / np.maximum(n, 1))[:, None]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[p < np.minimum(LEAST_SHARE, p.max(axis=1, keepdims=True))] = 0
        p /= p.sum(axis=1, keepdims=True)
        return n, sparse(p)


def sparse(p: np.ndarray) -> pa.Array:
    """Rows of shares as lists of (domain, share), zeros left out."""
    row, domain = np.nonzero(p)
    offsets = np.searchsorted(row, np.arange(len(p) + 1)).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(domain.astype(np.int32)), pa.array(p[row, domain])], names=["domain", "share"])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def learn_domains(docs: DataFrame, labelled: DataFrame, limit: int = TRAINING_ROWS) -> DomainModel:
    """A model from at most `limit` rows of a labelled table (doc_id, domain); counts of (domain, bucket) in these rows are what reaches the driver.

    Null ids and domains are left out; of rows that repeat an id the first domain, and the least text, counts.
    """
    rows = labelled.select("doc_id", F.col("domain").cast("string").alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = sampled_texts(docs, rows).select("domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts, texts = np.array(batch.column(0).to_pylist(), dtype=object), {}, {}
            for block in blocks(batch.column(1)):
                tok = tokens(block)
                bucket, row = (tok.hash % np.uint64(BUCKETS)).astype(np.int64), tok.row + block.first
                for d in dict.fromkeys(names[block.first : block.first + block.rows]):
                    own = np.unique(bucket[names[row] == d], return_counts=True)
                    for b, c in zip(*own, strict=True):
                        counts[d, int(b)] = counts.get((d, int(b)), 0) + int(c)
                    texts[d] = texts.get(d, 0) + int((names[block.first : block.first + block.rows] == d).sum())
            found = [(d, b, c) for (d, b), c in counts.items()] + [(d, -1, c) for d, c in texts.items()]
            if found:
                d, b, c = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["domain", "bucket", "n"])

    found = map_batches(sample, run, "domain string, bucket long, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, bucket, n = np.array(found["domain"].to_pylist(), dtype=object), found["bucket"].to_numpy(), found["n"].to_numpy()
    domains = sorted(set(names))
    if not domains:
        e = np.zeros(0, dtype=np.int64)
        return DomainModel(["all"], e, e, e, np.ones(1))
    of = {d: k for k, d in enumerate(domains)}
    domain = np.array([of[d] for d in names], dtype=np.int64)
    texts = np.ones(len(domains))
    texts[domain[bucket < 0]] += n[bucket < 0]
    order = np.lexsort((bucket, domain))
    order = order[bucket[order] >= 0]
    return DomainModel(domains, domain[order], bucket[order], n[order], texts)


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def with_posteriors(df: DataFrame, model: DomainModel, text: str = "text", out: tuple[str, str] = ("tokens", "posterior")) -> DataFrame:
    """df with its words (long) and its posterior (pairs of a domain's place in model.domains and its share); columns with these names are replaced.

    Null and empty texts have the prior and no words. Texts are read whole.
    """
    base = df.drop(*out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = model.posteriors(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n.astype(np.int64)), p.cast(_POSTERIOR)], names=[*batch.schema.names, *out])

    return map_batches(base, run, _schema(base, f"`{out[0]}` long", f"`{out[1]}` {POSTERIOR}"))


def rates(posterior: pa.Array, residuals: list[np.ndarray]) -> np.ndarray:
    """The rate of each posterior after the projected steps with these residuals (one number for each domain and step)."""
    size = posterior.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, first = posterior.flatten(), np.concatenate([[0], np.cumsum(size)])
    domain, share = flat.field("domain").to_numpy(zero_copy_only=False), flat.field("share").to_numpy(zero_copy_only=False)
    rate = np.ones(len(size))
    for e in residuals:
        total = np.concatenate([[0.0], np.cumsum(share * e[domain])])
        rate = np.maximum(0, rate - (total[first[1:]] - total[first[:-1]]))
    return rate


def _totals(table: DataFrame, domains: int, residuals: list[np.ndarray], tokens_of: str, posterior: str) -> np.ndarray:
    """Expected tokens of each domain at the rates after these residuals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(domains)
        for batch in batches:
            p = batch.column(1)
            size, flat = p.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), p.flatten()
            weight = np.repeat(batch.column(0).to_numpy() * rates(p, residuals), size) * flat.field("share").to_numpy(zero_copy_only=False)
            out += np.bincount(flat.field("domain").to_numpy(zero_copy_only=False), weights=weight, minlength=domains)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(out[some])], names=["domain", "total"])

    found = map_batches(table.select(tokens_of, posterior), run, "domain int, total double").groupBy("domain").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(domains)
    for r in found:
        out[r["domain"]] = r["total"]
    return out


@dataclass
class Fit:
    """Residuals of the steps, and each domain's gap: its share of the expected tokens less its target's, at the last step's rates."""

    residuals: list[np.ndarray]
    gap: dict[str, float]


def fit_rates(table: DataFrame, domains: list[str], targets: dict[str, float], steps: int = STEPS, tolerance: float = TOLERANCE, columns: tuple[str, str] = ("tokens", "posterior")) -> Fit:
    """Steps over a written table (tokens, posterior). Targets are weights of the domains; the tokens in all stay as they are.

    A domain without a target gets none; one without tokens can't be met and is left out of the others' shares. Without any target that can be met, rates are one.
    """
    sizes = _totals(table, len(domains), [], *columns)
    weight = np.array([max(0.0, targets.get(d, 0.0)) for d in domains]) * (sizes > 0)
    if not weight.sum():
        return Fit([], {})
    goal, now = weight / weight.sum() * sizes.sum(), sizes
    residuals: list[np.ndarray] = []
    while True:
        gap = np.where(sizes > 0, (now - goal) / np.maximum(sizes, 1e-300), 0.0)
        if np.abs(gap).max() <= tolerance or len(residuals) == steps:
            return Fit(residuals, {d: float(g) for d, g in zip(domains, (now - goal) / sizes.sum(), strict=True)})
        residuals.append(np.array([float(f"{g:.12g}") for g in gap]))
        now = _totals(table, len(domains), residuals, *columns)


@dataclass
class Mix:
    """Rows with a rate, the domains by place, and the gap of each (see Fit)."""

    rows: DataFrame
    domains: list[str]
    gap: dict[str, float]


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, out: str = "rate", keep_posterior: bool = False, keep_text: bool = True) -> Mix:
    """docs with a rate each. Targets default to equal weights of the labelled domains.

    A rate is how often a document is to be read on average. No row is dropped, sampled or repeated here. Words and posteriors are written once, and the steps read only these.
    Without keep_text so do the rows that come out; with it their texts are classified once more as they are read, so that the corpus needs no second copy on disk. Null and empty texts have no tokens; their rate follows from the prior. Null ids and repeated rows
    are rows like others. A column named `out` is replaced; with keep_posterior so are `tokens` and `posterior`, otherwise such columns stay. An empty table gives an empty one.
    The gap tells how far the targets are met; a warning is logged for a gap over a thousandth of all tokens, as when a domain's documents are too mixed to reach its target.
    """
    model = learn_domains(docs, labelled)
    base = docs.drop(out)
    n, p = ("tokens", "posterior") if keep_posterior else (clash_free(base.schema, "tokens"), clash_free(base.schema, "posterior"))
    own = with_posteriors(base, model, out=(n, p))
    table = written(own.select(n, p) if keep_text else own.drop("text"), "posteriors", sparse=True)
    own = own if keep_text else table
    fit = fit_rates(table, model.domains, targets or dict.fromkeys(model.domains, 1.0), columns=(n, p))
    short = {d: g for d, g in fit.gap.items() if abs(g) > 1e-3}
    if short:
        log.warning("targets missed by shares of all tokens: %s", short)
    residuals = fit.residuals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = np.round(rates(batch.column(batch.schema.get_field_index(p)), residuals), 9)
            rest = [k for k, name in enumerate(batch.schema.names) if keep_posterior or name not in (n, p)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), pa.array(rate)], names=[*(batch.schema.names[k] for k in rest), out])

    return Mix(map_batches(own, run, _schema(own if keep_posterior else own.drop(n, p), f"`{out}` double")), model.domains, fit.gap)


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of those documents that the labels table covers and that aren't held out."""
    ids = labels.select("doc_id").where(remainder(F.col("doc_id")) != 2).distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(ids, "doc_id", "left_semi")


def mixing_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens, rate and posterior (name=share for each domain that has one, by name, comma-joined), for each row of documents; equal weights of the languages."""
    mix = mixed(docs.select("doc_id", "text"), labelled_languages(docs, labels), keep_posterior=True, keep_text=False)
    names = F.array(*(F.lit(d) for d in mix.domains))
    shares = F.array_join(F.transform("posterior", lambda x: F.concat(F.element_at(names, x["domain"] + 1), F.lit("="), F.round(x["share"], 6).cast("string"))), ",")
    return mix.rows.select("doc_id", "tokens", "rate", shares.alias("posterior"))
