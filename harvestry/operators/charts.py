"""The data behind each chart, as DataFrames."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import band, coverage_score, diversity_score, progress_bar, recommendations
from harvestry.operators.evaluate import histogram, nearest_distance, pair_distances, selected_vectors, vectors
from harvestry.operators.knn import distances
from harvestry.operators.rank import global_rank, quantiles
from harvestry.operators.reduce import CentredPCA
from harvestry.operators.select import random_selection
from harvestry.workdir import written

log = logging.getLogger(__name__)


#: Rows of the plane that t-SNE lays out: all pairs of them are one task's.
TSNE_ROWS = 2_000


def tsne(m: np.ndarray, perplexity: float = 30.0, steps: int = 500, seed: int = 42) -> np.ndarray:
    """Exact t-SNE of rows on a plane: Gaussian affinities whose entropy fits the perplexity, Student affinities in the plane, gradient steps with momentum."""
    n = len(m)
    if n < 3:
        return np.column_stack([np.arange(n, dtype=float), np.zeros(n)])
    d, goal = distances(m, m, "l2"), np.log(min(perplexity, (n - 1) / 3))
    np.fill_diagonal(d, np.inf)
    d -= d.min(axis=1, keepdims=True)
    lo, hi, beta = np.zeros((n, 1)), np.full((n, 1), np.inf), np.ones((n, 1))
    for _ in range(60):
        w = np.exp(-d * beta)
        p = w / w.sum(axis=1, keepdims=True)
        entropy = -(p * np.log(np.maximum(p, 1e-300))).sum(axis=1, keepdims=True)
        lo, hi = np.where(entropy > goal, beta, lo), np.where(entropy > goal, hi, beta)
        beta = np.where(np.isinf(hi), beta * 2, (lo + hi) / 2)
    p = np.maximum((p + p.T) / (2 * n), 1e-12)
    y, speed, gain = np.random.default_rng(seed).normal(0, 1e-4, (n, 2)), np.zeros((n, 2)), np.ones((n, 2))
    for step in range(steps):
        q = 1 / (1 + distances(y, y, "l2"))
        np.fill_diagonal(q, 0)
        pull = (p * (12 if step < 100 else 1) - q / q.sum()) * q
        slope = 4 * (pull.sum(axis=1, keepdims=True) * y - pull @ y)
        gain = np.maximum(np.where(np.sign(slope) != np.sign(speed), gain + 0.2, gain * 0.8), 0.01)
        speed = (0.5 if step < 250 else 0.8) * speed - max(n / 48, 50) * gain * slope
        y = y + speed
        y -= y.mean(axis=0)
    return y


def projection(df: DataFrame, selection: DataFrame, method: str = "pca", most: int = 10_000, seed: int = 42, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(id, x, y, selected) of the selection and a seeded sample of up to `most` rows, by the first two components (pca) or by t-SNE (tsne).

    t-SNE lays out TSNE_ROWS rows at most, selected ones first, drawn by the seed. umap needs a library that isn't there: NotImplementedError.
    """
    if method not in ("pca", "tsne"):
        raise NotImplementedError(f"projection {method!r} needs a library that isn't there; use 'pca' or 'tsne'")
    vecs = vectors(df, False, key, vector)
    mark = selection.select("id", F.lit(True).alias("selected")).distinct()
    if method == "tsne":
        chosen = random_selection(vecs.join(mark, "id", "left_semi"), TSNE_ROWS, seed).select("id")
        rest = random_selection(vecs.join(mark, "id", "left_anti"), min(most, TSNE_ROWS), seed).select("id", (F.col("rank") + chosen.count()).alias("rank")).where(F.col("rank") <= TSNE_ROWS)
        part = vecs.join(chosen.union(rest.select("id")), "id", "left_semi")

        def lay(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id", kind="stable")
            y = tsne(np.stack(pdf["embedding"].to_numpy()).astype(float), seed=seed)
            return pd.DataFrame({"id": pdf["id"].to_numpy(), "x": y[:, 0], "y": y[:, 1]})

        flat = part.withColumn("g", F.lit("all")).groupBy("g").applyInPandas(lay, "id long, x double, y double")
    else:
        shown = random_selection(vecs, most, seed).select("id").union(selection.select("id")).distinct()
        part = vecs.join(shown, "id", "left_semi")
        flat = CentredPCA.fit(part, 2).transform(part).select("id", F.col("reduced")[0].alias("x"), F.col("reduced")[1].alias("y"))
    return flat.join(mark, "id", "left").select("id", "x", "y", F.coalesce("selected", F.lit(False)).alias("selected"))


def cdf(distances: DataFrame, column: str = "distance", key: str = "id") -> DataFrame:
    """(id, distance, share): rank over count; ties get ranks of their own, by id."""
    ranked = global_rank(distances, column, key)
    return ranked.crossJoin(F.broadcast(distances.agg(F.count("*").alias("total")))).select(key, column, (F.col("rank") / F.col("total")).alias("share"))


def box_plot(distances: DataFrame, column: str = "distance") -> DataFrame:
    """One row: quartiles, whiskers (the outermost values within 1.5 interquartile ranges) and the count beyond them."""
    box = quantiles(distances, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    d, iqr = F.col(column), F.col("q3") - F.col("q1")
    inside = (d >= F.col("q1") - 1.5 * iqr) & (d <= F.col("q3") + 1.5 * iqr)
    return distances.crossJoin(F.broadcast(box)).groupBy("q1", "median", "q3").agg(F.min(F.when(inside, d)).alias("whisker_low"), F.max(F.when(inside, d)).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def coverage_distribution(df: DataFrame, selection: DataFrame, normalize: bool = False, key: str = "id", vector: str = "embedding") -> dict[str, DataFrame]:
    """histogram (50 bins), cdf, box, and summary with minimum and 99th percentile, of distances of vectors as they are."""
    vecs = vectors(df, normalize, key, vector)
    near = written(nearest_distance(vecs, selected_vectors(vecs, selection)), "near")
    moments = near.agg(F.min("distance").alias("min"), F.avg("distance").alias("mean"), F.max("distance").alias("max"))
    summary = moments.crossJoin(quantiles(near, "distance", {"median": 0.5, "p99": 0.99}))
    return {"histogram": histogram(near, bins=50), "cdf": cdf(near), "box": box_plot(near), "summary": summary}


def diversity_matrix(df: DataFrame, selection: DataFrame, most: int = 500, normalize: bool = False, seed: int = 42, key: str = "id", vector: str = "embedding") -> dict[str, DataFrame]:
    """matrix (i, j, distance) of up to `most` selected rows, histogram (50 bins) of its upper triangle, and its mean and median."""
    chosen = selected_vectors(vectors(df, normalize, key, vector), random_selection(selection, most, seed))
    pairs = written(pair_distances(chosen), "pairs")
    return {"matrix": pairs, "histogram": histogram(pairs, bins=50), "summary": pairs.agg(F.avg("distance").alias("mean"), F.median("distance").alias("median"))}


def dashboard(metrics: DataFrame) -> DataFrame:
    """Scores, bands, bars, gauges and advice of each row of metrics."""
    c, d = coverage_score(F.col("coverage_radius_mean")), diversity_score(F.col("intra_diversity_mean"), F.col("intra_diversity_max"))
    scored = metrics.withColumn("coverage_score", c).withColumn("diversity_score", d).withColumn("overall_score", (c + d) / 2)
    return scored.select(
        *(x for x in metrics.columns if x == "method"), "coverage_score", "diversity_score", "overall_score",
        *(band(F.col(f"{x}_score")).alias(f"{x}_band") for x in ("coverage", "diversity")),
        *(progress_bar(F.col(f"{x}_score")).alias(f"{x}_bar") for x in ("coverage", "diversity", "overall")),
        F.col("coverage_radius_mean").alias("gauge_coverage"), F.col("intra_diversity_mean").alias("gauge_diversity"), (F.col("selection_ratio") * 10).alias("gauge_selection"),
        recommendations(F.col("coverage_radius_max"), F.col("intra_diversity_mean"), F.col("selection_ratio")).alias("recommendations"),
    )


def centres(bins: DataFrame) -> DataFrame:
    """Histogram bars: centre and width of each bin."""
    return bins.select("bin", ((F.col("lo") + F.col("hi")) / 2).alias("centre"), (F.col("hi") - F.col("lo")).alias("width"), "n")


def all_charts(df: DataFrame, selection: DataFrame, metrics: DataFrame, method: str = "pca", key: str = "id", vector: str = "embedding") -> dict[str, DataFrame]:
    """Every chart's data by name; a chart that fails is left out with a warning."""
    out: dict[str, DataFrame] = {}
    makers = {
        "selection": lambda: {"": projection(df, selection, method, key=key, vector=vector)},
        "coverage": lambda: coverage_distribution(df, selection, key=key, vector=vector),
        "diversity": lambda: diversity_matrix(df, selection, key=key, vector=vector),
        "dashboard": lambda: {"": dashboard(metrics)},
    }
    for name, make in makers.items():
        try:
            out |= {f"{name}_{k}".rstrip("_"): v for k, v in make().items()}
        except Exception as e:  # noqa: BLE001  one chart must not stop the others
            log.warning("chart %s: %s", name, e)
    return out
