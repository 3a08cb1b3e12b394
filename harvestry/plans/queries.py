"""Queries over the driver's tables, one for each operator of the inventory.

Vectors come from `embeddings` (vec_id, embedding, label). SEARCH queries (ids divisible by 50) meet all rows, also in the two queries of pair expressions. Images are
made from `part`, and decoded images come as rows of Spark's image source.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions import text, vectors
from harvestry.operators import charts, dedup, encode, evaluate, knn, quality, select
from harvestry.operators.reduce import CentredPCA, combine_features
from harvestry.sources import files, sinks
from harvestry.workdir import work_dir, written

THRESHOLD, PICKS, SELECTED, SEED, ROUNDS = 0.35, 20, 100, 42, 20


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding", "label")


def searched(df: DataFrame) -> DataFrame:
    return df.where(F.col("id") % 50 == 0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def whole(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


def vec_l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors.l2_normalize("embedding")
    return rows(spark, sf_dir).select("id", F.round(F.element_at(v, 1), 6).alias("first"), F.round(F.element_at(v, -1), 6).alias("last"), F.round(vectors.norm(v), 6).alias("norm"))


def _chosen(spark: SparkSession, sf_dir: str, k: int = SELECTED) -> DataFrame:
    return select.random_selection(rows(spark, sf_dir), k, SEED)


def _pairs(spark: SparkSession, sf_dir: str, value: Callable[[str, str], Column]) -> DataFrame:
    own = rows(spark, sf_dir)
    a, b = searched(own).select(F.col("id").alias("i"), F.col("embedding").alias("x")), own.select(F.col("id").alias("j"), F.col("embedding").alias("y"))
    return a.join(b, F.col("i") != F.col("j")).select("i", "j", F.round(value("x", "y"), 6).alias("value"))


def vec_pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, vectors.cosine)


def vec_pair_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, vectors.l2)


def vec_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir)
    both = combine_features(df, df)
    return both.select("id", F.size("embedding").cast("long").alias("n"), F.round(vectors.norm("embedding"), 6).alias("norm"))


def content_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = [[float((k + d) % 5 - 2) / 4 for d in range(64)] for k in range(4)]
    return rows(spark, sf_dir).select("id", F.round(vectors.soft_content_score("embedding", prompts, 2), 6).alias("score"))


def knn_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir)
    return rounded(knn.nearest(searched(df), df, 10), "value").select("src_id", "dst_id", whole("rank"), "value")


def dedup_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dedup.duplicate_edges(rows(spark, sf_dir), THRESHOLD), "sim")


def dedup_greedy_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(rows(spark, sf_dir), THRESHOLD).select("id")


def dedup_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With no cap on a row's partners, through cells, which lose no pair; every vector has an equal one."""
    df = rows(spark, sf_dir).select("id", "embedding")
    df = df.unionByName(df.withColumn("id", F.col("id") + 1_000_000))
    return dedup.deduplicate(df, 0.3, None, index=knn.CellIndex.fit(df, cells=8)).select("id")


def knn_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the search by cells finds of the true ten nearest."""
    df = rows(spark, sf_dir)
    index = knn.CellIndex.fit(df, 10, cells=16)
    exact, found = (knn.nearest(searched(df), df, 10, index=i).select("src_id", "dst_id") for i in (None, index))
    hits = written(exact, "exact").join(found, ["src_id", "dst_id"])
    return exact.agg(F.count("*").alias("asked")).crossJoin(hits.agg(F.count("*").alias("hits"))).select("asked", (F.col("hits") >= 0.9 * F.col("asked")).alias("recall_reached"))


def dedup_injected_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the default threshold, with a slightly changed copy of every vector added."""
    df = rows(spark, sf_dir).select("id", F.col("embedding").cast("array<double>").alias("embedding"))
    copies = df.select((F.col("id") + 1_000_000).alias("id"), F.transform("embedding", lambda x, i: x * (1 + (i % 3) * 0.01)).alias("embedding"))
    return dedup.deduplicate(df.unionByName(copies), 0.95).select("id")


def select_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir).select(whole("rank"), "id")


def _fps(spark: SparkSession, sf_dir: str, k: int = PICKS) -> DataFrame:
    return select.fps_selection(rows(spark, sf_dir), k)


def select_fps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fps(spark, sf_dir).select(whole("rank"), "id")


def _sound(picks: DataFrame, df: DataFrame) -> DataFrame:
    """One row: the picks, and whether they are distinct rows of df with ranks from one on."""
    known = picks.join(df.select("id"), "id", "left_semi").agg(F.countDistinct("id").alias("known"))
    return picks.agg(F.count("*").alias("picks"), F.max("rank").cast("long").alias("last"), F.countDistinct("rank").alias("ranks")).crossJoin(known).select("picks", (F.least("last", "ranks", "known") == F.greatest("last", "ranks", "known", "picks")).alias("sound"))


def select_fps_coreset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A core-set's picks depend on partitions; they are sound, begin with the lowest id and cover within four times the exact picks' radius."""
    df = rows(spark, sf_dir)
    picks = written(select.fps_selection(df, PICKS, mode="coreset"), "picks")
    radius = lambda chosen, name: knn.nearest_distance(df, df.join(chosen.select("id"), "id", "left_semi")).agg(F.max("distance").alias(name))
    both = radius(picks, "own").crossJoin(radius(_fps(spark, sf_dir), "exact")).select((F.col("own") <= 4 * F.col("exact")).alias("covers"))
    return _sound(picks, df).crossJoin(both).crossJoin(picks.where("rank = 1").select(F.col("id").alias("first")))


def _first_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir, 5)


def select_fps_seeded_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.refine(rows(spark, sf_dir), _first_five(spark, sf_dir), 15).select(whole("rank"), "id")


def _label_centers(df: DataFrame) -> DataFrame:
    parts = df.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("center")).withColumnRenamed("label", "cluster")


def select_label_medoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir)
    return rounded(select.medoids(df, _label_centers(df)), "distance").select(whole("cluster"), "id", "distance")


def select_hybrid_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters are the labels; 35 rows of ten clusters have a quota of 3 each, and 5 are added by refinement."""
    return select.hybrid_from_clusters(rows(spark, sf_dir).withColumnRenamed("label", "cluster"), 35, 10).select("id")


def select_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.kmeans_selection(rows(spark, sf_dir), PICKS, iterations=ROUNDS).select(whole("rank"), "id")


def select_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.hybrid_selection(rows(spark, sf_dir), PICKS, 10, iterations=ROUNDS).select(whole("rank"), "id")


def select_spectral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its clusters come from a library's random draws; the picks are sound and ten at most."""
    df = rows(spark, sf_dir)
    return _sound(written(select.spectral_selection(df, 10), "picks"), df).select((F.col("picks").between(1, 10)).alias("in_range"), "sound")


def select_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.incremental_selection(rows(spark, sf_dir), _first_five(spark, sf_dir), 10).select(whole("rank"), "id")


def anti_unselected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir).join(_chosen(spark, sf_dir).select("id"), "id", "left_anti").select("id")


def union_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir).select("id").union(_chosen(spark, sf_dir, PICKS).select("id")).distinct()


def pca_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the first three components of each row; their signs are free."""
    df = rows(spark, sf_dir)
    done = CentredPCA.fit(df, 3).transform(df)
    return done.select("id", *(F.round(F.abs(F.col("reduced")[k]), 6).alias(f"p{k + 1}") for k in range(3)))


def pca_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = CentredPCA.fit(rows(spark, sf_dir), 16).explained
    return spark.createDataFrame([(k, round(v, 9)) for k, v in enumerate(parts)], "component long, share double")


def _vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.vectors(rows(spark, sf_dir))


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Computed once and written: ranks, quantiles and bins read it several times. So are the picks, whose few rows can then be broadcast."""
    chosen = evaluate.selected_vectors(rows(spark, sf_dir), written(_fps(spark, sf_dir), "picks"))
    return written(knn.nearest_distance(_vecs(spark, sf_dir), evaluate.vectors(chosen)), "near")


def coverage_nn_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_near(spark, sf_dir), "distance")


COVERAGE = ("coverage_radius_max", "coverage_radius_mean", "coverage_radius_median", "coverage_radius_std", "coverage_p25", "coverage_p50", "coverage_p75", "coverage_radius_95th")
DIVERSITY = ("intra_diversity_mean", "intra_diversity_std", "intra_diversity_min", "intra_diversity_max", "intra_diversity_median")


def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.coverage(_near(spark, sf_dir)), *COVERAGE)


def diversity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.diversity(evaluate.pair_distances(evaluate.selected_vectors(_vecs(spark, sf_dir), _fps(spark, sf_dir)))), *DIVERSITY)


def diversity_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vecs(spark, sf_dir)
    return rounded(evaluate.diversity(evaluate.diversity_pairs(evaluate.selected_vectors(v, _chosen(spark, sf_dir, 200)))), *DIVERSITY)


def distance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.histogram(_near(spark, sf_dir)), "lo", "hi").select(whole("bin"), "lo", "hi", "n")


def histogram_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.centres(evaluate.histogram(_near(spark, sf_dir), bins=50)), "centre", "width").select(whole("bin"), "centre", "width", "n")


def coverage_cdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.cdf(rounded(_near(spark, sf_dir), "distance")), "share")


def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.box_plot(_near(spark, sf_dir)), "q1", "median", "q3", "whisker_low", "whisker_high")


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = charts.coverage_distribution(rows(spark, sf_dir), _fps(spark, sf_dir))["summary"]
    return rounded(found, *found.columns)


def diversity_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.diversity_matrix(rows(spark, sf_dir), _fps(spark, sf_dir))["matrix"], "distance")


def projection_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the coordinates, as their signs are free."""
    flat = charts.projection(rows(spark, sf_dir), _fps(spark, sf_dir))
    return flat.select("id", F.round(F.abs("x"), 6).alias("x"), F.round(F.abs("y"), 6).alias("y"), "selected")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate_selection(rows(spark, sf_dir), _fps(spark, sf_dir))


def evaluate_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _metrics(spark, sf_dir)
    packed = F.col("distance_distribution")
    return rounded(m.withColumn("histogram_counts", F.array_join(packed["histogram_counts"].cast("array<string>"), ",")).drop("distance_distribution"), "selection_ratio", *COVERAGE, *DIVERSITY)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.dashboard(_metrics(spark, sf_dir)).drop("recommendations"), "coverage_score", "diversity_score", "overall_score", "gauge_coverage", "gauge_diversity", "gauge_selection")


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.dashboard(_metrics(spark, sf_dir)).select(F.posexplode("recommendations").alias("place", "advice")).select(whole("place"), "advice")


def compare_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir)
    found = evaluate.compare_selections(df, {"random": _chosen(spark, sf_dir, PICKS), "fps": _fps(spark, sf_dir), "medoid": select.medoids(df, _label_centers(df)).select("id")})
    return rounded(found.select("method", "total_images", "selected_images", "coverage_radius_max", "coverage_radius_mean", "intra_diversity_mean", "intra_diversity_min"), "coverage_radius_max", "coverage_radius_mean", "intra_diversity_mean", "intra_diversity_min")


def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    joined = docs.select("doc_id", "lang", "n_chars").join(labels, "doc_id")
    out = quality.funnel(joined, {"long": F.col("n_chars") >= 256, "english": F.col("lang") == "en", "good": F.col("quality") == 1, "harmless": F.col("toxic") == 0})
    return rounded(out, "share").select(whole("place"), "stage", "rows", "passed", "share")


def filter_resolution_analogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size predicates over parts: size as width, retail price modulo 97 as height."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.col("p_size").cast("long").alias("w"), (F.col("p_retailprice").cast("long") % 97 + 1).alias("h"))
    t = quality.Thresholds(min_resolution=10)
    return part.where(quality.large_enough(F.col("w"), F.col("h"), t) & quality.not_elongated(F.col("w"), F.col("h"), t))


def _hex(value: Column, digits: int = 2) -> Column:
    return F.lpad(F.hex(value.cast("long")), digits, "0")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("size"))


def _pictures(spark: SparkSession, sf_dir: str, pixel: Callable[[Column], Column], side: int = 8) -> DataFrame:
    """(id, image): side x side images with three channels; pixel gives the byte at a place of the data."""
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(side * side * 3 - 1)), lambda i: _hex(pixel(i))), ""))
    return _parts(spark, sf_dir).select("id", F.struct(F.lit(None).cast("string").alias("origin"), F.lit(side).alias("height"), F.lit(side).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data")).alias("image"))


def image_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray, Laplacian and its variance (a whole number over 64 * 64) of images whose bytes are (7 id + i * i) modulo 251."""
    found = quality.with_blur(_pictures(spark, sf_dir, lambda i: (7 * F.col("id") + i * i) % 251)).select("id", (F.round(F.col("blur_score") * 4096) / 4096).alias("blur_score"))
    return found.withColumn("sharp", F.col("blur_score") >= quality.Thresholds().blur)


def image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes read from bitmap headers, and the predicates on them; every tenth file is broken."""
    little = lambda v: F.concat(*(_hex(F.shiftright(v, 8 * k).bitwiseAND(F.lit(255))) for k in range(4)))
    w, h = F.col("size") * 20, 1000 - F.col("size") * 13
    made = _parts(spark, sf_dir).withColumn("content", F.unhex(F.when(F.col("id") % 10 == 0, F.lit("424D00")).otherwise(F.concat(F.lit("424D" + "00" * 16), little(w), little(h)))))
    sized = made.withColumn("s", quality.header_size("content")).select("id", F.col("s.width").cast("long").alias("w"), F.col("s.height").cast("long").alias("h"))
    return sized.withColumn("kept", F.coalesce(quality.large_enough(F.col("w"), F.col("h")) & quality.not_elongated(F.col("w"), F.col("h")), F.lit(False)))


def image_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer behind the 512 x 512 tensor of one-colour images: the mean of what it gets, and the filter above the threshold."""
    images = _pictures(spark, sf_dir, lambda i: (F.col("id") * 3) % 256).where(F.col("id") % 50 == 0)
    found = quality.with_score(images, lambda batch: batch.reshape(len(batch), -1).mean(axis=1, dtype="float64"), "score")
    return found.select("id", F.round("score", 4).alias("score")).withColumn("kept", F.col("score") > quality.Thresholds().content)


def image_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of one-colour images by pixel statistics: their length, the thumbnail's first number and the share of the colours' level."""
    images = _pictures(spark, sf_dir, lambda i: (F.col("id") * 3) % 256).where(F.col("id") % 50 == 0)
    v = encode.encode(images, encode.pixel_statistics, size=64)
    return v.select("id", F.size("embedding").cast("long").alias("n"), F.round(F.col("embedding")[0].cast("double"), 4).alias("gray"), F.round(F.aggregate(F.slice("embedding", 65, 24), F.lit(0.0), lambda s, x: s + x), 4).alias("shares"))


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table through the checked sink and back."""
    back = sinks.save_checked(rows(spark, sf_dir), f"{work_dir(spark)}/harvestry/stored-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}", "embedding")
    return back.select("id", F.size("embedding").cast("long").alias("n"), F.round(vectors.norm("embedding"), 6).alias("norm"))


def listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list file with blank lines, white space at the ends and repeats through the source of paths."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.explode(F.array(F.concat(F.lit("/img/"), (F.col("page_id") % 40).cast("string"), F.lit(".png  ")), F.lit("   "))).alias("value"))
    path = f"{work_dir(spark)}/harvestry/list-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    pages.write.text(path)
    return files.image_paths(spark, filter_list=path)


def estimate_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = rows(spark, sf_dir).agg(F.count("*").alias("n"))
    parts = text.estimate_processing_time(F.col("n"))
    return n.select("n", *(F.round(c, 6).alias(k) for k, c in parts.items()))


def format_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", text.format_time(F.col("o_orderkey") * 1.7).alias("formatted"))


def format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", text.format_bytes(F.col("o_orderkey").cast("double") * 131071).alias("formatted"))


def basename_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("rank"), F.concat(F.lit("/d"), (F.col("page_id") % 7).cast("string"), F.lit("/img"), (F.col("page_id") % 40).cast("string"), F.lit(".png")).alias("path"))
    return text.collision_names(pages).select("rank", "path", "target")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        vec_l2_normalize, vec_pair_cosine, vec_pair_l2, vec_concat, content_score, knn_top10, knn_cells_recall, dedup_edges, dedup_greedy_keep, dedup_uncapped, dedup_injected_copies, select_random, select_fps,
        select_fps_coreset, select_fps_seeded_refine, select_label_medoid, select_hybrid_by_label, select_kmeans, select_hybrid, select_spectral, select_incremental, anti_unselected,
        union_selection, pca_reduce, pca_explained, coverage_nn_distance, coverage_metrics, diversity_metrics, diversity_sampled, distance_histogram, histogram_bars, coverage_cdf,
        boxplot_stats, coverage_summary, diversity_matrix, projection_2d, evaluate_selection, quality_scores, recommendations, compare_methods, funnel_counts,
        filter_resolution_analogue, image_blur, image_headers, image_scores, image_embeddings, stored_table, listed_paths, estimate_time, format_time, format_bytes, basename_collision,
    )
}
