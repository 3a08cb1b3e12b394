"""Metrics of a selection: coverage, diversity, distance distribution, and the comparison of methods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.functions.vectors import l2, l2_normalize
from harvestry.operators.knn import nearest_distance
from harvestry.operators.rank import quantiles
from harvestry.workdir import written

MAX_PAIRS = 10_000


def vectors(df: DataFrame, normalize: bool = True, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(id, embedding) in doubles, unit length if `normalize`; rows without id or vector are left out."""
    v = l2_normalize(vector) if normalize else F.col(vector).cast("array<double>")
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("embedding"))


def selected_vectors(vecs: DataFrame, selection: DataFrame) -> DataFrame:
    return vecs.join(selection.select(F.col("id").cast("long").alias("id")).distinct(), "id", "left_semi")


def coverage(distances: DataFrame, by: str | None = None) -> DataFrame:
    """Statistics of the distances to the nearest selected row: one row (nulls if there are none), or one for each value of `by`."""
    d = F.col("distance")
    moments = distances.groupBy(*([by] if by else [])).agg(F.max(d).alias("coverage_radius_max"), F.avg(d).alias("coverage_radius_mean"), F.stddev_pop(d).alias("coverage_radius_std"))
    places = quantiles(distances, "distance", {"coverage_p25": 0.25, "coverage_p50": 0.5, "coverage_p75": 0.75, "coverage_radius_95th": 0.95}, by)
    both = moments.join(places, by) if by else moments.crossJoin(places)
    return both.select(*([by] if by else []), "coverage_radius_max", "coverage_radius_mean", F.col("coverage_p50").alias("coverage_radius_median"), "coverage_radius_std", "coverage_p25", "coverage_p50", "coverage_p75", "coverage_radius_95th")


def pair_distances(selected: DataFrame) -> DataFrame:
    """(i, j, distance) of all pairs i < j of a selection, which is bounded by its size."""
    a, b = selected.select(F.col("id").alias("i"), F.col("embedding").alias("x")), selected.select(F.col("id").alias("j"), F.col("embedding").alias("y"))
    return a.join(b, F.col("i") < F.col("j")).select("i", "j", l2("x", "y").alias("distance"))


def sampled_pairs(selected: DataFrame, pairs: int = MAX_PAIRS, seed: int = 42) -> DataFrame:
    """(i, j, distance) of seeded random pairs (drawn by MD5 of the pair's number) with replacement, without pairs of a row with itself, for selections with more than `pairs` pairs."""
    spark, n = selected.sparkSession, selected.count()
    placed = selected.withColumn("place", F.row_number().over(Window.orderBy("id")) - 1)
    draw = lambda salt, m: (F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{salt}:{seed}")).cast("binary")), 1, 8), 16, 10).cast("long") % m).cast("int")
    drawn = spark.range(pairs).select(draw("a", n).alias("p"), draw("b", n - 1).alias("q")).withColumn("q", F.when(F.col("q") >= F.col("p"), F.col("q") + 1).otherwise(F.col("q")))
    side = lambda place, i, v: placed.select(F.col("place").alias(place), F.col("id").alias(i), F.col("embedding").alias(v))
    return drawn.join(side("p", "i", "x"), "p").join(side("q", "j", "y"), "q").select("i", "j", l2("x", "y").alias("distance"))


def diversity_pairs(selected: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """All pairs up to max_pairs of them (141 rows at 10,000), and sampled ones beyond."""
    n = selected.count()
    return pair_distances(selected) if n * (n - 1) // 2 <= max_pairs else sampled_pairs(selected, max_pairs)


def diversity(pairs: DataFrame, by: str | None = None) -> DataFrame:
    d = F.col("distance")
    return pairs.groupBy(*([by] if by else [])).agg(F.avg(d).alias("intra_diversity_mean"), F.stddev_pop(d).alias("intra_diversity_std"), F.min(d).alias("intra_diversity_min"), F.max(d).alias("intra_diversity_max"), F.median(d).alias("intra_diversity_median"))


def histogram(df: DataFrame, column: str = "distance", bins: int = 20, by: str | None = None) -> DataFrame:
    """(bin, lo, hi, n): equal widths from minimum to maximum, empty bins included, the last one closed; with `by`, bins for each of its values, which must be few.

    Equal values widen the range by a half on both sides. No values: no bins. Two aggregations; the second joins the bounds.
    """
    own = df.where(F.col(column).isNotNull()).withColumn("_g", F.col(by) if by else F.lit(0))
    bounds = own.groupBy("_g").agg(F.min(column).alias("a"), F.max(column).alias("b"))
    same = F.col("a") == F.col("b")
    bounds = bounds.select("_g", F.when(same, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"), F.when(same, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"))
    at = F.least(F.width_bucket(F.col(column), F.col("a"), F.col("b"), F.lit(bins)), F.lit(bins)).cast("int")
    counts = own.join(F.broadcast(bounds), "_g").groupBy("_g", at.alias("bin")).agg(F.count("*").alias("n"))
    edges = bounds.select("_g", "a", ((F.col("b") - F.col("a")) / bins).alias("step"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return edges.join(counts, ["_g", "bin"], "left").select(*([F.col("_g").alias(by)] if by else []), "bin", (F.col("a") + (F.col("bin") - 1) * F.col("step")).alias("lo"), (F.col("a") + F.col("bin") * F.col("step")).alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def packed(bins: DataFrame, by: str | None = None) -> DataFrame:
    """The histogram as one struct of counts and edges."""
    rows = F.array_sort(F.collect_list(F.struct("bin", "lo", "hi", "n")))
    edges = F.concat(F.transform(rows, lambda r: r["lo"]), F.slice(F.transform(rows, lambda r: r["hi"]), -1, 1))
    return bins.groupBy(*([by] if by else [])).agg(F.when(F.count("*") > 0, F.struct(F.transform(rows, lambda r: r["n"]).alias("histogram_counts"), edges.alias("histogram_edges"))).alias("distance_distribution"))


def compare_selections(df: DataFrame, selections: dict[str, DataFrame], normalize: bool = True, key: str = "id", vector: str = "embedding") -> DataFrame:
    """A row of metrics for each method, all in one pass: one search for the nearest selected rows of every method, one ranking, one histogram.

    The selections' vectors and the distances to them are computed once and written. A method that selects nothing has null metrics.
    """
    spark, vecs = df.sparkSession, vectors(df, normalize, key, vector)
    chosen = None
    for name, selection in selections.items():
        own = selected_vectors(vecs, selection).withColumn("grp", F.lit(name))
        chosen = own if chosen is None else chosen.unionByName(own)
    if chosen is None:
        raise ValueError("no selection")
    chosen = written(chosen, "chosen")
    near = written(nearest_distance(vecs, chosen, group="grp"), "near")
    pairs = None
    for name in selections:
        own = diversity_pairs(chosen.where(F.col("grp") == name)).withColumn("grp", F.lit(name))
        pairs = own if pairs is None else pairs.unionByName(own)
    methods = spark.createDataFrame([(k, name) for k, name in enumerate(selections)], "place int, grp string")
    counts = methods.join(chosen.groupBy("grp").agg(F.count("*").alias("selected_images")), "grp", "left").crossJoin(vecs.agg(F.count("*").alias("total_images")))
    counts = counts.select("place", "grp", "total_images", F.coalesce("selected_images", F.lit(0)).cast("long").alias("selected_images")).withColumn("selection_ratio", F.try_divide("selected_images", "total_images"))
    for part in (coverage(near, "grp"), diversity(pairs, "grp"), packed(histogram(near, by="grp"), "grp")):
        counts = counts.join(part, "grp", "left")
    return counts.orderBy("place").drop("place").withColumnRenamed("grp", "method")


def evaluate_selection(df: DataFrame, selection: DataFrame, normalize: bool = True, key: str = "id", vector: str = "embedding") -> DataFrame:
    """One row with all metrics."""
    return compare_selections(df, {"": selection}, normalize, key, vector).drop("method")


def validate_selection(df: DataFrame, selection: DataFrame, key: str = "id") -> None:
    """Raises ValueError if a selected id isn't in df, or more rows are selected than there are."""
    missing = selection.join(df.select(F.col(key).alias("id")), "id", "left_anti").limit(5).collect()
    if missing:
        raise ValueError(f"selected ids that are not there: {[r['id'] for r in missing]}")
    if selection.count() > df.count():
        raise ValueError("more rows are selected than there are")
