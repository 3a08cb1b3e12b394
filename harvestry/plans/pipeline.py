"""The curation pipeline: filter, embed, reduce, deduplicate, select, evaluate. Stages are tables keyed by id under one folder."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.operators import charts, encode, quality
from harvestry.operators.dedup import deduplicate
from harvestry.operators.evaluate import evaluate_selection
from harvestry.operators.knn import CellIndex
from harvestry.operators.reduce import CentredPCA
from harvestry.operators.select import select_diverse
from harvestry.plans.config import Config
from harvestry.sources import files, sinks

log = logging.getLogger(__name__)


@dataclass
class Result:
    selected: DataFrame
    embeddings: DataFrame
    metrics: DataFrame | None
    skipped: list[str]


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if files._exists(spark, path) else None


def curate(embeddings: DataFrame, config: Config, out: str | None = None) -> Result:
    """From (id, embedding, ...) on. With `out`, each stage is written there and read back; else it stays a plan."""
    keep = (lambda df, name, vector=None: sinks.save_checked(df, f"{out}/{name}", vector)) if out else (lambda df, name, vector=None: df)
    skipped = []
    table = keep(embeddings, "embeddings_raw", "embedding")
    reduction = config.dimensionality_reduction
    length = table.select(F.max(F.size("embedding"))).first()[0] or 0
    if reduction.enabled and reduction.n_components < min(length, table.count()):
        pca = CentredPCA.fit(table, reduction.n_components)
        log.info("explained variance %.4f", sum(pca.explained))
        if out:
            pca.save(f"{out}/pca_model")
        table = keep(pca.transform(table).drop("embedding").withColumnRenamed("reduced", "embedding"), "embeddings_reduced", "embedding")
    else:
        skipped.append("dimensionality_reduction")
    rule = config.deduplication
    index = CellIndex.fit(table, rule.neighbours or 10, cells=rule.cells or None) if rule.cells is not None else None
    if rule.enabled:
        table = keep(deduplicate(table, rule.threshold, rule.neighbours or None, index=index), "deduplicated")
    else:
        skipped.append("deduplication")
    chosen = config.diversity_selection
    more = {"clusters": chosen.hybrid.n_clusters} if chosen.method == "hybrid" else {"index": index} if chosen.method == "spectral" else {}
    picks = select_diverse(table, chosen.n_select, chosen.method, chosen.seed, **more)
    extra = [c for c in table.columns if c not in ("id", "embedding")]
    selected = keep(picks.join(table.select("id", *extra), "id").select("rank", "id", *extra) if extra else picks, "selected")
    metrics = keep(evaluate_selection(table, selected), "metrics") if config.evaluation.enabled else None
    return Result(selected, table, metrics, skipped)


def run_pipeline(
    spark: SparkSession, config: Config, make_encoder: Callable[[], encode.Encoder], brisque: quality.Scorer | None = None, content: quality.Scorer | None = None, resume: bool = False
) -> Result:
    """All stages over the images of config.input.image_dir. resume takes up a filtered table that an earlier run has left.

    Files that pass the filter and that Spark's image source can't decode (WebP among them, and broken ones) are listed in the table `undecoded`.
    """
    out, q = config.output.output_dir, config.quality_filter
    filtered = _stored(spark, f"{out}/filtered") if resume else None
    skipped = []
    if filtered is None:
        if q.enabled:
            t = quality.Thresholds(q.min_resolution, q.max_aspect_ratio, q.blur_threshold, q.brisque_threshold, q.car_confidence_threshold)
            decoded = files.images(spark, config.input.image_dir) if brisque or content else None
            paths = quality.filter_images(files.image_files(spark, config.input.image_dir), decoded, t, brisque, content)
            skipped += [n for n, s in (("brisque", brisque), ("content", content)) if s is None]
        else:
            paths = files.image_paths(spark, config.input.image_dir)
        filtered = sinks.save_checked(files.with_ids(paths), f"{out}/filtered")
    rows = files.images(spark, config.input.image_dir).withColumn("path", quality.origin_path(F.col("image.origin"))).join(filtered, "path")
    undecoded = sinks.save_checked(filtered.select("path").join(rows.select("path"), "path", "left_anti"), f"{out}/undecoded")
    if not undecoded.isEmpty():
        log.warning("%d files can't be decoded by Spark's image source; they are listed in %s/undecoded", undecoded.count(), out)
    embedded = encode.encode(rows, make_encoder, batch=config.hardware.batch_size).where(F.col("embedding").isNotNull())
    result = curate(embedded.select("id", "path", "embedding"), config, out)
    result.skipped[:0] = skipped
    if result.metrics is not None:
        sinks.save_results(result.metrics.first(), f"{out}/evaluation_metrics.yaml", sort_keys=False)
    if config.output.copy_images:
        sinks.copy_selected(result.selected, f"{out}/selected_images")
    if config.output.create_symlinks:
        sinks.link_selected(result.selected, f"{out}/selected_images_symlinks")
    if config.evaluation.create_visualization and result.metrics is not None:
        for name, df in charts.all_charts(result.embeddings, result.selected, result.metrics, config.evaluation.visualization_method).items():
            df.write.mode("overwrite").parquet(f"{out}/charts/{name}")
    return result


def run_many(spark: SparkSession, configs: dict[str, Config], make_encoder: Callable[[], encode.Encoder], **more) -> dict[str, Result]:
    """Several datasets, one after the other."""
    return {name: run_pipeline(spark, c, make_encoder, **more) for name, c in configs.items()}
