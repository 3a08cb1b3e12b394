"""Command line: `python -m harvestry.plans.cli run|curate|evaluate|compare|filter ...`."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable
from functools import partial
from importlib import import_module
from inspect import signature

from pyspark.sql import DataFrame, SparkSession

from harvestry.operators import charts
from harvestry.operators.encode import Encoder
from harvestry.operators.evaluate import compare_selections, evaluate_selection, validate_selection
from harvestry.operators.quality import Thresholds, filter_images
from harvestry.operators.select import METHODS, select_diverse
from harvestry.plans.config import Config, load_config
from harvestry.plans.pipeline import curate, run_pipeline
from harvestry.sources import files, sinks
from harvestry.workdir import clean

log = logging.getLogger("harvestry")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="harvestry")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="all stages, from a folder of images to a selection")
    r.add_argument("--image-dir")
    r.add_argument("--skip-quality-filter", action="store_true")
    r.add_argument("--device", choices=("cuda", "cpu"), help="handed to the encoder")
    r.add_argument("--encoder", default="harvestry.operators.encode:pixel_statistics", help="module:function that makes an encoder; it gets the configuration if it takes an argument")
    r.add_argument("--resume", action="store_true")
    c = sub.add_parser("curate", help="reduce, deduplicate, select and evaluate a table (id, embedding, ...)")
    c.add_argument("embeddings")
    for p_ in (r, c):
        p_.add_argument("--config")
        p_.add_argument("--output-dir")
        p_.add_argument("--n-select", type=int)
        p_.add_argument("--method", choices=METHODS)
        p_.add_argument("--batch-size", type=int)
        p_.add_argument("--skip-deduplication", action="store_true")
        p_.add_argument("--visualization-method", choices=("tsne", "umap", "pca"))
    e = sub.add_parser("evaluate", help="metrics and charts of what curate has left")
    e.add_argument("output_dir")
    e.add_argument("--viz-dir")
    e.add_argument("--method", default="pca")
    e.add_argument("--no-viz", action="store_true")
    e.add_argument("--metrics-only", action="store_true")
    m = sub.add_parser("compare", help="metrics of several selection methods")
    m.add_argument("embeddings")
    m.add_argument("--n-select", type=int, default=1000)
    m.add_argument("--methods", nargs="+", default=["random", "kmeans", "fps", "hybrid"], choices=METHODS)
    f = sub.add_parser("filter", help="paths of images that pass the header predicates")
    f.add_argument("image_dir")
    f.add_argument("--out", required=True)
    return p


def overrides(args: argparse.Namespace) -> dict:
    """Command-line values as nested configuration; what isn't given stays out."""
    out = {
        "output": {"output_dir": args.output_dir},
        "hardware": {"batch_size": args.batch_size, "device": getattr(args, "device", None)},
        "input": {"image_dir": getattr(args, "image_dir", None)},
        "diversity_selection": {"n_select": args.n_select, "method": args.method},
        "evaluation": {"visualization_method": args.visualization_method},
    }
    if args.skip_deduplication:
        out["deduplication"] = {"enabled": False}
    if getattr(args, "skip_quality_filter", False):
        out["quality_filter"] = {"enabled": False}
    return out


def encoder_maker(name: str, config: Config) -> Callable[[], Encoder]:
    """What makes the encoder named module:function in each worker."""
    module, _, function = name.partition(":")
    make = getattr(import_module(module), function)
    return partial(make, config) if signature(make).parameters else make


def setup_logging(config: Config) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if config.logging.log_file:
        handlers.append(logging.FileHandler(config.logging.log_file))
    logging.basicConfig(level=config.logging.level.upper(), handlers=handlers, force=True, format="%(asctime)s %(levelname)s %(name)s: %(message)s")


def system_info(spark: SparkSession) -> dict[str, object]:
    """What a run's log should say about where it ran."""
    context = spark.sparkContext
    return {"spark": spark.version, "master": context.master, "parallelism": context.defaultParallelism, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}


def evaluate(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Metrics of a curate run's last embeddings and selection, with charts beside them unless they aren't wanted."""
    stages = [s for s in ("deduplicated", "embeddings_reduced", "embeddings_raw") if files._exists(spark, f"{args.output_dir}/{s}")]
    if not stages or not files._exists(spark, f"{args.output_dir}/selected"):
        raise FileNotFoundError(f"{args.output_dir} has no embeddings or no selection")
    table, chosen = spark.read.parquet(f"{args.output_dir}/{stages[0]}"), spark.read.parquet(f"{args.output_dir}/selected")
    validate_selection(table, chosen)
    metrics = evaluate_selection(table, chosen)
    sinks.save_results(metrics.first(), f"{args.output_dir}/evaluation_metrics.yaml", sort_keys=False)
    if not (args.no_viz or args.metrics_only):
        for name, df in charts.all_charts(table, chosen, metrics, args.method).items():
            df.write.mode("overwrite").parquet(f"{args.viz_dir or args.output_dir + '/charts'}/{name}")
    return metrics


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("harvestry").getOrCreate()
    try:
        if args.command == "run":
            config = load_config(args.config, overrides(args))
            setup_logging(config)
            log.info("%s", system_info(spark))
            run_pipeline(spark, config, encoder_maker(args.encoder, config), resume=args.resume)
        elif args.command == "curate":
            config = load_config(args.config, overrides(args))
            setup_logging(config)
            log.info("%s", system_info(spark))
            curate(spark.read.parquet(args.embeddings), config, config.output.output_dir)
        elif args.command == "evaluate":
            evaluate(spark, args).show(truncate=False)
        elif args.command == "compare":
            table = spark.read.parquet(args.embeddings)
            compare_selections(table, {m: select_diverse(table, args.n_select, m) for m in args.methods}).show(truncate=False)
        else:
            filter_images(files.image_files(spark, args.image_dir), t=Thresholds()).orderBy("path").write.mode("overwrite").text(args.out)
    except (FileNotFoundError, ValueError, NotImplementedError) as e:
        log.error("%s", e)
        return 1
    finally:
        clean(spark)  # results are stored or shown
    return 0


if __name__ == "__main__":
    sys.exit(main())
