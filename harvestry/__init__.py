"""Harvestry: curation of small, clean and diverse subsets of large collections, on Spark."""

from importlib import import_module

#: Public names and where they are; they are imported when first used, so that Python workers load what they need only.
_PUBLIC = {
    "Config": "plans.config", "load_config": "plans.config", "curate": "plans.pipeline", "run_pipeline": "plans.pipeline", "run_many": "plans.pipeline",
    "filter_images": "operators.quality", "Thresholds": "operators.quality", "encode": "operators.encode", "combine_features": "operators.reduce", "CentredPCA": "operators.reduce",
    "deduplicate": "operators.dedup", "nearest": "operators.knn", "select_diverse": "operators.select", "incremental_selection": "operators.select",
    "evaluate_selection": "operators.evaluate", "compare_selections": "operators.evaluate", "all_charts": "operators.charts", "dashboard": "operators.charts",
    "image_paths": "sources.files", "load_results": "sources.files", "save_results": "sources.sinks", "copy_selected": "sources.sinks", "link_selected": "sources.sinks",
    "format_time": "functions.text", "format_bytes": "functions.text", "estimate_processing_time": "functions.text", "top_up": "streaming.topup",
}
__all__ = sorted(_PUBLIC)  # noqa: PLE0605


def __getattr__(name: str):
    if name in _PUBLIC:
        return getattr(import_module(f"{__name__}.{_PUBLIC[name]}"), name)
    raise AttributeError(name)
