"""Configuration: defaults, a YAML file, command-line values, in rising precedence. Keys that only an encoder can honour are kept for it."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from pathlib import Path

import yaml


@dataclass(frozen=True)
class Input:
    image_dir: str = "./images"


@dataclass(frozen=True)
class Output:
    output_dir: str = "./output"
    copy_images: bool = False
    create_symlinks: bool = False


@dataclass(frozen=True)
class Hardware:
    """batch_size is an encoder's; device, vram_limit_gb and use_fp16 are handed to make_encoder by whoever builds it."""

    device: str = "cpu"
    vram_limit_gb: int = 24
    batch_size: int = 64
    use_fp16: bool = True


@dataclass(frozen=True)
class QualityFilter:
    enabled: bool = True
    min_resolution: int = 256
    max_aspect_ratio: float = 3.0
    blur_threshold: float = 100.0
    brisque_threshold: float = 45.0
    car_confidence_threshold: float = 0.5


@dataclass(frozen=True)
class FeatureExtraction:
    """Handed to make_encoder by whoever builds it."""

    model_name: str = "dinov2-large"
    multilayer: bool = False
    layers: tuple[int, ...] = (4, 8, 12)
    use_clip: bool = False


@dataclass(frozen=True)
class Reduction:
    enabled: bool = True
    n_components: int = 512


@dataclass(frozen=True)
class Deduplication:
    """neighbours: 0 compares without a cap. cells: null searches exactly over all blocks; a number (0: one for each block of rows) searches by so many cells."""

    enabled: bool = True
    threshold: float = 0.95
    neighbours: int = 10
    cells: int | None = None


@dataclass(frozen=True)
class Hybrid:
    n_clusters: int | None = None


@dataclass(frozen=True)
class Farthest:
    """batch_size: rows of a block in exact neighbour search."""

    batch_size: int = 4096


@dataclass(frozen=True)
class Selection:
    n_select: int = 30000
    method: str = "hybrid"
    seed: int = 42
    hybrid: Hybrid = field(default_factory=Hybrid)
    fps: Farthest = field(default_factory=Farthest)


@dataclass(frozen=True)
class Evaluation:
    enabled: bool = True
    create_visualization: bool = True
    visualization_method: str = "pca"


@dataclass(frozen=True)
class Logging:
    level: str = "INFO"
    log_file: str | None = None


@dataclass(frozen=True)
class Config:
    input: Input = field(default_factory=Input)
    output: Output = field(default_factory=Output)
    hardware: Hardware = field(default_factory=Hardware)
    quality_filter: QualityFilter = field(default_factory=QualityFilter)
    feature_extraction: FeatureExtraction = field(default_factory=FeatureExtraction)
    dimensionality_reduction: Reduction = field(default_factory=Reduction)
    deduplication: Deduplication = field(default_factory=Deduplication)
    diversity_selection: Selection = field(default_factory=Selection)
    evaluation: Evaluation = field(default_factory=Evaluation)
    logging: Logging = field(default_factory=Logging)


def merged(base: object, values: dict, where: str = "") -> object:
    """base with the values of a nested dictionary; unknown keys are an error, None leaves the default."""
    known = {f.name: getattr(base, f.name) for f in fields(base)}
    changes = {}
    for k, v in (values or {}).items():
        if k not in known:
            raise ValueError(f"unknown key {where}{k}")
        if v is None:
            continue
        changes[k] = merged(known[k], v, f"{where}{k}.") if is_dataclass(known[k]) else tuple(v) if isinstance(known[k], tuple) else v
    return replace(base, **changes)


def load_config(path: str | None = None, overrides: dict | None = None) -> Config:
    config = Config()
    if path is not None:
        if not Path(path).exists():
            raise FileNotFoundError(path)
        config = merged(config, yaml.safe_load(Path(path).read_text()) or {})
    return merged(config, overrides or {})
