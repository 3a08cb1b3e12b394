"""Encoders: image rows to embeddings, by any model that is there."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.operators.quality import pixels_of, tensor


#: Names of encoders by alias, and the mean and deviation of each colour (red, green, blue) that they are trained with: fixed values.
ALIASES = {
    "dinov2-small": "facebook/dinov2-small",
    "dinov2-base": "facebook/dinov2-base",
    "dinov2-large": "facebook/dinov2-large",
    "dinov2-giant": "facebook/dinov2-giant",
}
COLOURS = {
    "imagenet": ((0.485, 0.456, 0.406), (0.229, 0.224, 0.225)),
    "clip": ((0.48145466, 0.4578275, 0.40821073), (0.26862954, 0.26130258, 0.27577711)),
}


def model_name(alias: str) -> str:
    """The full name of an encoder; a name that isn't an alias stays."""
    return ALIASES.get(alias, alias)


def normalised(batch: np.ndarray, colours: str | None) -> np.ndarray:
    """Images [n, 3, size, size] from 0 to 1, less the mean of each colour and over its deviation; as they are for None."""
    if colours is None:
        return batch
    mean, deviation = (np.array(v, dtype=np.float32)[:, None, None] for v in COLOURS[colours])
    return (batch - mean) / deviation


def pixel_statistics() -> Encoder:
    """An encoder without a model: a luminance thumbnail of 8 x 8 and eight shares of each colour's values, 88 numbers in all."""

    def run(batch: np.ndarray) -> np.ndarray:
        n, _, h, w = batch.shape
        gray = (batch * np.array([0.299, 0.587, 0.114], dtype=np.float32)[:, None, None]).sum(axis=1)
        small = gray[:, : h - h % 8, : w - w % 8].reshape(n, 8, h // 8, 8, w // 8).mean(axis=(2, 4)).reshape(n, 64)
        level = np.minimum((batch * 8).astype(np.int64), 7)
        shares = np.stack([(level == k).mean(axis=(2, 3)) for k in range(8)], axis=2).reshape(n, 24)
        return np.concatenate([small, shares], axis=1)

    return run


class Encoder(Protocol):
    """Gets a batch [n, 3, size, size] and gives [n, d], or [n, layers, d] to be put one after the other."""

    def __call__(self, batch: np.ndarray) -> np.ndarray: ...


def encode(images: DataFrame, make: Callable[[], Encoder], size: int = 224, batch: int = 64, image: str = "image", out: str = "embedding", colours: str | None = None) -> DataFrame:
    """Image rows with an embedding; make() runs once in each Python worker and loads the model. A model that can't be loaded fails the job.

    With `colours`, a key of COLOURS, the model gets normalised colours. Rows that can't be decoded have a null embedding; the others of their batch are kept, with their ids.
    """

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = make()
        for data, h, w, c in parts:
            found: list = [None] * len(data)
            some = [i for i in range(len(data)) if data.iloc[i] is not None and len(data.iloc[i])]
            for at in range(0, len(some), batch):
                rows = some[at : at + batch]
                x = np.stack([tensor(pixels_of(bytes(data.iloc[i]), int(h.iloc[i]), int(w.iloc[i]), int(c.iloc[i])), size) for i in rows])
                y = np.asarray(model(normalised(x, colours)), dtype=np.float32).reshape(len(rows), -1)
                for i, v in zip(rows, y, strict=True):
                    found[i] = v
            yield pd.Series(found)

    return images.withColumn(out, run(F.col(f"{image}.data"), F.col(f"{image}.height"), F.col(f"{image}.width"), F.col(f"{image}.nChannels")))
