"""Image likeness over rows that hold pixel lists with their size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from siltloom.common import map_rows
from siltloom.functions import similarity


def array(image: dict) -> np.ndarray:
    """Height by width, by channels where there is more than one."""
    pixels = np.asarray(image["pixels"], dtype=float)
    h, w = image["height"], image["width"]
    channels = pixels.size // (h * w)
    return pixels.reshape(h, w, channels) if channels > 1 else pixels.reshape(h, w)


def hashes(images: DataFrame, key: str = "id", image: str = "image") -> DataFrame:
    """(key, phash): 64-bit perceptual hashes as signed longs."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, im in rows:
            if im is not None:
                h = similarity.phash(array(im))
                yield k, h - (1 << 64) if h >> 63 else h

    return map_rows(images.select(key, image), run, f"{key} {dict(images.dtypes)[key]}, phash long")


def reports(pairs: DataFrame, key: str = "id") -> DataFrame:
    """(key, mse, dhash, phash, histogram) of image pairs a, b."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, a, b in rows:
            x, y = array(a), array(b)
            three = x.ndim == 3 and y.ndim == 3
            yield k, similarity.mse(x, y), similarity.hamming(similarity.dhash(x), similarity.dhash(y)), similarity.hamming(similarity.phash(x), similarity.phash(y)), similarity.histogram_correlation(x, y) if three else None

    return map_rows(pairs.select(key, "a", "b"), run, f"{key} {dict(pairs.dtypes)[key]}, mse double, dhash int, phash int, histogram double")
