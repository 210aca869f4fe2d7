"""Likeness of texts and fingerprints: sequence ratio with lossless bounds, simhash, image hashes and distances."""

from __future__ import annotations

import difflib
import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np


def ratio(a: str, b: str) -> float:
    """The sequence ratio with ``a`` as the first text; it is not symmetric.  Two empty texts give 1.0."""
    return difflib.SequenceMatcher(None, a, b).ratio()


def lcs_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    ones = (1 << len(a)) - 1
    v = ones
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & ones
    return len(a) - v.bit_count()


def above(a: str, b: str, threshold: float) -> bool:
    """``ratio(a, b) > threshold``, refused early by bounds that never refuse wrongly: lengths, letters, subsequence."""
    if a == b:
        return 1.0 > threshold
    total = len(a) + len(b)
    if 2 * min(len(a), len(b)) <= threshold * total:
        return False
    if 2 * sum((Counter(a) & Counter(b)).values()) <= threshold * total:
        return False
    if 2 * lcs_length(a, b) <= threshold * total:
        return False
    return ratio(a, b) > threshold


def simhash(text: str) -> int:
    """64 bits over blank-separated tokens, each token's low md5 half with weight 1; set where the sum is above 0.

    The result is signed, as a long column holds it; a text without tokens gives 0.
    """
    tokens = text.split()
    if not tokens:
        return 0
    hashes = np.array([int.from_bytes(hashlib.md5(t.encode()).digest()[8:], "big") for t in tokens], dtype=np.uint64)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    value = sum(1 << i for i in range(64) if 2 * int(bits[:, i].sum()) > len(tokens))
    return value - (1 << 64) if value >> 63 else value


@lru_cache(64)
def _spans(size: int, target: int) -> np.ndarray:
    """One row per target place with ones where it takes its pixels from."""
    edges = np.linspace(0, size, target + 1).astype(int)
    at = np.arange(size)
    return ((at >= edges[:-1, None]) & (at < np.maximum(edges[:-1] + 1, edges[1:])[:, None])).astype(float)


def _resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area means; where the image is smaller than the target its pixels are repeated."""
    down, across = _spans(image.shape[0], height), _spans(image.shape[1], width)
    total = np.tensordot(across, np.tensordot(down, image.astype(float), (1, 0)), (1, 1)).swapaxes(0, 1)
    area = down.sum(1)[:, None] * across.sum(1)[None, :]
    return total / (area if image.ndim == 2 else area[:, :, None])


def mse(a: np.ndarray, b: np.ndarray) -> float:
    """Mean squared error, the first image brought to the size of the second."""
    if a.shape != b.shape:
        a = _resize(a, *b.shape[:2])
    return float(((a.astype(float) - b.astype(float)) ** 2).mean())


def dhash(image: np.ndarray) -> int:
    """Bits that say where a pixel is brighter than its left neighbour in a 9 by 8 reduction; 64 bits per channel."""
    small = _resize(image, 8, 9)
    return int("".join("1" if x else "0" for x in (small[:, 1:] > small[:, :-1]).flatten()), 2)


def phash(image: np.ndarray) -> int:
    """64 bits of the low frequencies of a 32 by 32 grey reduction against their median."""
    grey = image.mean(axis=2) if image.ndim == 3 else image
    x = _resize(grey, 32, 32)
    k = np.arange(32)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64)
    low = (basis @ x @ basis.T)[:8, :8]
    return int("".join("1" if v else "0" for v in (low > np.median(low)).flatten()), 2)


def hamming(a: int, b: int) -> int:
    return (a ^ b).bit_count()


def histogram_correlation(a: np.ndarray, b: np.ndarray, bins: tuple[int, int] = (50, 60)) -> float:
    """Correlation of hue and saturation histograms, each scaled to 0..1."""

    def histogram(image: np.ndarray) -> np.ndarray:
        rgb = image.astype(float) / 255
        top, low = rgb.max(axis=2), rgb.min(axis=2)
        span = np.where(top == low, 1, top - low)
        r, g, bl = rgb[..., 0], rgb[..., 1], rgb[..., 2]
        hue = np.where(top == r, (g - bl) / span % 6, np.where(top == g, (bl - r) / span + 2, (r - g) / span + 4)) * 60
        hue = np.where(top == low, 0, hue)
        sat = np.where(top == 0, 0, (top - low) / np.where(top == 0, 1, top))
        made, _, _ = np.histogram2d(hue.ravel(), sat.ravel(), bins=bins, range=((0, 360), (0, 1.0000001)))
        return (made - made.min()) / max(1e-12, made.max() - made.min())

    x, y = histogram(a).ravel(), histogram(b).ravel()
    x, y = x - x.mean(), y - y.mean()
    below = np.sqrt((x**2).sum() * (y**2).sum())
    return float((x * y).sum() / below) if below else 1.0


def report(a: np.ndarray, b: np.ndarray, features: tuple[np.ndarray, np.ndarray] | None = None) -> dict:
    """All distances at once; the cosine of feature vectors only where they are given."""
    out = {"mse": mse(a, b), "dhash": hamming(dhash(a), dhash(b)), "phash": hamming(phash(a), phash(b)), "histogram": histogram_correlation(a, b), "cosine": None}
    if features is not None:
        x, y = features
        out["cosine"] = float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)))
    return out
