"""Deterministic degradation of images as a cheap camera would have taken them, in numpy alone.

Steps in order: motion blur along a random line, loss of resolution, sensor noise, drift of the white balance. A last step of lossy
compression needs an image library and is left to a codec given by the caller. All randomness comes from (seed, severity), so images
of one shape get the same noise, on whichever task they are processed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Severities, length of the blur line by severity, pixels of the target sensor and what it resolves of them, noise, drift.
SEVERITIES = (1, 2, 3, 4, 5)
BLUR = {1: 3, 2: 3, 3: 5, 4: 5, 5: 7}
SENSOR_PIXELS, RESOLVED = 800 * 600, 0.75
NOISE_BASE, NOISE_STEP, CHROMA = 1.0, 1.5, 0.5
DRIFT_STEP, DRIFT_GREEN = 0.02, 0.25


def line_blur(image: np.ndarray, length: int, angle: float) -> np.ndarray:
    """The mean of the image shifted along a line of ``length`` pixels; borders repeat their edge."""
    half = (length - 1) / 2
    steps = np.linspace(-half, half, length)
    shifts = {(round(math.sin(angle) * s), round(math.cos(angle) * s)) for s in steps}
    reach = length // 2 + 1
    padded = np.pad(image.astype(np.float32), ((reach, reach), (reach, reach), (0, 0)), mode="edge")
    h, w = image.shape[:2]
    total = sum(padded[reach + dy : reach + dy + h, reach + dx : reach + dx + w] for dy, dx in sorted(shifts))
    return np.asarray(total / len(shifts))


def _weights(size: int, small: int) -> np.ndarray:
    """Matrix that averages ``size`` cells down to ``small``."""
    edges = np.arange(small + 1) * size / small
    low, high = edges[:-1, None], edges[1:, None]
    cells = np.arange(size)[None]
    cover = np.clip(np.minimum(high, cells + 1) - np.maximum(low, cells), 0, None)
    return cover / cover.sum(1, keepdims=True)


def _stretch(small: int, size: int) -> np.ndarray:
    """Matrix that interpolates ``small`` cells up to ``size``."""
    at = np.clip((np.arange(size) + 0.5) * small / size - 0.5, 0, small - 1)
    low = np.floor(at).astype(int)
    high = np.minimum(low + 1, small - 1)
    out = np.zeros((size, small))
    out[np.arange(size), low] += 1 - (at - low)
    out[np.arange(size), high] += at - low
    return out


def lose_resolution(image: np.ndarray, severity: int) -> np.ndarray:
    """Down to what a sensor of ``SENSOR_PIXELS`` resolves at the last severity, proportionally less before, and back to the old size."""
    h, w = image.shape[:2]
    pixels = min(h * w, SENSOR_PIXELS)
    side = np.interp(severity, (0, SEVERITIES[-1]), (1.0, RESOLVED * (pixels / (h * w)) ** 0.5))
    sh, sw = (max(1, round(n * float(side))) for n in (h, w))
    rows, cols = _stretch(sh, h) @ _weights(h, sh), _stretch(sw, w) @ _weights(w, sw)
    return np.einsum("ij,jkc,lk->ilc", rows, image, cols, optimize=True)


def sensor_noise(shape: tuple[int, int], severity: int, rng: np.random.Generator) -> np.ndarray:
    """Noise for three channels: one part is common to them, and each has a smaller part of its own."""
    mixing = np.vstack([np.ones(3), CHROMA * np.eye(3)]) * (NOISE_BASE + NOISE_STEP * severity)
    return rng.standard_normal((*shape, 4)) @ mixing


def white_balance(severity: int, rng: np.random.Generator) -> np.ndarray:
    """Gains of the three channels: red and blue drift apart, either way, and green goes up a little."""
    drift = DRIFT_STEP * severity * (1 - 0.5 * rng.random())
    tint = rng.choice((-1.0, 1.0))
    return 1.0 + drift * np.array([tint, DRIFT_GREEN, -tint])


def degrade(image: np.ndarray, severity: int, seed: int, codec: Callable[[np.ndarray, int], np.ndarray] | None = None) -> np.ndarray:
    """An RGB image (height x width x 3, bytes) at a severity of 1 to 5; the same input gives the same bytes.

    The order of the random draws is its own: angle of the blur, noise, size and direction of the drift.
    """
    if image.ndim != 3 or image.shape[2] != 3 or image.dtype != np.uint8 or image.size == 0:
        raise ValueError("expected height x width x 3 bytes")
    if severity not in SEVERITIES or seed < 0:
        raise ValueError("severity must be 1 to 5 and the seed not negative")
    rng = np.random.default_rng([seed, severity])
    seen = lose_resolution(line_blur(image, BLUR[severity], math.pi * rng.random()), severity)
    noisy = seen + sensor_noise(image.shape[:2], severity, rng)
    done = np.clip(noisy * white_balance(severity, rng), 0, 255).astype(np.uint8)
    return codec(done, severity) if codec else done


def degraded_tiers(images: DataFrame, severities: tuple[int, ...] = SEVERITIES, seed: int = 42) -> DataFrame:
    """``image, severity, h, w, data`` for every image and severity. images: ``image, h, w, data`` (RGB bytes, row by row).

    An image whose data don't fit its size has NULL data.
    """
    levels = F.explode(F.array(*[F.lit(s) for s in severities])).alias("severity")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, w, data, s in zip(b["h"], b["w"], b["data"], b["severity"], strict=True):
                fits = data is not None and len(data) == 3 * h * w > 0
                out.append(degrade(np.frombuffer(data, np.uint8).reshape(h, w, 3), s, seed).tobytes() if fits else None)
            yield b.assign(data=out)[["image", "severity", "h", "w", "data"]]

    from siftlane.session import ship_package

    ship_package(images.sparkSession)
    return images.select("image", "h", "w", "data", levels).mapInPandas(run, "image string, severity int, h int, w int, data binary")
