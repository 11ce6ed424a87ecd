"""64-bit similarity hashes and their distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(a: Column, b: Column) -> Column:
    """Number of bits in which two hashes differ."""
    return F.bit_count(a.bitwiseXOR(b))


def rank_hash(seed: int, purpose: str | Column, key: Column) -> Column:
    """A seeded order of keys that every engine reproduces: md5 of ``seed:purpose:key``."""
    purpose = F.lit(purpose) if isinstance(purpose, str) else purpose
    return F.md5(F.concat_ws(":", F.lit(str(seed)), purpose, key))


def similarity_hash(text: Column) -> Column:
    """SimHash over the lower-cased words of a text: a bit is set where more words' md5 has it than not. NULL for NULL, 0 for no words."""

    @F.pandas_udf("bigint")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        votes: dict[str, np.ndarray] = {}
        for texts in batches:
            out = []
            for t in texts:
                if t is None:
                    out.append(None)
                    continue
                total = np.zeros(64, np.int64)
                for word in t.lower().split():
                    vote = votes.get(word)
                    if vote is None:
                        if len(votes) > 200_000:
                            votes.clear()
                        bits = np.unpackbits(np.frombuffer(hashlib.md5(word.encode()).digest()[:8], np.uint8))
                        vote = votes[word] = bits.astype(np.int64) * 2 - 1
                    total += vote
                out.append(int.from_bytes(np.packbits(total > 0).tobytes(), "big", signed=True))
            yield pd.Series(out, dtype="Int64")

    return simhash(text)


def perceptual_hash(image: Column) -> Column:
    """DCT hash of a gray image ``struct<h: int, w: int, data: binary>``: the signs of the 8 x 8 lowest frequencies against their median.

    The image is averaged down to 32 x 32 first. NULL for NULL, for an empty image, and where the data don't fit the size.
    """

    @F.pandas_udf("bigint")
    def phash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        n = 32
        k = np.arange(n)
        basis = np.cos(np.pi * np.outer(k, 2 * k + 1) / (2 * n))
        for frame in batches:
            out = []
            for h, w, data in zip(frame["h"], frame["w"], frame["data"], strict=True):
                if data is None or pd.isna(h) or pd.isna(w) or h * w == 0 or len(data) != h * w:
                    out.append(None)
                    continue
                pixels = np.frombuffer(data, np.uint8).reshape(int(h), int(w)).astype(float)
                rows, cols = np.arange(n + 1) * int(h) / n, np.arange(n + 1) * int(w) / n
                small = _area_mean(_area_mean(pixels, rows).T, cols).T
                low = (basis @ small @ basis.T)[:8, :8].ravel()
                out.append(int.from_bytes(np.packbits(low > np.median(low)).tobytes(), "big", signed=True))
            yield pd.Series(out, dtype="Int64")

    return phash(image)


def _area_mean(a: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Means of the rows of ``a`` between fractional bounds."""
    total = np.vstack([np.zeros(a.shape[1]), np.cumsum(a, 0)])
    at = np.minimum(np.floor(bounds).astype(int), len(a) - 1)
    cum = total[at] + (bounds - at)[:, None] * a[at]
    return np.diff(cum, axis=0) / np.diff(bounds)[:, None]
