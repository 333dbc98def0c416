"""Pixel kernels: hashes and sharpness of grey images.

Small matrices (as arrays) are handled by built-in expressions. Whole pictures,
as Spark's ``image`` source reads them, go through one Arrow UDF that decodes a
row once and gives all features together, so that later thresholds are filters
on a narrow table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

lit = F.lit


# built-in expressions over arrays of double


def bits(values: Column, limit: Column) -> Column:
    """A 64-bit number (as signed long) with bit i set where value i of 64 is ``limit`` or more.

    Unrolled, so that it is compiled; the limit is one common subexpression.
    """
    one = [F.when(values[i] >= limit, F.lit(1 << i if i < 63 else -(2**63)).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(64)]
    return reduce(lambda a, b: a.bitwiseOR(b), one)


def mean(values: Column) -> Column:
    return F.aggregate(values, lit(0.0), lambda a, x: a + x) / F.size(values)


def median(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    return (s[F.floor((n - 1) / 2).cast("int")] + s[F.floor(n / 2).cast("int")]) / 2


def average_hash(values: Column) -> Column:
    return bits(values, mean(values))


def median_hash(values: Column) -> Column:
    """The hash of a block of low frequencies: bits of what is at or above the median."""
    return bits(values, median(values))


def _windows(values: Column, width: int, height: int, kernel) -> Column:
    """A value for each inner pixel of a row-major matrix."""
    inner = F.filter(F.sequence(lit(0), lit(width * height - 1)), lambda i: (i % width).between(1, width - 2) & F.floor(i / width).between(1, height - 2))
    return F.transform(inner, lambda i: kernel(lambda dy, dx: values[i + dy * width + dx]))


def laplacian_variance(values: Column, width: int, height: int) -> Column:
    """Population variance of the 4-neighbour Laplacian."""
    v = _windows(values, width, height, lambda p: p(-1, 0) + p(1, 0) + p(0, -1) + p(0, 1) - 4 * p(0, 0))
    return F.transform(F.array(v), lambda a: mean(F.transform(a, lambda x: x * x)) - mean(a) * mean(a))[0]


def tenengrad(values: Column, width: int, height: int) -> Column:
    """Mean squared Sobel gradient."""

    def g2(p):
        gx = p(-1, 1) + 2 * p(0, 1) + p(1, 1) - p(-1, -1) - 2 * p(0, -1) - p(1, -1)
        gy = p(1, -1) + 2 * p(1, 0) + p(1, 1) - p(-1, -1) - 2 * p(-1, 0) - p(-1, 1)
        return gx * gx + gy * gy

    return mean(_windows(values, width, height, g2))


# whole pictures


def grey(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """ITU-R 601-2 luma of BGR(A) or grey bytes, in whole numbers: weights of 16 bits, rounded."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return a[:, :, 0]
    blue, green, red = (a[:, :, k].astype(np.uint32) for k in range(3))
    return ((red * 19595 + green * 38470 + blue * 7471 + 0x8000) >> 16).astype(np.uint8)


#: Bits of a resampling weight behind the point.
WEIGHT_BITS = 22


def cubic(x: np.ndarray) -> np.ndarray:
    """The cubic convolution kernel with a slope of -1/2 at one."""
    x = np.abs(x)
    near = (1.5 * x - 2.5) * x * x + 1
    far = ((-0.5 * x + 2.5) * x - 4) * x + 2
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


@lru_cache(maxsize=512)
def weights(old: int, new: int) -> np.ndarray:
    """A row for each of ``new`` pixels with the weights of the ``old`` ones: whole numbers of WEIGHT_BITS bits.

    Where the picture gets smaller the kernel is as much wider, so that every
    pixel counts; a row's weights add up to one before they are rounded.
    """
    scale = old / new
    wide = max(scale, 1.0)
    centre = (np.arange(new) + 0.5) * scale
    first = np.maximum((centre - 2 * wide + 0.5).astype(int), 0)
    last = np.minimum((centre + 2 * wide + 0.5).astype(int), old)
    at = np.arange(old)
    inside = (at >= first[:, None]) & (at < last[:, None])
    w = np.where(inside, cubic((at - centre[:, None] + 0.5) / wide), 0.0)
    w = w / w.sum(axis=1, keepdims=True) * (1 << WEIGHT_BITS)
    return np.trunc(w + np.copysign(0.5, w))


def _across(g: np.ndarray, size: int) -> np.ndarray:
    """Rows of whole numbers resampled to ``size`` pixels, rounded and cut to a byte. Products are exact in doubles."""
    if g.shape[1] == size:
        return g
    total = g.astype(np.float64) @ weights(g.shape[1], size).T
    return np.clip(np.floor((total + (1 << WEIGHT_BITS - 1)) / (1 << WEIGHT_BITS)), 0, 255)


def resized(g: np.ndarray, size: int) -> np.ndarray:
    """``size`` x ``size`` pixels of a picture of bytes: cubic, first along rows, then along columns."""
    return _across(_across(g, size).T, size).T


def _pack(on: np.ndarray) -> int:
    return int(np.packbits(on.ravel(), bitorder="little").view("<i8")[0])


def perceptual_hash(g: np.ndarray) -> int:
    """Bits of the absolute real parts of the 8 x 8 lowest frequencies (of 32 x 32 pixels) at or above their median."""
    return _low_hash(resized(g, 32))


def average_hash_of(g: np.ndarray) -> int:
    """Bits of the pixels of 8 x 8 at or above their mean."""
    small = resized(g, 8)
    return _pack(small >= small.mean())


def _low_hash(g: np.ndarray) -> int:
    low = np.abs(np.real(np.fft.fft2(g)))[:8, :8]
    return _pack(low >= np.median(low))


@F.pandas_udf(T.LongType())
def frequency_hash(pixels: pd.Series) -> pd.Series:
    """:func:`perceptual_hash` of pictures that are 32 x 32 already (1024 numbers, row by row)."""
    return pixels.map(lambda p: None if p is None else _low_hash(np.asarray(p, dtype=np.float64).reshape(32, 32))).astype("Int64")


def resized_hash(pixels: Column, width: int) -> Column:
    """:func:`average_hash_of` a grey picture given as bytes (whole numbers, row by row) of rows of ``width``."""

    @F.pandas_udf(T.LongType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda p: None if p is None or not len(p) else average_hash_of(np.asarray(p, dtype=np.float64).reshape(-1, width))).astype("Int64")

    return run(pixels)


def sharpness(g: np.ndarray) -> tuple[float, float]:
    """Laplacian variance and mean squared Sobel gradient; zero below 3 x 3 pixels."""
    if min(g.shape) < 3:
        return 0.0, 0.0
    g = g.astype(np.float64)
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    right, left = g[:, 2:], g[:, :-2]
    gx = (right - left)[:-2] + 2 * (right - left)[1:-1] + (right - left)[2:]
    down, up = g[2:], g[:-2]
    gy = (down - up)[:, :-2] + 2 * (down - up)[:, 1:-1] + (down - up)[:, 2:]
    return float(lap.var()), float((gx * gx + gy * gy).mean())


FEATURES = T.StructType([T.StructField("laplacian", T.DoubleType()), T.StructField("tenengrad", T.DoubleType()), T.StructField("average_hash", T.LongType()), T.StructField("perceptual_hash", T.LongType())])


@F.pandas_udf(FEATURES)
def features(images: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features of the ``image`` struct; all null for what couldn't be decoded."""
    for batch in images:
        out = []
        for h, w, c, data in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"], strict=True):
            if h is None or h <= 0 or not data:
                out.append((None, None, None, None))
                continue
            g = grey(int(h), int(w), int(c), data)
            out.append((*sharpness(g), average_hash_of(g), perceptual_hash(g)))
        yield pd.DataFrame(out, columns=["laplacian", "tenengrad", "average_hash", "perceptual_hash"]).astype({"average_hash": "Int64", "perceptual_hash": "Int64"})
