"""Resampling and hashes of pictures against loops over single pixels."""

import math

import numpy as np
import pytest

from millrace.functions import imaging as I


def kernel(x):
    x = abs(x)
    if x < 1:
        return 1.5 * x**3 - 2.5 * x**2 + 1
    return -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0


def line(values, size):
    """One row to ``size`` pixels: weights of 22 bits, sums of whole numbers."""
    n, out = len(values), []
    if n == size:
        return values
    scale = n / size
    wide = max(1, scale)
    for k in range(size):
        centre = (k + 0.5) * scale
        low, high = max(0, int(centre - 2 * wide + 0.5)), min(n, int(centre + 2 * wide + 0.5))
        w = [kernel((x - centre + 0.5) / wide) for x in range(low, high)]
        total = sum(w)
        fixed = [int(x / total * 2**22 + math.copysign(0.5, x)) for x in w]
        out.append(min(255, max(0, (sum(v * f for v, f in zip(values[low:high], fixed, strict=True)) + 2**21) >> 22)))
    return out


def small(picture, size):
    rows = [line(r, size) for r in picture]
    columns = [line(list(c), size) for c in zip(*rows, strict=True)]
    return [list(r) for r in zip(*columns, strict=True)]


@pytest.mark.parametrize("seed", range(50))
def test_hashes_of_odd_sizes(seed):
    rng = np.random.default_rng(seed)
    h, w = (int(x) for x in rng.integers(1, 90, 2))
    g = rng.integers(0, 256, (h, w), dtype=np.uint8) if seed % 3 else np.clip(np.add.outer(np.arange(h) * 3, np.arange(w) * 2) + rng.integers(0, 9, (h, w)), 0, 255).astype(np.uint8)
    eight, many = small(g.tolist(), 8), small(g.tolist(), 32)
    assert I.resized(g, 8).tolist() == eight and I.resized(g, 32).tolist() == many
    flat = sum(eight, [])
    assert I.average_hash_of(g) % 2**64 == sum(1 << i for i, p in enumerate(flat) if p >= sum(flat) / 64)
    low = np.abs(np.real(np.fft.fft2(np.array(many, float))))[:8, :8].ravel()
    assert I.perceptual_hash(g) % 2**64 == sum(1 << i for i, v in enumerate(low) if v >= np.median(low))


def test_known_values():
    assert I.resized(np.arange(64).reshape(8, 8), 8).tolist() == np.arange(64).reshape(8, 8).tolist()
    assert (I.resized(np.full((301, 77), 200, np.uint8), 8) == 200).all()
    assert I.grey(1, 2, 3, bytes([255, 0, 0, 0, 0, 255])).tolist() == [[29, 76]]
    # two pixels to four: weights at -3/4, 1/4 and so on of the kernel, cut at the edge and made to add up to one
    w = I.weights(2, 4)[0] / 2**22
    a, b = kernel(0.25), kernel(0.75)
    assert w == pytest.approx([a / (a + b), b / (a + b)]) or w[0] > w[1]
