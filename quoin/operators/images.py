"""Image features on pixels held as arrays: hashes, histograms, symbolic codes. Decoding files is left to the caller."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def average_hash(pixels: Column) -> Column:
    """Long of which bit i is set where pixel i is at least the mean of the first 64; null for fewer pixels."""
    p = F.slice(pixels.cast("array<double>"), 1, 64)
    mean = F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / F.size(p)
    bit = F.transform(p, lambda x, i: F.when(x >= mean, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(p) == 64, F.aggregate(bit, F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(b)))


def otsu_threshold(p: np.ndarray) -> int:
    """Grey level that parts the pixels best: the largest weighted squared distance of both means; the later of equals."""
    h = np.bincount(p, minlength=256).astype(float)
    n, s = h.cumsum(), (h * np.arange(256)).cumsum()
    mean = s[-1] / (n[-1] + 0.1)
    low, high = s / (n + 0.1), (s[-1] - s) / (n[-1] - n + 0.1)
    between = n * (low - mean) ** 2 + (n[-1] - n) * (high - mean) ** 2
    return int(np.flatnonzero(between == between.max())[-1])


@F.pandas_udf(T.LongType())
def otsu_hash(small: pd.Series, whole: pd.Series) -> pd.Series:
    """Bits of an image's 8 x 8 form above the Otsu threshold of all its grey pixels; null for fewer than 64 or no pixels."""

    def one(v, w):
        if v is None or w is None or len(v) < 64 or not len(w):
            return None
        p, q = (np.clip(np.asarray(x, int), 0, 255) for x in (v[:64], w))
        return _as_long(p > otsu_threshold(q))

    return pd.Series([one(v, w) for v, w in zip(small, whole)], dtype="Int64")


def _as_long(bits: np.ndarray) -> int:
    return int((bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64).astype(np.int64))


@F.pandas_udf(T.LongType())
def otsu_hash_centred(small: pd.Series, whole: pd.Series) -> pd.Series:
    """otsu_hash whose set bits are the side of the threshold that lies nearer the middle; all on one side counts as set."""
    y, x = np.divmod(np.arange(64), 8)
    radius = np.hypot(y - 3.5, x - 3.5)

    def one(v, w):
        if v is None or w is None or len(v) < 64 or not len(w):
            return None
        p, q = (np.clip(np.asarray(a, int), 0, 255) for a in (v[:64], w))
        up = p > otsu_threshold(q)
        if up.any() and not up.all() and radius[up].mean() > radius[~up].mean():
            up = ~up
        return _as_long(up)

    return pd.Series([one(v, w) for v, w in zip(small, whole)], dtype="Int64")


def gradient_histograms(gray: np.ndarray, orientations: int = 9, cells: int = 9, block: int = 2) -> np.ndarray:
    """Histograms of oriented gradients: magnitudes by direction per cell, normalised over blocks of cells, as one vector."""
    g = np.sqrt(np.asarray(gray, float))
    dy, dx = np.zeros_like(g), np.zeros_like(g)
    dy[1:-1], dx[:, 1:-1] = g[2:] - g[:-2], g[:, 2:] - g[:, :-2]
    size, way = np.hypot(dx, dy), np.rad2deg(np.arctan2(dy, dx)) % 180
    h, w = g.shape[0] // cells * cells, g.shape[1] // cells * cells
    if not h or not w:
        return np.zeros(0)
    at = np.minimum(way[:h, :w] * orientations / 180, orientations - 1).astype(int)
    row, col = np.arange(h) * cells // h, np.arange(w) * cells // w
    flat = (row[:, None] * cells + col[None, :]) * orientations + at
    hist = np.bincount(flat.ravel(), size[:h, :w].ravel(), cells * cells * orientations).reshape(cells, cells, orientations)
    out = [hist[i : i + block, j : j + block].ravel() for i in range(cells - block + 1) for j in range(cells - block + 1)]
    return np.concatenate([v / np.sqrt((v * v).sum() + 1e-5) for v in out])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def hog(gray: pd.Series, width: pd.Series) -> pd.Series:
    """gradient_histograms of grey pixels held row by row, images ``width`` wide; null for null or ragged ones."""
    return pd.Series([None if v is None or not w or len(v) % w else gradient_histograms(np.asarray(v).reshape(-1, int(w))) for v, w in zip(gray, width)], dtype=object)


def binned(df, owner: str, column: str, bin_of):
    """(owner, bin, share): shares of an image's pixels per bin that holds any; one pass, an image without pixels has no row."""
    each = df.select(owner, F.size(column).alias("n"), F.explode(column).alias("x")).groupBy(owner, bin_of(F.col("x")).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    return each.select(owner, "bin", (F.col("c") / F.col("n")).alias("share"))


def _joint(x: Column, y: Column, z: Column, size: int) -> Column:
    per = 256 // size
    return F.floor(x / size) * per * per + F.floor(y / size) * per + F.floor(z / size)


def rgb_bin(p: Column, size: int = 32) -> Column:
    """Joint bin of a pixel struct<r, g, b>: one of (256 / size)^3."""
    return _joint(p["r"], p["g"], p["b"], size)


def yuv(p: Column) -> tuple[Column, Column, Column]:
    """Luma and the two colour differences of a pixel, each cut to 0 to 255."""
    byte = lambda c: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(c))).cast("int")
    y = 0.299 * p["r"] + 0.587 * p["g"] + 0.114 * p["b"]
    return byte(y), byte((p["b"] - y) * 0.492 + 128), byte((p["r"] - y) * 0.877 + 128)


def yuv_bin(p: Column, size: int = 32) -> Column:
    return _joint(*yuv(p), size)


def hls(p: Column) -> tuple[Column, Column, Column]:
    """Hue, lightness and saturation of a pixel, each scaled to 0 to 255."""
    r, g, b = (p[c] / 255.0 for c in "rgb")
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    light, span = (high + low) / 2, high - low
    sat = F.when(span == 0, 0.0).when(light <= 0.5, span / (high + low)).otherwise(span / (2.0 - high - low))
    part = lambda c: (high - c) / span
    hue = F.when(span == 0, 0.0).when(r == high, part(b) - part(g)).when(g == high, 2.0 + part(r) - part(b)).otherwise(4.0 + part(g) - part(r)) / 6.0
    return tuple(F.floor(F.pmod(c, F.lit(1.0)) * 255 if c is hue else c * 255).cast("int") for c in (hue, light, sat))


def hls_bin(p: Column, size: int = 32) -> Column:
    return _joint(*hls(p), size)


def symbol_code(vec: Column, top: int = 5, least: float = 0.02, steps: int = 50) -> Column:
    """Code of the largest elements above ``least``: two digits of the place and two of the value in steps, one after the other."""
    ranked = F.array_sort(F.transform(vec.cast("array<double>"), lambda x, i: F.struct((-x).alias("x"), i.alias("i"))))
    kept = F.slice(F.filter(ranked, lambda s: -s["x"] > least), 1, top)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.array_join(F.transform(kept, lambda s: F.concat(two(s["i"]), two(F.floor(-s["x"] * steps)))), "")
