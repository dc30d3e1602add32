"""Decoded pictures: any number of components to RGB, smaller copies, and both as PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def png(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((h, 1), np.uint8), rgb.reshape(h, 3 * w)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes(), 6)) + part(b"IEND", b"")


def as_rgb(pixels: bytes, width: int, components: int) -> np.ndarray:
    """1: grey, 2: grey and alpha, 3: RGB, 4 and more: CMYK and spot colours, of which the first four count."""
    a = np.frombuffer(pixels, np.uint8).reshape(-1, width, components)
    if components < 3:
        return np.repeat(a[:, :, :1], 3, axis=2)
    if components == 3:
        return a
    ink = 255 - a[:, :, :4].astype(np.int32)
    return (ink[:, :, :3] * ink[:, :, 3:4] // 255).astype(np.uint8)


def smaller(rgb: np.ndarray, longest: int) -> np.ndarray:
    """The picture with its longest side at most so many pixels, each the mean of those it stands for."""
    h, w, _ = rgb.shape
    if max(h, w) <= longest:
        return rgb
    to_h, to_w = max(1, h * longest // max(h, w)), max(1, w * longest // max(h, w))
    sums = np.zeros((h + 1, w + 1, 3), np.int64)
    sums[1:, 1:] = rgb.astype(np.int64).cumsum(axis=0).cumsum(axis=1)
    y, x = np.arange(to_h + 1) * h // to_h, np.arange(to_w + 1) * w // to_w
    total = sums[y[1:]][:, x[1:]] - sums[y[:-1]][:, x[1:]] - sums[y[1:]][:, x[:-1]] + sums[y[:-1]][:, x[:-1]]
    return (total // (np.diff(y)[:, None] * np.diff(x)[None, :])[:, :, None]).astype(np.uint8)


@F.pandas_udf(BinaryType())
def _pngs(pixels: pd.Series, width: pd.Series, components: pd.Series, longest: pd.Series) -> pd.Series:
    def one(p: bytes | None, w: int, c: int, most: int) -> bytes | None:
        if not p or w < 1 or c < 1 or len(p) % (w * c):
            return None
        rgb = as_rgb(p, w, c)
        return png(smaller(rgb, most) if most else rgb)

    return pd.Series([one(*row) for row in zip(pixels, width, components, longest)])


def normalised(pixels: Column, width: Column, components: Column) -> Column:
    """An RGB PNG of decoded pixels; null for what is no whole picture."""
    return _pngs(pixels, width, components, F.lit(0))


def thumbnail(pixels: Column, width: Column, components: Column, longest: int = 512) -> Column:
    return _pngs(pixels, width, components, F.lit(longest))
