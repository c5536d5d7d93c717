"""Columns of vectors as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, some component not zero, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(vector: str) -> Column:
    """A vector as one array of doubles, whatever it was stored as."""
    return F.col(vector).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, one row each."""
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    out = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    return np.maximum(out, 0.0)


def codebook(points: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from a fixed start; fewer if there are fewer points."""
    points = np.unique(points, axis=0)
    random = np.random.default_rng(11)
    centres = points[random.permutation(len(points))[:size]].copy()
    for _ in range(rounds if len(points) > len(centres) else 0):
        own = nearest(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres
