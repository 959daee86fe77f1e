"""Vectors as rows of packed bytes, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np


def usable(values) -> np.ndarray | None:
    """A vector in double precision, or nothing when it is null or holds null or non-finite components."""
    if values is None:
        return None
    vector = np.array(values, dtype=np.float64)
    if vector.size == 0 or not np.isfinite(vector).all():
        return None
    return vector
