"""Integer vectors and their exact inner products."""

from __future__ import annotations

import numpy as np

#: Products beyond it are held at plus or minus this.
MOST = np.iinfo(np.int64).max


def integers(flat: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of finite x: 64-bit integers, or Python integers where one is beyond them."""
    with np.errstate(over="ignore"):
        value = np.floor(scale * flat)
    if np.all(np.abs(value) < 2.0**62):
        return value.astype(np.int64)
    # scale is a power of two, so the product of a finite double that overflows is exact in integers.
    return np.array([int(v) if np.isfinite(v) else int(x) * int(scale) for v, x in zip(value.tolist(), flat.tolist())], dtype=object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all rows of b, held within 64 bits."""
    if a.dtype != object and b.dtype != object:
        most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        if most < 2.0**53:
            return (a.astype(float) @ b.astype(float).T).astype(np.int64)
        if most < 2.0**62:
            return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)
