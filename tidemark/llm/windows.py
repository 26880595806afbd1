"""Exact numbers for words and for windows of consecutive words of one text."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


def word_codes(words: Iterable[bytes], n: int) -> np.ndarray:
    """One number for each different word, in the order of first occurrence."""
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(word, len(ids)) for word in words), np.int64, n)


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for each different pair; equal numbers mean equal pairs."""
    if not len(first):
        return np.zeros(0, np.int64)
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1].reshape(-1).astype(np.int64)


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """One number for each different window of ``width`` words, by its first word's place.

    Windows of a power of two are made by doubling; two of them, which overlap, cover any other.
    """
    if len(codes) < width:
        return np.zeros(0, np.int64)
    size = 1
    while 2 * size <= width:
        codes, size = paired(codes[: len(codes) - size], codes[size:]), 2 * size
    rest = width - size
    return paired(codes[: len(codes) - rest], codes[rest:]) if rest else codes
