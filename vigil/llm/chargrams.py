"""Character windows of whole texts as hashed bucket numbers, in numpy."""

from __future__ import annotations

import numpy as np

_FOLD = np.array([ord(chr(c).lower()) if chr(c).isalpha() and len(chr(c).lower()) == 1 else
                  (c if chr(c).isalpha() else 32) for c in range(0x250)], np.uint32)


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of concatenated UTF-8 texts and each text's range in them."""
    lead = (raw & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    bounds = np.searchsorted(at, offsets)
    first = raw[at].astype(np.uint32)
    if len(at) == len(raw):
        return first, bounds
    padded = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint32)
    follow = [padded[at + k] & 0x3F for k in (1, 2, 3)]
    two, three, four = first >= 0xC0, first >= 0xE0, first >= 0xF0
    out = np.where(two, ((first & 0x1F) << 6) | follow[0], first)
    out = np.where(three, ((first & 0x0F) << 12) | (follow[0] << 6) | follow[1], out)
    return np.where(four, ((first & 0x07) << 18) | (follow[0] << 12) | (follow[1] << 6) | follow[2], out), bounds


def fold_letters(points: np.ndarray) -> np.ndarray:
    """Lower-case letters below U+0250; everything there that is no letter becomes a space."""
    low = points < 0x250
    return np.where(low, _FOLD[np.where(low, points, 0)], points)


def gram_buckets(points: np.ndarray, bounds: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every window of ``order`` characters inside a text, and each text's range in them."""
    lengths = np.diff(bounds)
    counts = np.maximum(lengths - order + 1, 0)
    ranges = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(counts, out=ranges[1:])
    if not ranges[-1]:
        return np.zeros(0, np.int64), ranges
    n = len(points) - order + 1
    value = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        value = (value ^ points[k:k + n]) * np.uint32(0x85EBCA6B)
        value ^= value >> np.uint32(13)
    value *= np.uint32(0xC2B2AE35)
    value ^= value >> np.uint32(16)
    inside = np.zeros(len(points) + 1, np.int32)      # windows that cross into the next text go
    np.add.at(inside, bounds[:-1][counts > 0], 1)
    np.add.at(inside, (bounds[:-1] + counts)[counts > 0], -1)
    return (value[np.cumsum(inside[:n]) > 0] & np.uint32(buckets - 1)).astype(np.int64), ranges


def segment_sums(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (rows) over each consecutive range; empty ranges give 0."""
    out = np.zeros((len(ranges) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(ranges) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, ranges[full], axis=0)
    return out
