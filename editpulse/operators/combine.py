"""Combining many frames of the same shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, pairwise, so that no part is analysed again for every part after it."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0]
