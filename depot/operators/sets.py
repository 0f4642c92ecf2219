"""Set operators (G ops)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a frame becomes null (G1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_chunks(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate same-schema chunks (G2); a schema mismatch is an error."""
    return reduce(lambda a, b: a.unionByName(b), frames)
