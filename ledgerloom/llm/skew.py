"""Joins whose hot keys are known to be few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if more than one row in so many has it; so there are at most so many hot keys.
SHARE = 1000


def join_by_weight(rows: DataFrame, values: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined (inner) with ``values``, which has one row a key.

    ``weight`` is at least the number of ``rows`` with the key, and all weights
    together are ``total`` at most.  Keys with more than ``total / SHARE`` of it
    are at most ``SHARE`` rows, so they are broadcast whatever the size of the
    tables; the others are shuffled, and none of them is hot.  ``rows`` should be
    a written table: it is read twice.
    """
    heavy = F.col(weight) * F.lit(SHARE) > F.lit(total)
    hot, rest = values.where(heavy).drop(weight), values.where(~heavy).drop(weight)
    return rows.join(F.broadcast(hot), list(keys)).unionByName(rows.join(rest, list(keys)))
