"""Top-k groups with an exact distinct count, without shuffling every pair.

``COUNT(DISTINCT session_id)`` per group makes Spark shuffle every distinct
(group, session) pair, close to the whole input.  When the top-k order does
not involve the distinct count (top products by views), the k groups are
picked first from a plain aggregate, which is partially aggregated per task, and sessions are counted
only over the events of those k groups, keyed by nothing but the group's own columns.  The joins are plain
joins: Spark chooses their form by size, the same plan for every k.  The events are
scanned twice, pruned to the columns each step needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` in ``left`` and ``prefix + key`` in ``right``."""
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def top_k_with_distinct(events: DataFrame, keys: list[str], aggs: list[Column],
                        order: list[Column], k: int, distinct: str,
                        distinct_name: str, columns: list[str]) -> DataFrame:
    """The ``k`` first groups of ``events.groupBy(keys).agg(aggs)`` by ``order``,
    with ``count_distinct(distinct)`` of each as ``distinct_name``; output
    ``columns`` in that order, sorted by ``order``.  ``events`` must already
    hold the key columns; ``order`` may not use ``distinct_name``."""
    top = events.groupBy(*keys).agg(*aggs).orderBy(*order).limit(k)
    picked = top.select(*[F.col(c).alias(f"_top_{c}") for c in keys])
    rows = events.select(*keys, distinct)
    counted = (rows.join(picked, _same(rows, picked, keys, "_top_"), "left_semi")
               .groupBy(*[F.col(c).alias(f"_count_{c}") for c in keys])
               .agg(F.count_distinct(distinct).alias(distinct_name)))
    return (top.join(counted, _same(top, counted, keys, "_count_"))
            .select(*columns).orderBy(*order))
