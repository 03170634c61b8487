"""Keep-one-per-key de-duplication as an aggregation.

A ``row_number() over (partition by key order by ...)`` sends every copy of
a key to one task; a minimum over an ordered struct is combined map-side
first, so a key with millions of copies costs one row per map partition in
the shuffle.  Struct ordering is lexicographic with NULL lowest, which is
the NULLS-FIRST ascending order of the original ``ORDER BY usage_date``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str], descending: bool = False) -> DataFrame:
    """One row per ``key``: the row with the smallest (largest if ``descending``)
    ``order`` tuple; the remaining columns break ties in their column order so
    the pick is deterministic."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest]).alias("_pick")
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_pick"))
    return out.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in df.columns if c not in keys]).select(*df.columns)


def dedup_usage(staging: DataFrame) -> DataFrame:
    """Feature usage: earliest ``usage_date`` wins per ``usage_id``."""
    return keep_first(staging, "usage_id", ["usage_date"])
