"""Keep-first duplicate removal and sorted output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str] | str, order: str) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order``, which identifies rows.

    The smallest ``order`` is found per digest of the keys: one fixed-width value
    per key, so a hash aggregate, in which copies collapse before the shuffle. A
    semi join on ``order``, which has no hot values, then picks the rows. Nulls
    are equal to each other and to nothing else.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.coalesce(F.sha2(F.col(k).cast("string"), 256), F.lit("-")) for k in keys]
    digest = F.unhex(F.sha2(F.concat(*parts), 256))
    first = df.groupBy(digest.alias("_key")).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi").select(*df.columns)


def sort_by_text(df: DataFrame, text: str = "posts") -> DataFrame:
    """Global sort: range partitions, each sorted."""
    return df.orderBy(text)
