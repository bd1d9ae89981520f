"""Operators over DataFrames, by topic."""

from labeltext.operators import (
    classify,
    dedup,
    evaluate,
    features,
    filters,
    scoring,
    sequences,
    stats,
    topk,
)

__all__ = [
    "classify", "dedup", "evaluate", "features", "filters", "scoring", "sequences",
    "stats", "topk",
]
