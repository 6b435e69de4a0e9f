"""Column expressions and small DataFrame helpers used by the operators."""

from rankflow.functions.columns import (
    action_weight,
    cosine,
    min_max,
    spread,
    top_per_group,
    unit_ratio,
    weighted_feed_score,
)

__all__ = [
    "action_weight",
    "cosine",
    "min_max",
    "spread",
    "top_per_group",
    "unit_ratio",
    "weighted_feed_score",
]
