"""Every tunable of the library, with its default."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from types import MappingProxyType

# Weights, lengths and dates that results depend on.
DEFAULT_ACTION_WEIGHTS = {"view": 1, "like": 3, "comment": 4, "share": 5}
DEFAULT_INTERACTION_WEIGHT = 0.5
DEFAULT_POPULARITY_WEIGHT = 0.3
DEFAULT_RECENCY_WEIGHT = 0.2
DEFAULT_FEED_LENGTH = 10
DEFAULT_NEIGHBOURS = 10
DEFAULT_RECOMMENDED_BASE_SCORE = 0.5
DEFAULT_RECENCY_DATE = date(2025, 12, 31)
DEFAULT_DECIMALS = 4
DEFAULT_TRENDING_LENGTH = 20


@dataclass(frozen=True)
class FeedConfig:
    """Parameters shared by the jobs in :mod:`rankflow.plans`.

    ``heavy_post_users`` and ``block_users`` steer only how work is split, never
    the result, whatever the signs and types of the scores: posts touched by more users than ``heavy_post_users`` leave the
    post-by-post self-join and are compared in blocks of ``block_users`` users.
    """

    action_weights: Mapping[str, int] = field(
        default_factory=lambda: MappingProxyType(DEFAULT_ACTION_WEIGHTS)
    )
    like_action: str = "like"
    interaction_weight: float = DEFAULT_INTERACTION_WEIGHT
    popularity_weight: float = DEFAULT_POPULARITY_WEIGHT
    recency_weight: float = DEFAULT_RECENCY_WEIGHT
    feed_length: int = DEFAULT_FEED_LENGTH
    neighbours: int = DEFAULT_NEIGHBOURS
    recommended_base_score: float = DEFAULT_RECOMMENDED_BASE_SCORE
    recency_date: date = DEFAULT_RECENCY_DATE
    decimals: int = DEFAULT_DECIMALS
    trending_length: int = DEFAULT_TRENDING_LENGTH
    heavy_post_users: int = 500
    block_users: int = 2048

    def but(self, **changes) -> FeedConfig:
        """A copy with some fields replaced."""
        return replace(self, **changes)
