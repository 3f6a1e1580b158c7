"""Default parameters of the operators, one place instead of a config file."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    min_user_ratings: int = 20
    min_movie_ratings: int = 5
    # Train share as a fraction of integers, so that no binary rounding moves a row.
    train_parts: int = 4
    all_parts: int = 5
    like_threshold: float = 3.5
    network_threshold: float = 4.0
    neighbours: int = 20
    top_n: int = 10
    rating_low: float = 0.5
    rating_high: float = 5.0
    max_terms: int = 5000
    min_support: float = 0.05
    min_confidence: float = 0.4
    high_mean: float = 4.0
    low_mean: float = 3.0
    eval_ks: tuple[int, ...] = (5, 10, 20)
    cold_below: int = 5
    mild_upto: int = 20
    mild_alpha: float = 0.4
    boost_score: float = 4.75
    tuning_rows: int = 2000
    # Groups above this many rows are ranked by range partitioning instead of one window task.
    hot_group_rows: int = 2_000_000


DEFAULTS = Params()
