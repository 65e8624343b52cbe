"""Bucketing expressions: price segment, discount tier, rating category.

Thresholds are parameters; the defaults are the reference's values. Each
builder returns one ``Column`` so a whole cleaning step is a single
``select`` (narrow, codegen'd).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price segments as inclusive [low, high] bounds in rupees;
# None = open end. Values between one arm's high and the next arm's low
# (e.g. 50000.50) match no arm and get a NULL segment.
PRICE_SEGMENTS: list[tuple[float | None, float | None, str, bool]] = [
    # (low, high, label, high_is_strict)
    (None, 30000, "Budget (Under 30K)", True),
    (30000, 50000, "Mid-Range (30K-50K)", False),
    (50001, 80000, "Premium (50K-80K)", False),
    (80001, 120000, "High-End (80K-1.2L)", False),
    (120000, None, "Ultra-Premium (Above 1.2L)", True),
]

# Discount tiers on the scraped discount; upper bounds strict.
NO_DISCOUNT = "No Discount"
DISCOUNT_TIERS: list[tuple[float, str]] = [
    (10, "Low (Under 10%)"),
    (25, "Moderate (10-24%)"),
    (40, "High (25-39%)"),
]
TOP_DISCOUNT_TIER = "Mega Deal (40%+)"

# Rating categories on the scraped rating; lower bounds inclusive.
NOT_RATED = "Not Rated"
RATING_CATEGORIES: list[tuple[float, str]] = [
    (4.5, "Excellent (4.5+)"),
    (4.0, "Good (4.0-4.4)"),
    (3.5, "Average (3.5-3.9)"),
]
LOWEST_RATING_CATEGORY = "Below Average"


def _chain(arms: Sequence[tuple[Column, str]], default: str | None) -> Column:
    expr = None
    for cond, label in arms:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr if default is None else expr.otherwise(F.lit(default))


def price_segment(price: Column, segments=PRICE_SEGMENTS) -> Column:
    arms = []
    for low, high, label, strict in segments:
        if low is None:
            cond = price < high if strict else price <= high
        elif high is None:
            cond = price > low if strict else price >= low
        else:
            cond = price.between(low, high)
        arms.append((cond, label))
    return _chain(arms, None)


def discount_tier(discount: Column, tiers=DISCOUNT_TIERS) -> Column:
    arms = [(discount.isNull(), NO_DISCOUNT)]
    arms += [(discount < bound, label) for bound, label in tiers]
    return _chain(arms, TOP_DISCOUNT_TIER)


def rating_category(rating: Column, categories=RATING_CATEGORIES) -> Column:
    arms = [(rating.isNull(), NOT_RATED)]
    arms += [(rating >= bound, label) for bound, label in categories]
    return _chain(arms, LOWEST_RATING_CATEGORY)
