"""Crawl order: search keywords in the order they were crawled.

The first keyword to find a product owns it, so every order-dependent step
(first-seen, page yield, preview) sorts by (keyword rank, page, position).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The search keywords, in crawl order.
KEYWORDS: list[str] = [
    "laptops",
    "gaming laptops",
    "business laptops",
    "laptops under 50000",
    "laptops under 30000",
    "student laptops",
    "ultrabook laptops",
]


def keyword_rank(keyword: Column, keywords: Sequence[str] = KEYWORDS) -> Column:
    """1-based crawl position; keywords not in the list sort after all others."""
    expr = None
    for i, kw in enumerate(keywords, start=1):
        cond = keyword == F.lit(kw)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(keywords) + 1))
