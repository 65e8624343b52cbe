"""Brand standardisation as one ordered ``CASE`` expression.

Rules are data: an ordered list of (column, needle, brand); the first match
wins. They compile to a single chained ``when`` that stays inside
whole-stage codegen: no join against a rule table, no UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The brand rules, in priority order. "name" tests
# upper(product_name), "brand" tests upper(brand); both are substring tests.
BRAND_RULES: list[tuple[str, str, str]] = [
    ("name", "MACBOOK", "Apple"),
    ("name", "THINKPAD", "Lenovo"),
    ("name", "IDEAPAD", "Lenovo"),
    ("name", "INSPIRON", "Dell"),
    ("name", "PAVILION", "HP"),
    ("name", "ELITEBOOK", "HP"),
    ("name", "VIVOBOOK", "ASUS"),
    ("name", "ZENBOOK", "ASUS"),
    ("brand", "LENOVO", "Lenovo"),
    ("brand", "HP", "HP"),
    ("brand", "DELL", "Dell"),
    ("brand", "ASUS", "ASUS"),
    ("brand", "ACER", "Acer"),
    ("brand", "APPLE", "Apple"),
    ("brand", "MSI", "MSI"),
    ("brand", "SAMSUNG", "Samsung"),
    ("brand", "MICROSOFT", "Microsoft"),
    ("brand", "ALIENWARE", "Alienware"),
    ("brand", "AVITA", "Avita"),
]
# A raw brand starting with a digit is not a brand.
NUMERIC_BRAND_PATTERN = "^[0-9]"
NUMERIC_BRAND_LABEL = "Other"


def standard_brand(name: Column, brand: Column,
                   rules: Sequence[tuple[str, str, str]] = BRAND_RULES) -> Column:
    """First matching rule's brand, else 'Other' for numeric, else trimmed brand.

    The numeric test looks at the untrimmed brand; the fallback trims it.
    NULL brand with no name match stays NULL.
    """
    targets = {"name": F.upper(name), "brand": F.upper(brand)}
    expr = None
    for column, needle, label in rules:
        cond = targets[column].contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    numeric = brand.rlike(NUMERIC_BRAND_PATTERN)
    expr = F.when(numeric, F.lit(NUMERIC_BRAND_LABEL)) if expr is None \
        else expr.when(numeric, F.lit(NUMERIC_BRAND_LABEL))
    return expr.otherwise(F.trim(brand))
