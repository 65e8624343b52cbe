import datetime as dt
from decimal import Decimal

from bazaarlens.sources.schema import RAW_SCHEMA

BASE = dict(asin="B000000001", product_name="Laptop X 1", brand="Maker1",
            price_inr=Decimal("40000.00"), original_price_inr=Decimal("50000.00"),
            discount_percent=Decimal("20.00"), rating=Decimal("4.2"), total_reviews=10,
            listing_type="Organic", search_keyword="laptops", page_scraped=1,
            scraped_at=dt.datetime(2024, 1, 1, 10, 30))


def D(x):
    return None if x is None else Decimal(str(x))


def raw_rows(spark, rows):
    """Literal raw rows: each dict overrides BASE; ids assigned in order."""
    data = []
    for i, r in enumerate(rows, start=1):
        row = dict(BASE)
        row.update(r)
        row.setdefault("id", i)
        if "id" in r:
            row["id"] = r["id"]
        else:
            row["id"] = i
        data.append(tuple(row[f.name] for f in RAW_SCHEMA.fields))
    return spark.createDataFrame(data, RAW_SCHEMA)
