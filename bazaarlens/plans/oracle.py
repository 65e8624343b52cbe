"""Reference SQL for every registered query, runnable by DuckDB.

The driver registers the Parquet tables as views (``orders`` etc.); each
statement rebuilds ``laptops_raw`` and ``laptops_cleaned`` as CTEs and then
asks its question. Rounding is made exact on this side too: DuckDB divides
decimals in floating point, so averages and shares are spelled out as
integer half-up arithmetic (decimal AVG keeps scale + 4 digits, then ROUND),
matching Spark's decimal semantics bit for bit.
"""

from __future__ import annotations

from bazaarlens.sources.tables import raw_from_orders_sql

# The reference's rules, written out here and not taken from the
# code under test. (The listing rows themselves come from the fixture recipe.)
PRICE_LOW, PRICE_HIGH = 5000, 500000

BRAND_SQL = """CASE
  WHEN upper(product_name) LIKE '%MACBOOK%' THEN 'Apple'
  WHEN upper(product_name) LIKE '%THINKPAD%' THEN 'Lenovo'
  WHEN upper(product_name) LIKE '%IDEAPAD%' THEN 'Lenovo'
  WHEN upper(product_name) LIKE '%INSPIRON%' THEN 'Dell'
  WHEN upper(product_name) LIKE '%PAVILION%' THEN 'HP'
  WHEN upper(product_name) LIKE '%ELITEBOOK%' THEN 'HP'
  WHEN upper(product_name) LIKE '%VIVOBOOK%' THEN 'ASUS'
  WHEN upper(product_name) LIKE '%ZENBOOK%' THEN 'ASUS'
  WHEN upper(brand) LIKE '%LENOVO%' THEN 'Lenovo'
  WHEN upper(brand) LIKE '%HP%' THEN 'HP'
  WHEN upper(brand) LIKE '%DELL%' THEN 'Dell'
  WHEN upper(brand) LIKE '%ASUS%' THEN 'ASUS'
  WHEN upper(brand) LIKE '%ACER%' THEN 'Acer'
  WHEN upper(brand) LIKE '%APPLE%' THEN 'Apple'
  WHEN upper(brand) LIKE '%MSI%' THEN 'MSI'
  WHEN upper(brand) LIKE '%SAMSUNG%' THEN 'Samsung'
  WHEN upper(brand) LIKE '%MICROSOFT%' THEN 'Microsoft'
  WHEN upper(brand) LIKE '%ALIENWARE%' THEN 'Alienware'
  WHEN upper(brand) LIKE '%AVITA%' THEN 'Avita'
  WHEN regexp_matches(brand, '^[0-9]') THEN 'Other'
  ELSE trim(brand) END"""

SEGMENT_SQL = """CASE WHEN price_inr < 30000 THEN 'Budget (Under 30K)'
  WHEN price_inr BETWEEN 30000 AND 50000 THEN 'Mid-Range (30K-50K)'
  WHEN price_inr BETWEEN 50001 AND 80000 THEN 'Premium (50K-80K)'
  WHEN price_inr BETWEEN 80001 AND 120000 THEN 'High-End (80K-1.2L)'
  WHEN price_inr > 120000 THEN 'Ultra-Premium (Above 1.2L)' END"""

TIER_SQL = """CASE WHEN discount_percent IS NULL THEN 'No Discount'
  WHEN discount_percent < 10 THEN 'Low (Under 10%)'
  WHEN discount_percent < 25 THEN 'Moderate (10-24%)'
  WHEN discount_percent < 40 THEN 'High (25-39%)' ELSE 'Mega Deal (40%+)' END"""

CATEGORY_SQL = """CASE WHEN rating IS NULL THEN 'Not Rated'
  WHEN rating >= 4.5 THEN 'Excellent (4.5+)' WHEN rating >= 4.0 THEN 'Good (4.0-4.4)'
  WHEN rating >= 3.5 THEN 'Average (3.5-3.9)' ELSE 'Below Average' END"""

KR = """CASE search_keyword WHEN 'laptops' THEN 1 WHEN 'gaming laptops' THEN 2
  WHEN 'business laptops' THEN 3 WHEN 'laptops under 50000' THEN 4
  WHEN 'laptops under 30000' THEN 5 WHEN 'student laptops' THEN 6
  WHEN 'ultrabook laptops' THEN 7 ELSE 8 END"""

_DONE = "'laptops', 'gaming laptops', 'business laptops'"   # finished before the resume


def _half_up(num: str, den: str) -> str:
    """round(num / den) half-up for num >= 0, den > 0, in integers."""
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


def avg_sql(col: str, scale: int, digits: int) -> str:
    """round(avg(decimal col with `scale`), digits) as DOUBLE, exactly."""
    n = f"NULLIF(COUNT({col}), 0)"
    total = f"CAST(SUM({col}) * {10 ** scale} AS HUGEINT)"
    at_scale4 = _half_up(f"{total} * 10000", n)
    step = 10 ** (scale + 4 - digits)
    return f"(CAST({_half_up(at_scale4, str(step))} AS DOUBLE) / {10 ** digits})"


def avg0_sql(col: str, scale: int, digits: int) -> str:
    return f"COALESCE({avg_sql(col, scale, digits)}, 0.0)"


def share_sql(part: str, whole: str, digits: int) -> str:
    """round(part * 100 / whole, digits) as DOUBLE, exactly (integer counts)."""
    q = _half_up(f"CAST({part} AS HUGEINT) * {100 * 10 ** digits}", f"NULLIF({whole}, 0)")
    return f"(CAST({q} AS DOUBLE) / {10 ** digits})"


def cnt_if(cond: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def _discount_sql() -> str:
    mrp = "CAST(original_price_inr * 100 AS BIGINT)"
    price = "CAST(price_inr * 100 AS BIGINT)"
    tenths = _half_up(f"({mrp} - {price}) * 1000", mrp)
    return f"CAST(CAST({tenths} AS DECIMAL(18,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(5,1))"


def cleaned_sql(source: str) -> str:
    """The cleaning projection over any raw-shaped relation."""
    return f"""SELECT id, asin, trim(product_name) AS product_name,
  {BRAND_SQL} AS brand,
  price_inr, original_price_inr,
  CASE WHEN original_price_inr > price_inr THEN {_discount_sql()} END AS discount_percent,
  CASE WHEN original_price_inr > price_inr
       THEN CAST(original_price_inr - price_inr AS DECIMAL(11,2)) END AS savings_inr,
  CASE WHEN rating > 0 AND rating <= 5 THEN rating END AS rating,
  COALESCE(total_reviews, 0) AS total_reviews,
  {SEGMENT_SQL} AS price_segment,
  {TIER_SQL} AS discount_tier,
  {CATEGORY_SQL} AS rating_category,
  listing_type, search_keyword, scraped_at
FROM {source}
WHERE price_inr IS NOT NULL AND price_inr > {PRICE_LOW} AND price_inr < {PRICE_HIGH}
  AND product_name IS NOT NULL"""


CLEANED_SQL = cleaned_sql("laptops_raw")

FIRST_SEEN_SQL = f"""SELECT * EXCLUDE (_rn, _kr) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY asin ORDER BY _kr, page_scraped, id) AS _rn
  FROM (SELECT *, {KR} AS _kr FROM laptops_raw)) WHERE _rn = 1"""

RAW_COLS = ("id, asin, product_name, brand, price_inr, original_price_inr, discount_percent, "
            "rating, total_reviews, listing_type, search_keyword, page_scraped, scraped_at")

MART_SQL = {
    "vw_brand_performance": f"""SELECT brand, COUNT(*) AS total_products,
  {avg_sql('price_inr', 2, 0)} AS avg_price,
  {avg0_sql('rating', 1, 2)} AS avg_rating,
  {avg0_sql('discount_percent', 1, 1)} AS avg_discount,
  {avg0_sql('savings_inr', 2, 0)} AS avg_savings
FROM laptops_cleaned WHERE brand != 'Other' GROUP BY brand""",
    "vw_price_segments": f"""SELECT price_segment, COUNT(*) AS total_products,
  {avg_sql('price_inr', 2, 0)} AS avg_price,
  {avg_sql('rating', 1, 2)} AS avg_rating,
  {avg_sql('discount_percent', 1, 1)} AS avg_discount,
  {avg_sql('savings_inr', 2, 0)} AS avg_savings
FROM laptops_cleaned GROUP BY price_segment""",
    "vw_discount_analysis": f"""SELECT brand, discount_tier, COUNT(*) AS product_count,
  {avg_sql('discount_percent', 1, 1)} AS avg_discount,
  {avg_sql('savings_inr', 2, 0)} AS avg_savings,
  MAX(discount_percent) AS max_discount
FROM laptops_cleaned WHERE brand != 'Other' GROUP BY brand, discount_tier""",
    "vw_top_products": """SELECT product_name, brand, price_inr, original_price_inr,
  CAST(COALESCE(discount_percent, 0) AS DECIMAL(5,1)) AS discount_percent,
  CAST(COALESCE(savings_inr, 0) AS DECIMAL(11,2)) AS savings_inr,
  rating, rating_category, price_segment, discount_tier
FROM laptops_cleaned WHERE rating IS NOT NULL""",
    "vw_kpi_summary": f"""SELECT COUNT(*) AS total_products, COUNT(DISTINCT brand) AS total_brands,
  {avg_sql('price_inr', 2, 0)} AS avg_price,
  MIN(price_inr) AS min_price, MAX(price_inr) AS max_price,
  {avg_sql('rating', 1, 2)} AS avg_rating,
  {avg_sql('discount_percent', 1, 1)} AS avg_discount,
  {cnt_if('discount_percent >= 40')} AS mega_deals,
  {cnt_if('rating >= 4.5')} AS excellent_products
FROM laptops_cleaned""",
    "vw_all_products": """SELECT id, asin, product_name, brand, price_inr, original_price_inr,
  CAST(COALESCE(discount_percent, 0) AS DECIMAL(5,1)) AS discount_percent,
  CAST(COALESCE(savings_inr, 0) AS DECIMAL(11,2)) AS savings_inr,
  CAST(COALESCE(rating, 0) AS DECIMAL(3,1)) AS rating,
  total_reviews, price_segment, discount_tier, rating_category,
  listing_type, search_keyword, scraped_at
FROM laptops_cleaned""",
}

_TOTAL = "(SELECT COUNT(*) FROM laptops_cleaned)"

# The archived pages, from the fixture's recipe: ids in spans of 5600 share a
# page; some pages are refused, challenges, exhausted or empty; some cards have
# a blank ASIN (37), the name only in an h2 (23), unreadable reviews (41), or an
# empty card inside (43).
CARDS_SQL = f"""SELECT *, CAST(-(chunk * 1000000 + kr * 10000 + page_scraped) - 1 AS BIGINT) AS page_id,
  kind IN ('ok') AS served,
  CAST(ROW_NUMBER() OVER w - 1 + COALESCE(SUM(CASE WHEN id % 43 = 0 THEN 1 ELSE 0 END)
    OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS pos,
  MIN(scraped_at) OVER (PARTITION BY chunk, kr, page_scraped) AS fetched_at,
  CASE WHEN id % 37 = 0 THEN 'no asin' WHEN name IS NULL OR name = '' THEN 'no name'
       WHEN price_inr IS NULL OR floor(price_inr) <= 0 THEN 'no price' ELSE 'kept' END AS verdict
FROM (SELECT *, {KR} AS kr, id // 5600 AS chunk,
        CASE WHEN {KR} = 2 AND page_scraped = 15 THEN 'blocked'
             WHEN {KR} = 3 AND page_scraped = 12 THEN 'challenge'
             WHEN {KR} = 4 AND page_scraped = 18 THEN 'exhausted'
             WHEN {KR} = 5 AND page_scraped IN (9, 10) THEN 'empty' ELSE 'ok' END AS kind,
        CASE WHEN product_name IS NULL OR (id % 23 = 0 AND brand IS NOT NULL) THEN trim(brand)
             ELSE trim(product_name) END AS name
      FROM laptops_raw)
WINDOW w AS (PARTITION BY chunk, kr, page_scraped ORDER BY id)"""
_FLOOR_PRICE = "CAST(floor(price_inr) AS DECIMAL(10,2))"


def _card_discount_sql() -> str:
    mrp = "CAST(original_price_inr * 100 AS BIGINT)"
    price = "CAST(floor(price_inr) * 100 AS BIGINT)"
    tenths = _half_up(f"({mrp} - {price}) * 1000", mrp)
    return f"CAST(CAST({tenths} AS DECIMAL(18,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(5,2))"


EXTRACTED_SQL = f"""SELECT page_id, pos, asin, name AS product_name,
  CASE WHEN brand IS NOT NULL THEN trim(brand) ELSE split_part(name, ' ', 1) END AS brand,
  {_FLOOR_PRICE} AS price_inr, original_price_inr,
  CASE WHEN original_price_inr > 0 AND original_price_inr > floor(price_inr)
       THEN {_card_discount_sql()} END AS discount_percent,
  rating, CASE WHEN id % 41 <> 0 THEN total_reviews END AS total_reviews, listing_type,
  search_keyword, page_scraped, date_trunc('minute', fetched_at) AS scraped_at
FROM archived WHERE served AND verdict = 'kept'"""

CUTOFF_SQL = """SELECT search_keyword,
  CAST(COALESCE(MIN(CASE WHEN stop_reason IS NOT NULL THEN page_scraped END), MAX(page_scraped))
    AS INT) AS stop_page,
  COALESCE(arg_min(stop_reason, page_scraped) FILTER (WHERE stop_reason IS NOT NULL), 'max pages')
    AS stop_reason
FROM (SELECT *, CASE WHEN kind IN ('blocked', 'exhausted') THEN kind
    WHEN products = 0 AND LAG(products) OVER (PARTITION BY search_keyword ORDER BY page_scraped) = 0
    THEN 'empty run' END AS stop_reason
  FROM (SELECT search_keyword, page_scraped, MAX(kind) AS kind,
      COUNT(*) FILTER (WHERE served AND verdict = 'kept') AS products
    FROM archived GROUP BY search_keyword, page_scraped))
GROUP BY search_keyword"""


BODIES: dict[str, str] = {
    "page_status": """SELECT page_id,
  url_decode(replace(NULLIF(regexp_extract(url, '[?&]k=([^&#]*)', 1), ''), '+', ' '))
    AS search_keyword,
  TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER) AS page_num,
  CAST(0 AS INTEGER) AS n_cards,
  CASE WHEN COALESCE(contains(lower(html), 'captcha') OR contains(lower(html), 'enter the characters'),
                     false) THEN 'challenge'
       WHEN COALESCE(regexp_matches(html, '(?i)<span[^>]*>[^<]*no results for'), false)
         THEN 'exhausted' ELSE 'empty' END AS status
FROM pages
UNION ALL
SELECT page_id, search_keyword, page_scraped AS page_num,
  CAST(SUM(CASE WHEN NOT served THEN 0 WHEN id % 43 = 0 THEN 2 ELSE 1 END) AS INTEGER) AS n_cards,
  kind AS status
FROM archived GROUP BY page_id, search_keyword, page_scraped, kind""",
    "card_rejects": f"""SELECT page_id,
  CAST(SUM(CASE WHEN id % 43 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS cards,
  {cnt_if("verdict = 'kept'")} AS kept, CAST(0 AS BIGINT) AS broken,
  {cnt_if("verdict = 'no asin'")} AS no_asin,
  {cnt_if("verdict = 'no name'")} + {cnt_if("id % 43 = 0")} AS no_name,
  {cnt_if("verdict = 'no price'")} AS no_price
FROM archived WHERE served GROUP BY page_id""",
    "extract_cards": EXTRACTED_SQL,
    "raw_count": "SELECT COUNT(*) AS total_rows FROM laptops_raw",
    "load_csv": f"SELECT {RAW_COLS.replace('id, ', '', 1)} FROM laptops_raw",
    "export_raw": f"SELECT {RAW_COLS.replace('id, ', '', 1)} FROM first_seen",
    "surrogate_key": f"SELECT ROW_NUMBER() OVER (ORDER BY id) AS row_id, {RAW_COLS} FROM laptops_raw",
    "surrogate_key_loads": f"""SELECT ROW_NUMBER() OVER (ORDER BY CASE WHEN {KR} <= 3 THEN 1 ELSE 2 END,
  id) AS row_id, {RAW_COLS} FROM laptops_raw""",
    "stream_first_seen": f"SELECT {RAW_COLS} FROM first_seen",
    "crawl_checkpoint": f"SELECT {RAW_COLS} FROM first_seen",
    "crawl_cutoff_long": """SELECT search_keyword,
  CAST(COALESCE(MIN(stop), MAX(page)) AS INT) AS stop_page,
  COALESCE(arg_min(reason, page) FILTER (WHERE reason IS NOT NULL), 'max pages') AS stop_reason,
  CAST(COALESCE(SUM(products) FILTER (WHERE first_stop IS NULL OR page <= first_stop), 0) AS BIGINT)
    AS products_kept
FROM (SELECT *, MIN(stop) OVER (PARTITION BY search_keyword) AS first_stop
  FROM (SELECT *, CASE WHEN reason IS NOT NULL THEN page END AS stop
    FROM (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN products = 0 AND
        LAG(products) OVER (PARTITION BY search_keyword ORDER BY page) = 0 THEN 'empty run' END AS reason
      FROM (SELECT concat('long ', o_orderkey % 3) AS search_keyword, o_orderkey // 3 AS page,
          o_custkey % 60 AS products, o_orderkey % 9973 = 0 AS blocked FROM orders))))
GROUP BY search_keyword""",
    "cleaned": "SELECT * FROM laptops_cleaned",
    "cleaned_stored": "SELECT * FROM laptops_cleaned",
    "clean_removed": f"""SELECT id, asin, product_name, brand, price_inr,
  CASE WHEN price_inr IS NULL THEN 'missing price'
       WHEN price_inr <= {PRICE_LOW} THEN 'price too low'
       WHEN price_inr >= {PRICE_HIGH} THEN 'price too high'
       WHEN product_name IS NULL THEN 'missing name' END AS reason
FROM laptops_raw
WHERE NOT (price_inr IS NOT NULL AND price_inr > {PRICE_LOW} AND price_inr < {PRICE_HIGH}
           AND product_name IS NOT NULL)""",
    "list_marts": " UNION ALL ".join(
        f"SELECT '{name}' AS view_name, COUNT(*) AS n_rows FROM ({body})"
        for name, body in sorted(MART_SQL.items())),
    "dq_profile": f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT asin) AS unique_products,
  {cnt_if('price_inr IS NULL')} AS missing_price,
  {cnt_if('rating IS NULL')} AS missing_rating,
  {cnt_if('total_reviews IS NULL')} AS missing_reviews,
  {cnt_if(f'price_inr < {PRICE_LOW}')} AS suspicious_low_price,
  {cnt_if(f'price_inr > {PRICE_HIGH}')} AS suspicious_high_price
FROM laptops_raw""",
    "dq_duplicates": """SELECT asin, COUNT(*) AS occurrences FROM laptops_raw
GROUP BY asin HAVING COUNT(*) > 1 ORDER BY occurrences DESC, asin LIMIT 10""",
    "dq_reconcile": """SELECT r AS raw_records, c AS cleaned_records, r - c AS rows_removed
FROM (SELECT (SELECT COUNT(*) FROM laptops_raw) AS r, (SELECT COUNT(*) FROM laptops_cleaned) AS c)""",
    "brand_leaderboard": f"""SELECT brand, COUNT(*) AS total_products,
  {avg_sql('price_inr', 2, 0)} AS avg_price, {avg_sql('rating', 1, 2)} AS avg_rating
FROM laptops_cleaned WHERE brand != 'Other' GROUP BY brand
ORDER BY total_products DESC, brand LIMIT 10""",
    "segment_popularity": f"""SELECT price_segment, COUNT(*) AS total_products,
  {avg_sql('rating', 1, 2)} AS avg_rating, {avg_sql('discount_percent', 1, 1)} AS avg_discount
FROM laptops_cleaned GROUP BY price_segment""",
    "top_rated": """SELECT product_name, brand, price_inr, rating FROM laptops_cleaned
WHERE rating IS NOT NULL ORDER BY rating DESC, price_inr ASC, id ASC LIMIT 10""",
    "brand_discount": f"""SELECT brand, {avg_sql('discount_percent', 1, 1)} AS avg_discount,
  {avg_sql('savings_inr', 2, 0)} AS avg_savings_inr, COUNT(*) AS products
FROM laptops_cleaned WHERE discount_percent IS NOT NULL AND brand != 'Other'
GROUP BY brand HAVING COUNT(*) >= 5 ORDER BY avg_discount DESC, brand LIMIT 10""",
    "best_value": """SELECT product_name, brand, price_inr, discount_percent, rating
FROM laptops_cleaned WHERE rating >= 4.0 AND discount_percent >= 15
ORDER BY discount_percent DESC, id LIMIT 10""",
    "rating_distribution": f"""SELECT rating_category, COUNT(*) AS products,
  {share_sql('COUNT(*)', _TOTAL, 1)} AS percentage
FROM laptops_cleaned GROUP BY rating_category""",
    "segment_rating": f"""SELECT price_segment, COUNT(*) AS products,
  {avg_sql('rating', 1, 2)} AS avg_rating, {avg_sql('discount_percent', 1, 1)} AS avg_discount
FROM laptops_cleaned WHERE rating IS NOT NULL GROUP BY price_segment""",
    "listing_performance": f"""SELECT listing_type, COUNT(*) AS total_products,
  {avg_sql('price_inr', 2, 0)} AS avg_price, {avg_sql('rating', 1, 2)} AS avg_rating,
  {avg_sql('discount_percent', 1, 1)} AS avg_discount
FROM laptops_cleaned GROUP BY listing_type""",
    "keyword_quality": f"""SELECT search_keyword, COUNT(*) AS products,
  {avg_sql('price_inr', 2, 0)} AS avg_price, {avg_sql('rating', 1, 2)} AS avg_rating,
  {avg_sql('discount_percent', 1, 1)} AS avg_discount
FROM laptops_cleaned GROUP BY search_keyword""",
    "brand_positioning": """SELECT brand, price_segment, COUNT(*) AS products FROM laptops_cleaned
WHERE brand IN ('Lenovo','HP','ASUS','Acer','Dell','Apple','MSI')
GROUP BY brand, price_segment""",
    **MART_SQL,
    "first_seen": f"SELECT {RAW_COLS} FROM first_seen",
    "page_yield": f"""SELECT search_keyword, page_scraped, CAST(products AS BIGINT) AS products,
  CAST(new_products AS BIGINT) AS new_products,
  CAST(products - new_products AS BIGINT) AS duplicates,
  CAST(SUM(new_products) OVER (ORDER BY kr, page_scraped ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS running_total
FROM (
  SELECT kr, search_keyword, page_scraped, SUM(n) AS products,
         SUM(CASE WHEN kr * 1000 + page_scraped = first_at THEN n ELSE 0 END) AS new_products
  FROM (SELECT *, MIN(kr * 1000 + page_scraped) OVER (PARTITION BY asin) AS first_at
        FROM (SELECT asin, {KR} AS kr, search_keyword, page_scraped, COUNT(*) AS n
              FROM laptops_raw GROUP BY ALL))
  GROUP BY kr, search_keyword, page_scraped)""",
    "crawl_cutoff": f"""SELECT c.search_keyword, stop_page, stop_reason,
  CAST(COUNT(*) FILTER (WHERE served AND verdict = 'kept' AND page_scraped <= stop_page) AS BIGINT)
    AS products_kept
FROM ({CUTOFF_SQL}) c JOIN archived a ON a.search_keyword = c.search_keyword
GROUP BY c.search_keyword, stop_page, stop_reason""",
    "incremental_new": f"""SELECT {RAW_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY asin ORDER BY {KR}, page_scraped, id) AS rn
  FROM laptops_raw WHERE search_keyword IS NULL OR search_keyword NOT IN ({_DONE})) n
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM laptops_raw s
                  WHERE s.search_keyword IN ({_DONE}) AND s.asin = n.asin)""",
    "resume_crawl": f"SELECT {RAW_COLS} FROM first_seen",
    "run_report": f"""SELECT COUNT(*) AS unique_products,
  (SELECT COUNT(*) FROM laptops_raw r JOIN first_seen f ON r.asin = f.asin
     AND r.search_keyword = f.search_keyword AND r.page_scraped = f.page_scraped) - COUNT(*)
    AS duplicates_removed,
  {avg_sql('price_inr', 2, 0)} AS avg_price,
  MIN(price_inr) AS min_price, MAX(price_inr) AS max_price,
  {avg_sql('rating', 1, 2)} AS avg_rating,
  COUNT(DISTINCT brand) AS unique_brands,
  {share_sql('COUNT(discount_percent)', 'COUNT(*)', 1)} AS pct_with_discount,
  {avg_sql('discount_percent', 2, 1)} AS avg_discount,
  {cnt_if("listing_type = 'Sponsored'")} AS sponsored_listings,
  {cnt_if("listing_type = 'Organic'")} AS organic_listings
FROM first_seen""",
    "keyword_breakdown": """SELECT search_keyword, COUNT(asin) AS products FROM first_seen
GROUP BY search_keyword""",
    "run_preview": f"""SELECT product_name, brand, price_inr, discount_percent, rating, search_keyword
FROM first_seen ORDER BY {KR}, page_scraped, id LIMIT 5""",
    "dominant_segment": f"""SELECT price_segment, COUNT(*) AS total_products,
  {share_sql('COUNT(*)', _TOTAL, 1)} AS share_pct
FROM laptops_cleaned GROUP BY price_segment
ORDER BY total_products DESC, price_segment NULLS LAST LIMIT 1""",
    "premium_share": f"""SELECT {share_sql(cnt_if('price_inr > 50000'), 'COUNT(*)', 2)} AS premium_pct
FROM laptops_cleaned""",
    "discount_extremes": f"""SELECT first(brand ORDER BY avg_discount DESC, brand) AS highest_brand,
  MAX(avg_discount) AS highest_avg_discount,
  first(brand ORDER BY avg_discount ASC, brand) AS lowest_brand,
  MIN(avg_discount) AS lowest_avg_discount
FROM (SELECT brand, {avg_sql('discount_percent', 1, 1)} AS avg_discount FROM laptops_cleaned
      WHERE discount_percent IS NOT NULL AND brand != 'Other'
      GROUP BY brand HAVING COUNT(*) >= 5)""",
    "top_rated_brand": f"""SELECT first(brand ORDER BY avg_rating DESC, brand) AS brand,
  MAX(avg_rating) AS avg_rating
FROM (SELECT brand, {avg0_sql('rating', 1, 2)} AS avg_rating FROM laptops_cleaned
      WHERE brand != 'Other' GROUP BY brand)""",
    "below_average_share": f"""SELECT {share_sql(cnt_if("rating_category = 'Below Average'"), 'COUNT(*)', 1)}
  AS below_average_pct FROM laptops_cleaned""",
    "high_rated_share": f"""SELECT {share_sql(cnt_if('rating >= 4.0'), 'COUNT(*)', 2)} AS high_rated_pct
FROM laptops_cleaned""",
    "brand_share": f"""SELECT brand, COUNT(*) AS products, {share_sql('COUNT(*)', _TOTAL, 1)} AS share_pct
FROM laptops_cleaned GROUP BY brand""",
    "price_discount_points": """SELECT id, brand, price_inr,
  CAST(COALESCE(discount_percent, 0) AS DECIMAL(5,1)) AS discount_percent
FROM laptops_cleaned WHERE rating IS NOT NULL""",
}


BODIES["archive_listings"] = f"""SELECT
  ROW_NUMBER() OVER (ORDER BY kr2, page_scraped, page_id, pos) AS id, {RAW_COLS.replace('id, ', '', 1)}
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY asin ORDER BY kr2, page_scraped, page_id, pos) AS rn
  FROM (SELECT e.*, {KR.replace('search_keyword', 'e.search_keyword')} AS kr2
        FROM ({EXTRACTED_SQL}) e JOIN ({CUTOFF_SQL}) c
        ON e.search_keyword = c.search_keyword AND e.page_scraped <= c.stop_page))
WHERE rn = 1"""

BODIES["archive_kpi_summary"] = MART_SQL["vw_kpi_summary"].replace(
    "FROM laptops_cleaned",
    f"FROM ({cleaned_sql('(' + BODIES['archive_listings'] + ') AS archive_raw')}) AS archive_cleaned")


# Flaws of the CSV input, by id: fields, lines cut after three fields, lines with one
# field more. All fields are quoted.
_FLAWS = [("price_inr", 83, "n/a", "decimal(10,2)"), ("total_reviews", 89, "12.5", "int"),
          ("rating", 101, "4,5", "decimal(3,1)"), ("scraped_at", 107, "yesterday", "timestamp_ntz")]


def _line_sql(n: int) -> str:
    """The first n fields of a listing as the flawed file holds them."""
    flaws = {field: f"WHEN id % {every} = 0 THEN '{value}' " for field, every, value, _ in _FLAWS}
    fields = [f"""'"' || replace(CASE {flaws.get(c, "")}WHEN {c} IS NULL THEN ''
      ELSE CAST({c} AS VARCHAR) END, '"', '""') || '"'""" for c in RAW_COLS.split(", ")[1:n + 1]]
    return " || ',' || ".join(fields)


BODIES["load_rejects"] = " UNION ALL ".join(
    [f"""SELECT asin, '{field}' AS field, '{value}' AS value, 'not a {kind}' AS reason
FROM laptops_raw WHERE id % {every} = 0 AND id % 131 <> 0""" for field, every, value, kind in _FLAWS]
    + [f"""SELECT asin, NULL AS field, CASE WHEN id % 131 = 0 THEN {_line_sql(3)} ELSE {_line_sql(12)} END
  || CASE WHEN id % 137 = 0 THEN ',more' ELSE '' END AS value,
  CASE WHEN id % 131 = 0 THEN 'too few fields' ELSE 'too many fields' END AS reason
FROM laptops_raw WHERE id % 131 = 0 OR id % 137 = 0""",
       """SELECT asin, 'price_inr', 'more', 'not a decimal(10,2)'
FROM laptops_raw WHERE id % 131 = 0 AND id % 137 = 0"""])   # the fourth of a short line's fields
BODIES |= {name.replace("vw_", "merged_"): MART_SQL[name] for name in
           ("vw_brand_performance", "vw_price_segments", "vw_discount_analysis", "vw_kpi_summary")}


def with_base(body: str) -> str:
    return (f"WITH laptops_raw AS ({raw_from_orders_sql('orders')}),\n"
            f"laptops_cleaned AS ({CLEANED_SQL}),\n"
            f"first_seen AS ({FIRST_SEEN_SQL}),\n"
            f"archived AS ({CARDS_SQL})\n{body}")


def oracle_sql() -> dict[str, str]:
    return {k: with_base(v) for k, v in BODIES.items()}

