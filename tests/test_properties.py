"""Properties: invariants over generated raw rows."""

import datetime as dt
import os
import subprocess
import sys
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from bazaarlens.operators.clean import clean, clean_removed
from bazaarlens.operators.dedup import first_seen
from bazaarlens.operators.insights import rating_distribution
from bazaarlens.operators.measures import brand_share
from bazaarlens.sources.schema import RAW_SCHEMA

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

prices = st.one_of(st.none(), st.decimals(min_value=0, max_value=Decimal("999999.99"), places=2))
ratings = st.one_of(st.none(), st.decimals(min_value=0, max_value=Decimal("9.9"), places=1))
discounts = st.one_of(st.none(), st.decimals(min_value=0, max_value=Decimal("99.99"), places=2))
names = st.one_of(st.none(), st.sampled_from(["  MacBook Air ", "ThinkPad X1", "x", "Vivobook",
                                              "pavilion 14", "Laptop 7"]))
brands = st.one_of(st.none(), st.sampled_from(["hp", "Dell ", "15.6", " 15", "Acer", "zz", "MSI"]))
keywords = st.sampled_from(["laptops", "gaming laptops", "student laptops", "other"])

row = st.tuples(st.sampled_from(["A", "B", "C", "D"]), names, brands, prices, prices, discounts,
                ratings, st.one_of(st.none(), st.integers(0, 10**6)),
                st.sampled_from(["Sponsored", "Organic"]), keywords, st.integers(1, 20))


def to_df(spark, rows):
    ts = dt.datetime(2024, 1, 1)
    data = [(i, *r, ts) for i, r in enumerate(rows, start=1)]
    return spark.createDataFrame(data, RAW_SCHEMA)


SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_clean_partition_independent_and_complete(spark, rows):
    raw = to_df(spark, rows)
    a = sorted(clean(raw).collect())
    assert a == sorted(clean(raw.repartition(3)).collect())
    assert len(a) + clean_removed(raw).count() == len(rows)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_categories_and_shares_add_up(spark, rows):
    cleaned = clean(to_df(spark, rows))
    n = cleaned.count()
    dist = rating_distribution(cleaned).collect()
    assert sum(r.products for r in dist) == n
    if n:
        assert abs(sum(r.percentage for r in dist) - 100) <= 0.05 * len(dist) + 1e-9
        shares = brand_share(cleaned).collect()
        assert sum(r.products for r in shares) == n
        assert abs(sum(r.share_pct for r in shares) - 100) <= 0.05 * len(shares) + 1e-9


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_first_seen_unique_and_earliest(spark, rows):
    raw = to_df(spark, rows)
    got = {r.asin: r.id for r in first_seen(raw.repartition(4)).collect()}
    rank = {"laptops": 1, "gaming laptops": 2, "student laptops": 6, "other": 8}
    want = {}
    for i, r in enumerate(rows, start=1):
        k = (rank[r[9]], r[10], i)
        if r[0] not in want or k < want[r[0]][0]:
            want[r[0]] = (k, i)
    assert got == {a: v[1] for a, v in want.items()}


def test_tasks_run_without_the_package_on_the_worker_path(tmp_path):
    """The card finder runs in Python workers started outside the repository."""
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {REPO!r})\n"
        "from bazaarlens.session import get_session\n"
        "from bazaarlens.operators.extract import extract_cards\n"
        "spark = get_session('local[2]')\n"
        "html = '<div data-component-type=\"s-search-result\" data-asin=\"B1\">"
        "<h2>Acer One</h2><span class=\"a-price-whole\">30,000.</span></div>'\n"
        "df = spark.createDataFrame([(1, 'u?k=a&page=1', html)], 'page_id long, url string, html string')\n"
        "print('CARDS', extract_cards(df).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert "CARDS 1" in out.stdout, out.stderr[-2000:]
