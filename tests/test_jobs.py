"""Reports and models over tables built from small raw files."""

import datetime as dt
import random
import subprocess
import sys
from pathlib import Path

import pytest

from basketry import schemas as S
from basketry.plans.report import REPORTS
from basketry.sources.catalog import Catalog

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "jobs"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    stored = Catalog(spark, root)
    rng = random.Random(3)
    orders, items, order = [], [], 0
    for user in range(60):
        for number in range(1, rng.randint(3, 8)):
            order += 1
            gap = None if number == 1 else float(rng.randint(1, 30))
            orders.append((order, user, "prior", number, order % 7, order % 24, gap))
            for place, product in enumerate(rng.sample(range(20), rng.randint(1, 9))):
                items.append((order, product, place + 1, int(rng.random() < 0.6)))
    products = [(p, f"name {p}", p % 4, p % 3, f"aisle {p % 4}", f"dept {p % 3}") for p in range(20)]
    start = dt.date(2015, 1, 3)
    sales, prices = [], []
    for item in range(4):
        for week in range(30):
            price = 2.0 + (week * (item + 2) % 5) / 4
            prices.append(("X", f"i{item}", week, price, start + dt.timedelta(days=7 * week)))
            for n in range(7):
                day = start + dt.timedelta(days=7 * week + n)
                amount = int(60 / price + 5 * (n == 6) + rng.randint(0, 3))
                sales.append((f"i{item}", f"d{item % 2}", f"c{item % 2}", "X", amount, day, day.month))
    catalogue = [(str(i), f"food {i}" if i else "x", "b", f"cat {i % 3}" if i % 5 else None, "a") for i in range(30)]

    def save(name, rows, schema, *parts):
        writer = spark.createDataFrame(rows, schema).write
        writer.partitionBy(*parts).parquet(stored.path(name))

    save(S.ORDERS, orders, S.ORDERS_SCHEMA)
    save(S.ORDER_ITEMS, items, S.ORDER_ITEMS_SCHEMA)
    save(S.PRODUCTS, products, "product_id long, product_name string, aisle_id int, department_id int, aisle string, department string")
    save(S.DAILY_SALES, sales, "item_id string, dept_id string, cat_id string, store_id string, sales int, date date, month int", *S.DAILY_SALES_PARTITIONS)
    save(S.SELL_PRICES, prices, "store_id string, item_id string, wm_yr_wk int, sell_price double, week_start date")
    save(S.CATALOGUE, catalogue, "code string, product_name string, brands string, main_category_en string, nutriscore_grade string")
    return stored


@pytest.mark.parametrize("part", sorted(REPORTS))
def test_report_answers_have_rows(tables, part, capsys):
    for title, answer in REPORTS[part](tables).items():
        assert answer.count() > 0, title
        answer.show(3, truncate=False)
    assert "|" in capsys.readouterr().out


def test_report_numbers(tables):
    report = REPORTS["orders"](tables)
    n_items = tables.load_order_items().count()
    n_orders = tables.load_orders().count()
    assert sum(r.n_orders for r in report["orders_by_weekday"].collect()) == n_orders
    assert sum(r.n_items for r in report["items_by_department"].collect()) == n_items
    assert sum(r.n for r in report["basket_histogram"].collect()) == report["basket_sizes"].first().n
    shape = REPORTS["catalogue"](tables)["catalogue_shape"].first()
    assert tuple(shape) == (29, 5)  # the one-letter name is too short


def test_price_and_segment_models(spark, tables, tmp_path):
    import models

    out = str(tmp_path)
    models.prices(tables, out)
    own = spark.read.parquet(f"{out}/own_elasticity").collect()
    assert {r.cat_id for r in own} == {"c0", "c1"}
    assert all(-1.5 < r.elasticity < -0.5 for r in own)
    crossed = spark.read.parquet(f"{out}/cross_elasticity").collect()
    assert sorted((r.dept_id, r.driver) for r in crossed) == [("d0", "d1"), ("d1", "d0")]
    joint = spark.read.parquet(f"{out}/joint_elasticity").collect()
    assert len(joint) == 4 and {r.driver for r in joint} == {"d0", "d1"}
    models.segment(tables, out)
    assert spark.read.parquet(f"{out}/customer_segments").count() == 60


def test_demand_and_reorder_models(spark, tables, tmp_path, monkeypatch):
    import models

    monkeypatch.setitem(S.GBT_DEFAULTS, "maxIter", 3)
    out = str(tmp_path)
    models.demand(tables, out)
    assert spark.read.parquet(f"{out}/demand_forecast").count() == 4 * 28
    models.reorders(tables, out)
    scores = spark.read.parquet(f"{out}/reorder_scores")
    assert scores.where("reorder_probability between 0 and 1").count() == scores.count() > 0


@pytest.mark.parametrize("script", ["preprocess_data", "report", "models"])
def test_scripts_explain_themselves(script):
    done = subprocess.run(
        [sys.executable, str(ROOT / "jobs" / f"{script}.py"), "--help"],
        env={"PYTHONPATH": str(ROOT), "PATH": "/usr/bin:/bin"},
        capture_output=True,
        text=True,
        timeout=60,
    )
    assert done.returncode == 0
    assert "--" in done.stdout
