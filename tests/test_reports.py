import datetime as dt
from decimal import Decimal

import pytest
from conftest import as_set

from ledgerlake import schemas
from ledgerlake.operators import quality
from ledgerlake.operators.landing import with_partition_keys
from ledgerlake.plans import reconcile, reports, star

D, M = dt.date, Decimal


@pytest.fixture(scope="module")
def shop(spark):
    stores = spark.createDataFrame(
        [(f"S0{n}", f"Store {n}", "a", "c", "s", "r", 1, D(2011, 1, 1)) for n in (2, 1)],
        schemas.STORES,
    )
    categories = spark.createDataFrame(
        [("C02", "Dairy", "Fresh", M("0.050")), ("C01", "Snacks", "Food", M("0.180"))],
        schemas.CATEGORIES,
    )
    products = spark.createDataFrame(
        [
            (11, "P1", "Chips", "C01", None, None, None, D(2020, 1, 1), D(2024, 5, 31), False),
            (12, "P1", "Milk", "C02", None, None, None, D(2024, 6, 1), D(9999, 12, 31), True),
            (13, "P2", "Curd", "C02", None, None, None, D(2020, 1, 1), D(9999, 12, 31), True),
        ],
        schemas.PRODUCTS,
    )
    prices = spark.createDataFrame(
        [
            (1, 11, M(9), M("8.00"), D(2024, 5, 1), D(2024, 5, 15)),
            (2, 11, M(9), M("9.00"), D(2024, 5, 16), D(2024, 5, 31)),
        ],
        schemas.PRICE_REVISIONS,
    )
    lines = spark.createDataFrame(
        [
            ("S01", D(2024, 5, 15), "b1", 1, "P1", M("2.000"), M("7.50"), "SALE", "t"),
            ("S01", D(2024, 5, 31), "b2", 1, "P1", M("1.000"), M("7.50"), "SALE", "t"),
            ("S01", D(2024, 6, 1), "b3", 1, "P1", M("1.000"), M("30.00"), "SALE", "t"),
            ("S01", D(2024, 6, 1), "b3", 2, "P2", M("-1.000"), M("4.00"), "RETURN", "t"),
            ("S01", D(2024, 6, 1), "b3", 3, "DISC", M("1.000"), M("-2.00"), "DISCOUNT", "t"),
            ("S01", D(2024, 6, 1), "b3", 4, "GST", M("1.000"), M("5.00"), "TAX", "t"),
            ("S01", D(2024, 6, 1), "b3", 5, "CASH", M("1.000"), M("29.00"), "TENDER", "t"),
            ("S02", D(2024, 6, 2), "b4", 1, "DISC", M("1.000"), M("2.00"), "VOID", "t"),
            ("S02", D(2024, 6, 2), "b4", 2, "P9", M("1.000"), M("1.00"), "SALE", "t"),
            ("S99", D(2024, 6, 2), "b5", 1, "P2", M("1.000"), M("1.00"), "SALE", "t"),
        ],
        "store_id string, business_date date, bill_no string, line_no int, product_code string,"
        "qty decimal(18,3), unit_price decimal(18,2), line_type string, ts string",
    )
    dim_store, dim_category = star.dim_store(stores), star.dim_category(categories)
    dim_product = star.dim_product(products, dim_category)
    return {
        "stores": stores, "categories": categories, "products": products, "prices": prices,
        "lines": with_partition_keys(lines), "dim_store": dim_store,
        "dim_category": dim_category, "dim_product": dim_product,
        "fact": star.fact_sales_line(with_partition_keys(lines), dim_store, dim_product),
    }


def test_calendar_of_a_leap_year(spark):
    span = spark.createDataFrame([(D(2024, 1, 1), D(2024, 12, 31))], "first_day date, last_day date")
    days = star.calendar(span)
    assert days.count() == 366
    row = days.where("date_key = 20240901").first()
    assert (row.month_name, row.day_name, row.day_of_week, row.week_start) == (
        "September", "Sunday", 0, D(2024, 8, 26),
    )
    dates = spark.createDataFrame([(D(2023, 5, 1),), (D(2024, 2, 1),)], "business_date date")
    assert tuple(star.whole_years(dates).first()) == (D(2023, 1, 1), D(2024, 12, 31))


def test_surrogate_keys_follow_the_natural_key(shop):
    assert as_set(shop["dim_store"], "store_key", "store_id") == {(1, "S01"), (2, "S02")}
    assert as_set(shop["dim_category"], "category_key", "category_id") == {(1, "C01"), (2, "C02")}


def test_fact_keeps_every_line_of_known_stores(shop):
    rows = {(r.bill_no, r.line_no): r for r in shop["fact"].collect()}
    assert len(rows) == 9  # S99 is unknown
    assert rows["b2", 1].product_key == 11 and rows["b3", 1].product_key == 12
    assert rows["b3", 4].revenue_amount == 0 and not rows["b3", 4].is_revenue
    assert rows["b4", 1].product_key is None and rows["b4", 1].is_revenue
    assert len({r.sales_line_key for r in rows.values()}) == 9
    counts = quality.fact_integrity(shop["fact"]).first().asDict()
    assert counts == {
        "fact_rows": 9, "distinct_source_lines": 9, "duplicate_rows": 0,
        "unresolved_item_lines": 1, "void_discount_control_lines": 1,
    }
    assert quality.reissued_codes(shop["dim_product"]).first()[0] == 1
    assert as_set(quality.table_counts({"a": shop["dim_store"], "b": shop["fact"]})) == {
        ("a", 2), ("b", 9)}


def test_keys_of_several_rows_and_of_several_sources(spark):
    rows = [(1, "a", 1), (1, "a", 1), (2, "a", 2), (2, "b", 1), (3, None, 1), (3, "c", 1), (None, "d", 1), (4, "e", None)]
    frame = spark.createDataFrame(rows, "key long, bill_no string, line_no int")
    found = quality.key_uniqueness(frame, "key", ("bill_no", "line_no")).first().asDict()
    assert found == {"key_rows": 8, "distinct_keys": 4, "null_keys": 1, "repeated_keys": 3, "shared_keys": 2}
    empty = quality.key_uniqueness(frame.limit(0), "key", ("bill_no", "line_no")).first()
    assert set(empty.asDict().values()) == {0}


def test_net_revenue_leaves_tax_and_tender_out(shop):
    daily = as_set(reports.daily_revenue(shop["lines"]))
    assert ("S01", D(2024, 6, 1), M("24.00")) in daily
    months = as_set(reports.partition_revenue(shop["lines"]))
    assert ("S01", 2024, "05", M("22.50")) in months


def test_dashboard_and_federated_agree(shop, spark):
    span = spark.createDataFrame([(D(2024, 1, 1), D(2024, 12, 31))], "first_day date, last_day date")
    rows = as_set(
        reports.dashboard_revenue(
            shop["fact"], shop["dim_store"], shop["dim_product"], shop["dim_category"],
            star.calendar(span), "S01", D(2024, 6, 1), D(2024, 7, 1),
        ),
        "store_name", "product_name", "category_name", "calendar_date", "revenue",
    )
    june = D(2024, 6, 1)
    assert rows == {
        ("Store 1", "Milk", "Dairy", june, M("30.00")),
        ("Store 1", "Curd", "Dairy", june, M("-4.00")),
        ("Store 1", None, None, june, M("-2.00")),
    }
    report = reports.by_category_and_product(
        reports.federated_revenue(
            shop["lines"], shop["stores"], shop["products"], shop["categories"]
        ).where("store_id = 'S01'")
    ).collect()
    assert [(r.category_name, r.product_name, r.revenue) for r in report] == [
        ("Dairy", "Curd", M("-4.00")), ("Dairy", "Milk", M("30.00")),
        ("Snacks", "Chips", M("22.50")), (None, None, M("-2.00")),
    ]


def test_historical_prices_use_the_revision_of_the_day(shop):
    may = reports.historical_price_report(
        shop["fact"], shop["prices"], D(2024, 5, 1), D(2024, 6, 1)
    ).first()
    assert may.period_end == D(2024, 5, 31) and may.revenue_lines == 2
    assert may.lines_using_revision_price == 2
    assert may.printed_till_revenue == M("22.50")
    assert may.historical_price_revenue == M("25.00")  # 2 x 8.00 + 1 x 9.00
    assert may.historical_minus_printed == M("2.50")
    june = reports.historical_price_report(
        shop["fact"], shop["prices"], D(2024, 6, 1), D(2024, 7, 1)
    ).first()
    assert june.lines_using_printed_price == 5
    assert june.historical_price_revenue == june.printed_till_revenue == M("27.00")
    empty = reports.historical_price_report(
        shop["fact"], shop["prices"], D(2023, 1, 1), D(2023, 2, 1)
    ).first()
    assert empty.revenue_lines == 0 and empty.printed_till_revenue is None


def test_price_report_as_a_sql_function(shop, spark):
    reports.register_price_function(shop["fact"], shop["prices"], "price_report")
    for start, end in ((D(2024, 5, 1), D(2024, 6, 1)), (D(2024, 6, 1), D(2024, 7, 1)),
                       (D(2023, 1, 1), D(2023, 2, 1))):
        got = spark.sql(f"SELECT * FROM price_report(DATE '{start}', DATE '{end}')")
        want = reports.historical_price_report(shop["fact"], shop["prices"], start, end)
        assert got.columns == want.columns and got.collect() == want.collect()


# Published monthly totals: pipeline, finance.
MONTHS = [
    ("2024-01", "38446071.33", "38446071.33"), ("2024-02", "34887085.55", "34887085.55"),
    ("2024-03", "41971649.09", "42457899.09"), ("2024-04", "37958457.37", "37958457.37"),
    ("2024-05", "41764716.40", "41764716.40"), ("2024-06", "38987082.82", "38987082.82"),
    ("2024-07", "40295160.11", "40527291.81"), ("2024-08", "45252181.75", "45252181.75"),
    ("2024-09", "44615037.46", "44615037.46"), ("2024-10", "56359195.92", "56359195.92"),
    ("2024-11", "51583838.47", "51583838.47"), ("2024-12", "50745259.48", "50745209.00"),
]


def test_reconciliation_matches_the_published_year(spark):
    pipeline = spark.createDataFrame(
        [(m, M(p)) for m, p, _ in MONTHS], "month string, pipeline_revenue decimal(38,2)")
    finance = spark.createDataFrame(
        [(m, M(f)) for m, _, f in MONTHS], "month string, revenue_inr decimal(18,2)")
    rows = {r.month: r for r in reconcile.reconcile(
        pipeline, finance, reconcile.known_differences(spark)).collect()}
    off = {m: (r.variance, r.cause) for m, r in rows.items() if r.cause != "match"}
    assert len(rows) == 12 and off == {
        "2024-03": (M("486250.00"), "definition difference"),
        "2024-07": (M("232131.70"), "source data"),
        "2024-12": (M("-50.48"), "definition difference"),
    }
    assert rows["2024-07"].owner_to_take_back.startswith("store operations")
    assert rows["2024-01"].owner_to_take_back == "none"
    assert rows["2024-01"].explanation == "Pipeline revenue matches the finance amount."


def test_one_sided_months_show_only_in_the_full_comparison(spark):
    pipeline = spark.createDataFrame([("2024-01", M(1))], "month string, pipeline_revenue decimal(38,2)")
    finance = spark.createDataFrame(
        [("2024-01", M(3)), ("2024-02", M(2))], "month string, revenue_inr decimal(18,2)")
    known = reconcile.known_differences(spark)
    inner = reconcile.reconcile(pipeline, finance, known).collect()
    assert [(r.month, r.cause) for r in inner] == [("2024-01", "pipeline bug")]
    full = reconcile.reconcile(pipeline, finance, known, how="full")
    assert as_set(full, "month", "variance") == {("2024-01", M("2.00")), ("2024-02", None)}
