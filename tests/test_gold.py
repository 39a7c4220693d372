"""Aggregates on hand-written silver lines, and relations between them."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import gold, kpis
from basketry.plans import driver_tables as given
from basketry.schema import COUNTRY, FACT, MONTHLY, PRODUCT, RFM

SF = "/root/testdata/sf0.001"

SILVER_SCHEMA = """
  invoice_no string, stock_code string, product_description string, quantity int,
  invoice_date timestamp_ntz, unit_price decimal(18,4), customer_id bigint, country string,
  is_cancelled int, total_line_price decimal(29,4), invoice_year_month string,
  invoice_year int, invoice_month int"""


def line(invoice, quantity, price, customer=1, country="UK", product="CUP", code="1", day="2010-01-05"):
    date = datetime.fromisoformat(day) if day else None
    price = Decimal(price)
    return (
        invoice, code, product, quantity, date, price, customer, country,
        int(invoice.upper().startswith("C")),
        None if quantity is None else quantity * price,
        day[:7] if day else None,
        date.year if date else None,
        date.month if date else None,
    )


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [
            line("1", 2, "1.5"),
            line("1", 1, "10", product=None),
            line("2", -1, "4"),  # a return that is not a cancellation
            line("C3", -2, "1.5", customer=2, day="2010-02-01"),
            line("4", None, "7", customer=2, country="FR", day=None),
            line("5", 3, "2", customer=-1, country="FR"),
            line("6", 1, "1", customer=1, country="FR", day="2010-03-01"),
        ],
        SILVER_SCHEMA,
    )


def rows(frame, *keys):
    return {tuple(row[k] for k in keys): row.asDict() for row in frame.collect()}


def test_product_metrics_group_by_description_and_code(lines):
    result = rows(gold.product_metrics(lines), "product_description", "stock_code")
    assert set(result) == {("CUP", "1"), (None, "1")}
    assert result["CUP", "1"] == {
        "product_description": "CUP", "stock_code": "1", "net_units_sold": 3,
        "net_revenue": 3.0 - 4.0 - 3.0 + 6.0 + 1.0, "total_cancellations": 1,
        "distinct_transactions": 6,
    }


@pytest.mark.parametrize("n_tasks", [1, 7, 50])
def test_product_metrics_over_a_number_of_tasks(spark, lines, n_tasks):
    """Odd lines twice, lines without any cell of the key, and a product with most of the lines."""
    odd = [line("8", 1, "2", product=None, code=None), line("8", 5, "2", product=None, code=None)]
    hot = [line(f"{'C' * (i % 5 == 0)}{i // 2}", i % 3, "0.5", product="BAG", code="2") for i in range(400)]
    no_invoice = [(None, *line("9", 4, "1")[1:]), (None, *line("9", 4, "1", product="BAG", code="2")[1:])]
    given_lines = lines.unionByName(lines).unionByName(spark.createDataFrame(odd + hot + no_invoice, SILVER_SCHEMA))
    plain, spread = gold.product_metrics(given_lines), gold.product_metrics(given_lines, n_tasks)
    assert spread.schema == plain.schema
    keys = ("product_description", "stock_code")
    found = rows(spread, *keys)
    assert found == rows(plain, *keys) and len(found) == 4
    assert found["CUP", "1"]["distinct_transactions"] == 6
    assert found["BAG", "2"]["distinct_transactions"] == len({row[0] for row in hot})
    assert found[None, None]["distinct_transactions"] == 1


def test_product_metrics_hold_a_share_of_the_lines_a_task(spark, lines):
    """Pairs of product and invoice are grouped behind the shuffle only, over the tasks asked for."""
    plan = gold.product_metrics(lines, 7)._jdf.queryExecution().executedPlan().toString()
    pairs = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "invoice_no" in x]
    assert len(pairs) == 1 and ", 7)" in pairs[0]
    assert "HashAggregate" not in plan[plan.index(pairs[0]):]


def test_tasks_grow_with_the_lines(spark, monkeypatch):
    import __spark_entry__ as entry_point

    def result(name):
        return sorted(map(str, entry_point.queries()[name](spark, SF).collect()))

    names = ("gold_product_metrics", "gold_product_positions")
    plain = {name: result(name) for name in names}
    lines = given.table(spark, SF, "lineitem").count()
    assert given.line_tasks(spark, SF) is None
    monkeypatch.setattr(given, "LINES_PER_TASK", 100)
    n_tasks = given.line_tasks(spark, SF)
    assert n_tasks == -(-lines // 100) > spark.sparkContext.defaultParallelism
    assert {name: result(name) for name in names} == plain
    assert sorted(map(str, given.bronze(spark, SF, n_tasks).collect())) == result("bronze_raw")
    joined = given.raw_text(spark, SF, n_tasks)._jdf.queryExecution().executedPlan().toString()
    assert f", {n_tasks}), REPARTITION_BY_NUM" in joined
    monkeypatch.setattr(given, "LINES_PER_TASK", 50)
    assert given.line_tasks(spark, SF) == -(-lines // 50)


def test_country_metrics_leave_guests_out_of_customers_only(lines):
    result = rows(gold.country_metrics(lines), "country")
    assert result["FR",] == {
        "country": "FR", "total_registered_customers": 2, "total_invoices": 3, "net_revenue": 7.0,
    }
    assert result["UK",]["total_registered_customers"] == 2
    assert result["UK",]["total_invoices"] == 3  # the cancelled invoice counts


def test_monthly_trends(lines):
    result = rows(gold.monthly_trends(lines), "invoice_year_month")
    assert set(result) == {("2010-01",), ("2010-02",), ("2010-03",), (None,)}
    january = result["2010-01",]
    assert january["net_monthly_revenue"] == january["gross_monthly_revenue"] == 15.0
    assert january["total_refunded_amount"] == 0.0 and january["return_rate"] == 0.0
    february = result["2010-02",]
    assert february["gross_monthly_revenue"] == 0.0 and february["return_rate"] is None
    assert february["total_refunded_amount"] == 3.0 and february["net_monthly_revenue"] == -3.0
    undated = result[None,]
    assert undated["net_monthly_revenue"] is None and undated["monthly_transactions"] == 1


def test_rfm_skips_guests_and_keeps_one_row_per_country(lines):
    result = rows(gold.customer_rfm(lines), "customer_id", "country")
    assert set(result) == {(1, "UK"), (1, "FR"), (2, "UK"), (2, "FR")}
    assert result[1, "UK"]["frequency_of_purchase"] == 2
    assert result[1, "UK"]["monetary_value"] == 9.0
    assert result[1, "UK"]["average_order_value"] == 3.0  # a mean over lines
    assert result[1, "UK"]["last_purchase_date"] == datetime(2010, 1, 5)
    assert result[2, "FR"]["last_purchase_date"] is None
    assert result[2, "FR"]["average_order_value"] is None


def test_report_order(lines):
    order = [r["country"] for r in gold.in_report_order(COUNTRY, gold.country_metrics(lines)).collect()]
    assert order == ["FR", "UK"] or order == ["UK", "FR"]
    values = [r["monetary_value"] for r in gold.in_report_order(RFM, gold.customer_rfm(lines)).collect()]
    assert values[-1] is None and values[:-1] == sorted(values[:-1], reverse=True)
    months = [r[0] for r in gold.in_report_order(MONTHLY, gold.monthly_trends(lines)).collect()]
    assert months == [None, "2010-01", "2010-02", "2010-03"]


@pytest.fixture(scope="module")
def tables(spark):
    silver = given.silver_lines(spark, SF).cache()
    yield {name: build(silver) for name, build in gold.BUILDERS.items()}
    silver.unpersist()


def total(frame, column):
    return frame.agg(F.sum(F.col(column).cast("decimal(38,4)"))).first()[0]


def test_all_rollups_add_up_to_the_fact(tables):
    net = total(tables[FACT], "total_line_price")
    assert net == total(tables[COUNTRY], "net_revenue")
    assert net == total(tables[PRODUCT], "net_revenue")
    assert net == total(tables[MONTHLY], "net_monthly_revenue")
    assert net == total(tables[MONTHLY], "gross_monthly_revenue") - total(
        tables[MONTHLY], "total_refunded_amount"
    )
    units = tables[PRODUCT].agg(F.sum("net_units_sold")).first()[0]
    assert units == tables[FACT].agg(F.sum("quantity")).first()[0]


def test_metrics_come_from_the_rollup(tables):
    assert kpis.metric(tables, "total_net_revenue").first()[0] == pytest.approx(40096752.5)
    by_month = kpis.metric(tables, "month_revenue", invoice_year_month="1997-05")
    assert by_month.count() == 1
    assert kpis.metric(tables, "month_revenue", invoice_year_month=None).count() == 1
    with pytest.raises(ValueError):
        kpis.metric(tables, "month_revenue", country="NATION_1")
    with pytest.raises(ValueError):
        kpis.metric(tables, "churn")
    assert kpis.country_count(tables).first()[0] == 25


@pytest.mark.parametrize(
    "name, filters, source",
    [
        ("total_net_revenue", {}, COUNTRY),
        ("total_net_revenue", {"country": "NATION_7"}, COUNTRY),
        ("total_net_revenue", {"invoice_year": 1997}, MONTHLY),
        ("total_net_revenue", {"invoice_year_month": None}, MONTHLY),
        ("total_net_revenue", {"stock_code": "77"}, PRODUCT),
        ("total_net_revenue", {"stock_code": "77", "country": "NATION_7"}, FACT),
        ("total_net_revenue", {"customer_id": -1}, FACT),
        ("total_gross_revenue", {}, MONTHLY),
        ("total_gross_revenue", {"country": "NATION_7"}, FACT),
        ("refund_total", {"invoice_month": 5}, MONTHLY),
        ("refund_total", {"country": "NATION_7", "invoice_year": 1997}, FACT),
    ],
)
def test_totals_come_from_the_smallest_table_and_agree_with_the_fact(tables, name, filters, source):
    assert kpis.source_of(name, filters) == source
    value = kpis.metric(tables, name, **filters).first()[0]
    lines = tables[FACT]
    for column, wanted in filters.items():
        lines = lines.where(F.col(column).eqNullSafe(F.lit(wanted)))
    if name != "total_net_revenue":
        lines = lines.where(F.col("is_cancelled") == int(name == "refund_total"))
    expected = total(lines.withColumn("total_line_price", F.abs("total_line_price"))
                     if name == "refund_total" else lines, "total_line_price")
    assert value == (None if expected is None else float(expected))


def test_fact_filters(tables):
    fact = tables[FACT]
    done = kpis.fact_lines(tables, cancelled=False)
    assert done.count() + kpis.fact_lines(tables, cancelled=True).count() == fact.count()
    invoice = fact.first()["invoice_no"]
    assert {r[0] for r in kpis.fact_lines(tables, invoice_no=invoice).select("invoice_no").collect()} == {invoice}
    spend = kpis.customer_spend(tables)
    assert spend.where("customer_id = -1").count() == 1
    assert total(spend, "customer_spend") == total(done, "total_line_price")


def test_top_customers_are_ranked(tables):
    top = [r["monetary_value"] for r in kpis.top_customers(tables, 5).collect()]
    everyone = sorted(
        (float(r[0]) for r in tables[RFM].select("monetary_value").collect() if r[0] is not None),
        reverse=True,
    )
    assert top == everyone[:5]


def test_stored_amounts_stay_exact(spark):
    """Two amounts that differ from each other beyond what a DOUBLE holds."""
    lines = spark.sql(
        "SELECT 'C' AS country, 1 AS is_cancelled, CAST(9999999999999.0001 AS DECIMAL(38,4)) AS net_revenue "
        "UNION ALL SELECT 'D', 0, CAST(-9999999999999 AS DECIMAL(38,4))"
    )
    total = kpis.metric({"gold_agg_country_metrics": lines}, "total_net_revenue").first()[0]
    assert total == 0.0001


def test_fact_lines_by_customer_description_and_dates(tables):
    from datetime import date, datetime, timedelta

    one = tables[FACT].where("customer_id > 0 AND invoice_date IS NOT NULL AND product_description IS NOT NULL").first()
    day = one.invoice_date.date()
    found = kpis.fact_lines(
        tables, customer_id=one.customer_id, description=one.product_description, from_date=day, to_date=day
    ).collect()
    expected = tables[FACT].where(
        (F.col("customer_id") == one.customer_id) & (F.col("product_description") == one.product_description)
    ).collect()
    start = datetime.combine(day, datetime.min.time())
    wanted = [r for r in expected if r.invoice_date and start <= r.invoice_date < start + timedelta(days=1)]
    assert sorted(map(str, found)) == sorted(map(str, wanted)) and found
