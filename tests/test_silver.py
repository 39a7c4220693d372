"""Cleansing rules on small hand-written frames."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from basketry.operators import silver
from basketry.schema import MISSING_TOKENS, RAW_COLUMNS, SILVER_COLUMNS
from basketry.sources.raw_csv import normalise

LINE = {
    "Invoice": "489434",
    "StockCode": "85048",
    "Description": "LIGHTS",
    "Quantity": "12",
    "InvoiceDate": "2009-12-01 07:45:00",
    "Price": "6.95",
    "Customer ID": "13085.0",
    "Country": "United Kingdom",
}


def raw(spark, *changes):
    rows = [[{**LINE, **change}[name] for name in RAW_COLUMNS] for change in changes]
    schema = ", ".join(f"`{name}` string" for name in RAW_COLUMNS)
    return normalise(spark.createDataFrame(rows, schema))


def cleansed(spark, *changes, **options):
    return silver.cleanse(raw(spark, *changes), **options).collect()


def test_one_line_in_full(spark):
    result = silver.cleanse(raw(spark, {}))
    assert result.columns == SILVER_COLUMNS
    assert dict(result.dtypes)["total_line_price"] == "decimal(29,4)"
    assert result.first().asDict() == {
        "invoice_no": "489434",
        "stock_code": "85048",
        "product_description": "LIGHTS",
        "quantity": 12,
        "invoice_date": datetime(2009, 12, 1, 7, 45),
        "unit_price": Decimal("6.95"),
        "customer_id": 13085,
        "country": "United Kingdom",
        "is_cancelled": 0,
        "total_line_price": Decimal("83.40"),
        "invoice_year_month": "2009-12",
        "invoice_year": 2009,
        "invoice_month": 12,
    }


def test_missing_tokens_are_missing_in_every_column(spark):
    rows = raw(spark, *[{name: token for name in RAW_COLUMNS} for token in MISSING_TOKENS])
    assert rows.count() == len(MISSING_TOKENS) == 19
    assert all(value is None for row in rows.collect() for value in row)
    kept = raw(spark, {"Description": "nano NA", "StockCode": "na", "Country": " NA"}).first()
    assert (kept["Description"], kept["StockCode"], kept["Country"]) == ("nano NA", "na", " NA")


@pytest.mark.parametrize("quantity", ["0", "", "-1", "1"])
@pytest.mark.parametrize("price", ["", "NaN", "0", "-1", "1"])
def test_only_zero_quantity_and_non_positive_price_are_dropped(spark, quantity, price):
    kept = cleansed(spark, {"Quantity": quantity, "Price": price})
    assert bool(kept) == (price == "1" and quantity != "0")
    if kept and quantity == "":
        assert kept[0]["quantity"] is None and kept[0]["total_line_price"] is None


@pytest.mark.parametrize(
    "invoice, flag", [("C1", 1), ("c1", 1), (" C1", 0), ("1C", 0), ("", 0), ("CX", 1)]
)
def test_cancellation_flag(spark, invoice, flag):
    assert cleansed(spark, {"Invoice": invoice})[0]["is_cancelled"] == flag


@pytest.mark.parametrize("text", ["not a date", "", "2009-13-01 00:00:00", "01/12/2009 07:45"])
def test_unreadable_date_keeps_the_line(spark, text):
    row = cleansed(spark, {"InvoiceDate": text})[0]
    dates = ("invoice_date", "invoice_year_month", "invoice_year", "invoice_month")
    assert [row[name] for name in dates] == [None] * 4


def test_date_format_is_a_parameter(spark):
    row = cleansed(spark, {"InvoiceDate": "1/12/2009 7:45"}, date_format="d/M/yyyy H:mm")[0]
    assert row["invoice_date"] == datetime(2009, 12, 1, 7, 45)


def test_dates_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 is skipped in this zone on that day.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = cleansed(spark, {"InvoiceDate": "2010-03-14 02:30:00"})[0]
        assert row["invoice_date"] == datetime(2010, 3, 14, 2, 30)
        assert row["invoice_year_month"] == "2010-03"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("text, number", [("", -1), ("13085.0", 13085), ("13085", 13085)])
def test_guests_and_customer_numbers(spark, text, number):
    assert cleansed(spark, {"Customer ID": text})[0]["customer_id"] == number


def test_a_fractional_quantity_is_an_error(spark):
    with pytest.raises(PySparkException):
        cleansed(spark, {"Quantity": "6.5"})


def test_price_scale_is_a_parameter(spark):
    row = cleansed(spark, {"Price": "0.123456"}, price_scale=6)[0]
    assert row["unit_price"] == Decimal("0.123456")


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_small_prices_are_kept_exactly(spark, ansi):
    changes = [{"Price": "0.000004"}, {"Price": "0.123456", "Quantity": "2"}, {"Price": "1e-6"}]
    rows = cleansed(spark, *changes, price_scale=6)
    assert [r.unit_price for r in rows] == [Decimal(p) for p in ("0.000004", "0.123456", "0.000001")]
    assert rows[1].total_line_price == Decimal("0.246912")


@pytest.mark.parametrize(
    "change",
    [{"Price": "0.00004"}, {"Price": "abc"}, {"Price": "123456789012345678"}, {"Quantity": "1.5"}, {"Quantity": "x"}],
)
def test_cells_that_do_not_fit_are_errors(spark, ansi, change):
    with pytest.raises(PySparkException, match=next(iter(change.values()))):
        cleansed(spark, change)


def test_whole_quantities_in_other_notations(spark, ansi):
    assert [r.quantity for r in cleansed(spark, {"Quantity": "6.0"}, {"Quantity": "-3"}, {"Quantity": "12.00"})] == [6, -3, 12]


def test_dates_as_text(spark, ansi):
    lines = silver.cleanse(raw(spark, {}, {"InvoiceDate": "2010-01-02 00:00:00"}, {"InvoiceDate": "soon"}))
    text = silver.dates_as_text(lines)
    assert text.columns == SILVER_COLUMNS and dict(text.dtypes)["invoice_date"] == "string"
    assert [r.invoice_date for r in text.collect()] == ["2009-12-01 07:45:00", "2010-01-02 00:00:00", None]
    assert [r.invoice_date for r in silver.dates_as_text(lines, "NaT").collect()][2] == "NaT"
    assert text.drop("invoice_date").collect() == lines.drop("invoice_date").collect()
    assert silver.dates_as_text(lines.limit(0)).count() == 0
    parts = spark.sql("SELECT TIMESTAMP_NTZ'2010-01-02 03:04:05.25' AS invoice_date")
    assert silver.dates_as_text(parts).first().invoice_date == "2010-01-02 03:04:05.250000"


def test_each_cell_is_parsed_once(spark):
    from basketry.plans import driver_tables as given

    lines = given.silver_lines(spark, "/root/testdata/sf0.001")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("quantity is not a whole number") == 1
    assert plan.count("unit_price does not fit") == 1
    assert plan.count("customer_id is not a whole number") == 1
