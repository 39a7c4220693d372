"""Names and types of the raw, silver and gold tables."""

from __future__ import annotations

# Raw header -> silver column.
COLUMN_NAMES = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "product_description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
RAW_COLUMNS = list(COLUMN_NAMES)

# Texts a raw cell may hold when its value is missing.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

GUEST_ID = -1

BRONZE = "bronze_sales_raw"
SILVER = "silver_sales_cleansed"
FACT = "gold_fact_sales"
PRODUCT = "gold_agg_product_metrics"
COUNTRY = "gold_agg_country_metrics"
MONTHLY = "gold_agg_monthly_trends"
RFM = "gold_agg_customer_rfm"

# State beside the gold tables: what they are built from, and sets that can be united.
PARTIALS = "gold_state_partials"
NUMBERS = {"invoices": "gold_state_invoice_numbers", "customers": "gold_state_customer_numbers"}

# What a clustered fact is laid out by, and the ranges of these columns in each of its files.
CLUSTERED_BY = ("invoice_year_month", "country", "stock_code")
ZONES = "gold_state_fact_zones"

# Lines that could not be read, beside silver.
EXAMINED, REJECTS = "silver_sales_examined", "silver_sales_rejects"

# The only tables an ad-hoc query may read.
GOLD_TABLES = (FACT, PRODUCT, COUNTRY, MONTHLY, RFM)

SILVER_COLUMNS = [
    "invoice_no",
    "stock_code",
    "product_description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
    "is_cancelled",
    "total_line_price",
    "invoice_year_month",
    "invoice_year",
    "invoice_month",
]
