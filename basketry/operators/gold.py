"""Gold tables: the sales fact and its four aggregates.

Every aggregate is a plain grouped aggregation.  Sums combine before the
shuffle, and a distinct count is shuffled on (group, value), so a group holding
a large share of all lines (one country, one product, one month) is spread over
all tasks and only its partial results meet.  Amounts stay exact decimals, so that
they can be added up further; they become DOUBLE where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.cells import money
from basketry.schema import COUNTRY, FACT, GUEST_ID, MONTHLY, PRODUCT, RFM


def sales_fact(silver: DataFrame) -> DataFrame:
    """The fact table is the silver table, unchanged."""
    return silver


def product_metrics(silver: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """Per (description, code): units, revenue, cancelled lines, invoices.

    There are nearly as many (product, invoice) pairs as lines, so combining pairs before the
    shuffle saves nothing and holds a task's lines in memory.  With `n_tasks` the lines are
    hashed by pair over so many tasks first: what a task holds is then its share of the lines,
    whatever the session's number of shuffle partitions.
    """
    keys = ["product_description", "stock_code"]
    if n_tasks:
        lines = silver.select(*keys, "invoice_no", "quantity", "total_line_price", "is_cancelled")
        silver = lines.repartition(n_tasks, *keys, "invoice_no")
    return silver.groupBy(*keys).agg(
        F.sum("quantity").alias("net_units_sold"),
        F.sum("total_line_price").alias("net_revenue"),
        F.sum("is_cancelled").alias("total_cancellations"),
        F.count_distinct("invoice_no").alias("distinct_transactions"),
    )


def country_metrics(silver: DataFrame) -> DataFrame:
    """Per country: known customers, invoices (cancelled ones included), revenue.

    Two distinct counts multiply the rows they read, so the lines are first summed
    to one row per invoice; exact sums make the order of summing irrelevant.
    """
    invoices = silver.groupBy("country", "invoice_no", "customer_id").agg(
        F.sum("total_line_price").alias("invoice_total")
    )
    known_customer = F.when(F.col("customer_id") != GUEST_ID, F.col("customer_id"))
    return invoices.groupBy("country").agg(
        F.count_distinct(known_customer).alias("total_registered_customers"),
        F.count_distinct("invoice_no").alias("total_invoices"),
        F.sum("invoice_total").alias("net_revenue"),
    )


def monthly_trends(silver: DataFrame) -> DataFrame:
    """Per month: net, gross and refunded amounts, return rate, invoices.

    Lines without a readable date form a month of their own with NULL keys.
    """

    def total_where(cancelled: int, amount: Column) -> Column:
        return F.sum(F.when(F.col("is_cancelled") == cancelled, amount).otherwise(0))

    amount = F.col("total_line_price")
    gross = total_where(0, amount)
    refunded = total_where(1, F.abs(amount))
    return silver.groupBy("invoice_year_month", "invoice_year", "invoice_month").agg(
        F.sum(amount).alias("net_monthly_revenue"),
        gross.alias("gross_monthly_revenue"),
        refunded.alias("total_refunded_amount"),
        (money(refunded) / F.nullif(money(gross), F.lit(0.0))).alias("return_rate"),
        F.count_distinct("invoice_no").alias("monthly_transactions"),
    )


def customer_rfm(silver: DataFrame) -> DataFrame:
    """Per known (customer, country): last purchase, invoices, spend, mean line price."""
    amount = F.col("total_line_price")
    return (
        silver.where(F.col("customer_id") != GUEST_ID)
        .groupBy("customer_id", "country")
        .agg(
            F.max("invoice_date").alias("last_purchase_date"),
            F.count_distinct("invoice_no").alias("frequency_of_purchase"),
            F.sum(amount).alias("monetary_value"),
            (money(F.sum(amount)) / F.nullif(F.count(amount), F.lit(0))).alias(
                "average_order_value"
            ),
        )
    )


BUILDERS = {
    FACT: sales_fact,
    PRODUCT: product_metrics,
    COUNTRY: country_metrics,
    MONTHLY: monthly_trends,
    RFM: customer_rfm,
}

# Row order of each aggregate, stored and read as a report; key columns break ties.
_REPORT_ORDER = {
    PRODUCT: ([("net_revenue", False)], ["product_description", "stock_code"]),
    COUNTRY: ([("net_revenue", False)], ["country"]),
    MONTHLY: ([("invoice_year_month", True)], ["invoice_year", "invoice_month"]),
    RFM: ([("monetary_value", False)], ["customer_id", "country"]),
}


def in_report_order(name: str, table: DataFrame) -> DataFrame:
    """Sort an aggregate; so it is published, and `Lake.report` reads it back without a sort."""
    measures, keys = _REPORT_ORDER[name]
    return table.orderBy(
        *[F.col(c).asc() if ascending else F.col(c).desc() for c, ascending in measures], *keys
    )
