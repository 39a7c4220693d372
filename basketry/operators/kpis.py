"""Ready-made business metrics, each answered from the smallest gold table holding it.

Only additive measures are re-aggregated from a rollup; a distinct count of
customers or invoices cannot be added up across groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from basketry.functions.cells import money
from basketry.operators.layout import without_other_zones
from basketry.operators.partials import SET_GROUPS, members, united_count
from basketry.schema import CLUSTERED_BY, COUNTRY, FACT, MONTHLY, PRODUCT, RFM, ZONES

Tables = Mapping[str, DataFrame]

# What a rollup can be filtered by.
ROLLUP_KEYS = {
    COUNTRY: {"country"},
    MONTHLY: {"invoice_year_month", "invoice_year", "invoice_month"},
    PRODUCT: {"stock_code", "product_description"},
}

# Totals: the column of each rollup that holds them, smallest rollup first, and
# what to sum over the fact when no rollup has the wanted filter.
TOTALS = {
    "total_net_revenue": (
        {COUNTRY: "net_revenue", MONTHLY: "net_monthly_revenue", PRODUCT: "net_revenue"},
        "total_line_price",
    ),
    "total_gross_revenue": (
        {MONTHLY: "gross_monthly_revenue"},
        "CASE WHEN is_cancelled = 0 THEN total_line_price ELSE 0 END",
    ),
    "refund_total": (
        {MONTHLY: "total_refunded_amount"},
        "CASE WHEN is_cancelled = 1 THEN abs(total_line_price) ELSE 0 END",
    ),
}

# Breakdowns: rollup rows as they are.
BREAKDOWNS = {
    "country_revenue": (COUNTRY, ["country", "net_revenue"]),
    "month_revenue": (
        MONTHLY,
        ["invoice_year_month", "net_monthly_revenue", "gross_monthly_revenue"],
    ),
    "product_revenue": (PRODUCT, ["product_description", "stock_code", "net_revenue"]),
}


def _where(rows: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    for column, value in filters.items():
        rows = rows.where(F.col(column).eqNullSafe(F.lit(value)))
    return rows


def source_of(name: str, filters: Mapping[str, object]) -> str:
    """The table that answers a metric: a rollup if one has all filters, else the fact."""
    if name in BREAKDOWNS:
        table = BREAKDOWNS[name][0]
        unknown = set(filters) - ROLLUP_KEYS[table]
        if unknown:
            raise ValueError(f"{name} cannot be filtered by {sorted(unknown)}")
        return table
    if name not in TOTALS:
        raise ValueError(f"unknown metric {name}; known: {sorted([*TOTALS, *BREAKDOWNS])}")
    rollups, _ = TOTALS[name]
    return next((table for table in rollups if set(filters) <= ROLLUP_KEYS[table]), FACT)


def metric(tables: Tables, name: str, **filters: object) -> DataFrame:
    """A metric by name: a total in one row, or a breakdown."""
    source = source_of(name, filters)
    rows = _where(tables[source], filters)
    if name in BREAKDOWNS:
        amounts = {c: money(F.col(c)) for c in BREAKDOWNS[name][1] if c.endswith("revenue")}
        return rows.select(*BREAKDOWNS[name][1]).withColumns(amounts)
    rollups, line_amount = TOTALS[name]
    amount = F.expr(line_amount if source == FACT else rollups[source])
    return rows.agg(money(F.sum(amount)).alias(name))


# Distinct counts: the kind of member they count.
UNIONS = {"distinct_invoices": "invoices", "distinct_customers": "customers"}


def sets_source(filters: Mapping[str, object]) -> str:
    """The table of sets whose groups have all filters."""
    return next((name for name, keys in SET_GROUPS.items() if set(filters) <= set(keys)), FACT)


def distinct_members(tables: Tables, name: str, **filters: Sequence[object]) -> DataFrame:
    """Distinct invoices or known customers of any union of countries, months or products.

    Each filter takes a list of values, a None for lines without one.  Groups are united
    from their sets; where no table of sets has all filters, the fact is counted.
    """
    kind = UNIONS[name]
    source = sets_source(filters)
    rows = tables[source]
    for column, values in filters.items():
        wanted = F.lit(False)
        for value in values:
            wanted |= F.col(column).eqNullSafe(F.lit(value))
        rows = rows.where(wanted)
    if source == FACT:
        counted = members(rows, kind).agg(F.count("value").alias(name))
    else:
        united = united_count(rows.where(F.col("kind") == kind))
        counted = united.agg(F.coalesce(F.sum("members"), F.lit(0)).alias(name))
    return counted


def country_count(tables: Tables) -> DataFrame:
    """How many countries are sold to."""
    return tables[COUNTRY].agg(F.count("country").alias("country_count"))


def top_customers(tables: Tables, k: int = 10) -> DataFrame:
    """Customers by spend; a heap of k rows per task, never a full sort."""
    return (
        tables[RFM]
        .select("customer_id", "country", money(F.col("monetary_value")).alias("monetary_value"))
        .orderBy(F.col("monetary_value").desc(), "customer_id", "country")
        .limit(k)
    )


def customer_spend(tables: Tables) -> DataFrame:
    """Completed purchases per customer; guests are one group, summed before the shuffle."""
    return (
        fact_lines(tables, cancelled=False)
        .groupBy("customer_id")
        .agg(money(F.sum("total_line_price")).alias("customer_spend"))
    )


def fact_lines(
    tables: Tables,
    *,
    cancelled: bool | None = None,
    invoice_no: str | None = None,
    month: str | None = None,
    country: str | None = None,
    stock_code: str | None = None,
    customer_id: int | None = None,
    description: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
) -> DataFrame:
    """Fact lines by business rule; every given condition is a plain, pushable filter.

    Dates count whole days, both ends included; lines without a readable date meet none.
    Of a clustered fact only files that may hold such lines are read, if its zones are given.
    """
    wanted = {
        "is_cancelled": None if cancelled is None else int(cancelled),
        "invoice_no": invoice_no,
        "invoice_year_month": month,
        "country": country,
        "stock_code": stock_code,
        "customer_id": customer_id,
        "product_description": description,
    }
    lines = tables[FACT]
    if tables.get(ZONES) is not None:
        ranges = {c: (wanted[c], wanted[c]) for c in CLUSTERED_BY if wanted[c] is not None}
        if month is None and (from_date or to_date):
            ranges["invoice_year_month"] = tuple(d and d.isoformat()[:7] for d in (from_date, to_date))
        lines = without_other_zones(lines, tables[ZONES], ranges)
    for column, value in wanted.items():
        if value is not None:
            lines = lines.where(F.col(column) == value)
    if from_date is not None:
        lines = lines.where(F.col("invoice_date") >= F.lit(from_date).cast("timestamp_ntz"))
    if to_date is not None:
        after = F.lit(to_date + timedelta(days=1)).cast("timestamp_ntz")
        lines = lines.where(F.col("invoice_date") < after)
    return lines
