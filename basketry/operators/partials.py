"""One shared aggregate of the lines, and distinct counts that can be merged.

Partials have one row per invoice, customer, country, month and product.  All four gold
aggregates follow from them, so the lines are scanned once.  Their sums stay exact
decimals, and a distinct count over partials is the one over lines.

Distinct counts cannot be added up, sets can be united.  Invoices and customers have dense
numbers (a dictionary table); a group's set is kept as containers, one per bucket of
32,768 numbers: the sorted positions while there are few, a bitmap beyond.  The distinct
count of any union of groups is the number of bits of their united containers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.cells import money
from basketry.schema import COUNTRY, GUEST_ID, MONTHLY, PRODUCT, RFM

MONTH_KEYS = ["invoice_year_month", "invoice_year", "invoice_month"]
PARTIAL_KEYS = [
    "invoice_no",
    "is_cancelled",
    "customer_id",
    "country",
    *MONTH_KEYS,
    "product_description",
    "stock_code",
]

# Group columns of each aggregate.
GROUPS = {
    PRODUCT: ["product_description", "stock_code"],
    COUNTRY: ["country"],
    MONTHLY: MONTH_KEYS,
    RFM: ["customer_id", "country"],
}


def partials(lines: DataFrame) -> DataFrame:
    """One row per combination of `PARTIAL_KEYS`, with sums, counts and the last date."""
    amount = F.col("total_line_price")
    return lines.groupBy(*PARTIAL_KEYS).agg(
        F.sum("quantity").alias("units"),
        F.sum(amount).alias("amount"),
        F.sum(F.abs(amount)).alias("size"),
        F.count(amount).alias("priced_lines"),
        F.count(F.lit(1)).alias("lines"),
        F.max("invoice_date").alias("last_date"),
    )


def product_metrics(parts: DataFrame) -> DataFrame:
    """As `gold.product_metrics`, from partials."""
    return parts.groupBy(*GROUPS[PRODUCT]).agg(
        F.sum("units").alias("net_units_sold"),
        F.sum("amount").alias("net_revenue"),
        F.sum(F.col("is_cancelled") * F.col("lines")).alias("total_cancellations"),
        F.count_distinct("invoice_no").alias("distinct_transactions"),
    )


def country_metrics(parts: DataFrame) -> DataFrame:
    """As `gold.country_metrics`, from partials."""
    invoices = parts.groupBy("country", "invoice_no", "customer_id").agg(F.sum("amount").alias("total"))
    known = F.when(F.col("customer_id") != GUEST_ID, F.col("customer_id"))
    return invoices.groupBy("country").agg(
        F.count_distinct(known).alias("total_registered_customers"),
        F.count_distinct("invoice_no").alias("total_invoices"),
        F.sum("total").alias("net_revenue"),
    )


def monthly_trends(parts: DataFrame) -> DataFrame:
    """As `gold.monthly_trends`, from partials."""

    def total_where(cancelled: int, amount: str) -> Column:
        return F.sum(F.when(F.col("is_cancelled") == cancelled, F.col(amount)).otherwise(0))

    gross, refunded = total_where(0, "amount"), total_where(1, "size")
    return parts.groupBy(*MONTH_KEYS).agg(
        F.sum("amount").alias("net_monthly_revenue"),
        gross.alias("gross_monthly_revenue"),
        refunded.alias("total_refunded_amount"),
        (money(refunded) / F.nullif(money(gross), F.lit(0.0))).alias("return_rate"),
        F.count_distinct("invoice_no").alias("monthly_transactions"),
    )


def customer_rfm(parts: DataFrame) -> DataFrame:
    """As `gold.customer_rfm`, from partials."""
    spent, priced = F.sum("amount"), F.sum("priced_lines")
    return (
        parts.where(F.col("customer_id") != GUEST_ID)
        .groupBy(*GROUPS[RFM])
        .agg(
            F.max("last_date").alias("last_purchase_date"),
            F.count_distinct("invoice_no").alias("frequency_of_purchase"),
            spent.alias("monetary_value"),
            (money(spent) / F.nullif(priced, F.lit(0))).alias("average_order_value"),
        )
    )


BUILDERS = {PRODUCT: product_metrics, COUNTRY: country_metrics, MONTHLY: monthly_trends, RFM: customer_rfm}


def _matches(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition &= left[key].eqNullSafe(right[key])
    return condition


def refreshed(name: str, old: DataFrame, parts: DataFrame, changed: DataFrame) -> DataFrame:
    """An aggregate after some partials changed: its groups among them anew, the others as they are.

    `parts` are all partials as they are now; `changed` holds the partials that went and
    those that came.  A group all of whose partials went is left out.
    """
    keys = GROUPS[name]
    groups = changed.select(*keys).distinct()
    own = parts.join(groups, _matches(keys, parts, groups), "left_semi")
    untouched = old.join(groups, _matches(keys, old, groups), "left_anti")
    return untouched.unionByName(BUILDERS[name](own))


# Sets that can be united

BUCKET_SIZE = 1 << 15  # positions of Spark's bitmaps
FEW = 1 << 10  # positions up to which a container lists them

# What a set is kept of: the member, and which partials hold one.
MEMBERS = {
    "invoices": F.col,
    "customers": lambda name: F.when(F.col(name) != GUEST_ID, F.col(name)),
}
MEMBER_COLUMNS = {"invoices": "invoice_no", "customers": "customer_id"}

# The group columns that sets are kept for, by the name of the table.
SET_GROUPS = {
    "gold_sets_country": GROUPS[COUNTRY],
    "gold_sets_month": GROUPS[MONTHLY],
    "gold_sets_product": GROUPS[PRODUCT],
}


def placed(values: DataFrame) -> DataFrame:
    """(value, part, at): distinct values and where each stands; write it before `numbered`."""
    place = F.monotonically_increasing_id()
    return values.distinct().select(
        "value", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")
    )


def numbered(places: DataFrame) -> DataFrame:
    """(value, number) with numbers 0 to n - 1, from written `placed` values.

    Only the rows per part, one row per task of the write, are brought together.
    """
    from pyspark.sql import Window

    sizes = places.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return places.join(starts, "part").select("value", (F.col("start") + F.col("at")).alias("number"))


def members(parts: DataFrame, kind: str) -> DataFrame:
    """The distinct members of a kind, as column `value`; none for missing ones."""
    value = MEMBERS[kind](MEMBER_COLUMNS[kind])
    return parts.select(value.alias("value")).where("value IS NOT NULL").distinct()


def sets_of(parts: DataFrame, keys: Sequence[str], numbers: Mapping[str, DataFrame]) -> DataFrame:
    """(keys, kind, bucket, positions, bits): each group's sets, for every kind in `numbers`.

    A container has either positions or bits.  Pairs of group and member are made distinct
    before they meet, so a group with a third of all lines is spread over all tasks.
    """
    every = None
    for kind, number in numbers.items():
        value = MEMBERS[kind](MEMBER_COLUMNS[kind])
        pairs = parts.select(*keys, value.alias("value")).distinct().join(number, "value")
        rows = pairs.select(
            *keys,
            F.lit(kind).alias("kind"),
            F.expr(f"number div {BUCKET_SIZE}").alias("bucket"),
            (F.col("number") % BUCKET_SIZE).cast("int").alias("position"),
        )
        every = rows if every is None else every.unionByName(rows)
    grouped = every.groupBy(*keys, "kind", "bucket").agg(F.sort_array(F.collect_list("position")).alias("positions"))
    few = grouped.where(F.size("positions") <= FEW).withColumn("bits", F.lit(None).cast("binary"))
    many = (
        grouped.where(F.size("positions") > FEW)
        .select(*keys, "kind", "bucket", F.explode("positions").alias("position"))
        .groupBy(*keys, "kind", "bucket")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .withColumn("positions", F.lit(None).cast("array<int>"))
    )
    return few.unionByName(many)


def united_count(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, kind, members): distinct members of the union of all sets, per combination of `by`."""
    keys = [*by, "kind", "bucket"]
    few = sets.where("bits IS NULL").select(*keys, F.explode("positions").alias("position"))
    listed = few.groupBy(*keys).agg(F.bitmap_construct_agg("position").alias("bits"))
    united = (
        sets.where("bits IS NOT NULL").select(*keys, "bits").unionByName(listed)
        .groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    return united.groupBy(*by, "kind").agg(F.sum(F.bitmap_count("bits")).alias("members"))
