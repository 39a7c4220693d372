"""Cleansing: raw text rows -> typed sales lines.

One narrow projection and one filter: no shuffle, no Python, any number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.cells import (
    ISO_FORMAT,
    exact_amount,
    not_fitting,
    not_whole,
    timestamp_as_text,
    timestamp_or_null,
    whole_number,
)
from basketry.schema import COLUMN_NAMES, GUEST_ID, SILVER_COLUMNS

DATE_FORMAT = ISO_FORMAT
PRICE_SCALE = 4


def typed(raw: DataFrame, price_scale: int = PRICE_SCALE, strict: bool = True) -> DataFrame:
    """Rename the raw columns and cast the numeric ones."""
    customer = F.coalesce(whole_number("customer_id", "BIGINT", strict), F.lit(GUEST_ID).cast("bigint"))
    numbers = F.struct(
        whole_number("quantity", "INT", strict).alias("quantity"),
        # Decimal prices make every later sum exact and order-independent.
        exact_amount("unit_price", price_scale, strict).alias("unit_price"),
    )
    named = raw.withColumnsRenamed(COLUMN_NAMES)
    rest = [c for c in named.columns if c not in ("quantity", "unit_price")]
    # Through a generator, so that the filter and the line total read the parsed numbers
    # instead of parsing the cells again.
    return named.select(*rest, F.inline(F.array(numbers))).withColumn("customer_id", customer)


def is_valid_line() -> Column:
    """Drop zero quantities and non-positive or missing prices.

    A missing quantity is kept, hence the null-safe comparison; negative
    quantities are returns and are kept too.
    """
    return ~F.col("quantity").eqNullSafe(0) & (F.col("unit_price") > 0)


def is_cancelled(invoice_no: Column) -> Column:
    """1 for invoice numbers starting with C or c; a missing number is not cancelled."""
    return F.coalesce(F.upper(invoice_no).startswith("C"), F.lit(False)).cast("int")


def cleanse(
    raw: DataFrame, date_format: str = DATE_FORMAT, price_scale: int = PRICE_SCALE
) -> DataFrame:
    """The silver table: one row per valid raw line."""
    return _derived(typed(raw, price_scale).where(is_valid_line()), date_format).select(SILVER_COLUMNS)


def dates_as_text(lines: DataFrame, missing: str | None = None) -> DataFrame:
    """Lines whose date is text, for readers that know no timestamps; all else stays.

    The stored date stays a timestamp, which filters and zones are pushed down on.
    """
    return lines.withColumn("invoice_date", timestamp_as_text(F.col("invoice_date"), missing))


def examined(
    raw: DataFrame, date_format: str = DATE_FORMAT, price_scale: int = PRICE_SCALE
) -> DataFrame:
    """Valid lines and rejected ones in one pass, told apart by `reject_reason`.

    `raw` may have a `line_reason` (see `read_raw`) beside the cells; its other columns are
    carried along.  A line is rejected where a cell cannot be read as its type, however its
    other cells are; `raw_cells` then holds the line as it was, as JSON.  Missing cells, and
    lines that are dropped for a zero quantity or a price that is not positive, are no rejects.
    """
    cells = raw.withColumnsRenamed(COLUMN_NAMES)
    if "line_reason" not in cells.columns:
        cells = cells.withColumn("line_reason", F.lit(None).cast("string"))
    texts = {"quantity": "_quantity", "unit_price": "_price", "customer_id": "_customer"}
    kept = cells.withColumns({copy: F.col(name) for name, copy in texts.items()}).withColumn(
        "_cells", F.to_json(F.struct(*COLUMN_NAMES.values()), {"ignoreNullFields": "false"})
    )
    parsed = typed(kept, price_scale, strict=False)
    # A guest's id is missing; an unreadable one would look like a guest's.
    unreadable = whole_number("_customer", "BIGINT", strict=False).isNull()
    reason = F.concat_ws(
        "; ",
        "line_reason",
        F.when(F.col("_quantity").isNotNull() & F.col("quantity").isNull(), F.expr(not_whole("quantity", "_quantity"))),
        F.when(
            F.col("_price").isNotNull() & F.col("unit_price").isNull(),
            F.expr(not_fitting("unit_price", "_price", int(price_scale))),
        ),
        F.when(F.col("_customer").isNotNull() & unreadable, F.expr(not_whole("customer_id", "_customer"))),
    )
    judged = parsed.withColumn("reject_reason", F.nullif(reason, F.lit("")))
    judged = judged.where(F.col("reject_reason").isNotNull() | is_valid_line())
    carried = [c for c in raw.columns if c not in COLUMN_NAMES and c != "line_reason"]
    return (
        _derived(judged, date_format)
        .withColumn("raw_cells", F.when(F.col("reject_reason").isNotNull(), F.col("_cells")))
        .select(*SILVER_COLUMNS, "reject_reason", "raw_cells", *carried)
    )


def _derived(lines: DataFrame, date_format: str) -> DataFrame:
    """Lines with parsed numbers, and the columns that follow from their cells."""
    invoice_date = F.col("invoice_date")
    return (
        lines.withColumns(
            {
                "is_cancelled": is_cancelled(F.col("invoice_no")),
                "total_line_price": F.col("quantity") * F.col("unit_price"),
                "invoice_date": timestamp_or_null(invoice_date, date_format),
            }
        )
        .withColumns(
            {
                "invoice_year_month": F.date_format(invoice_date, "yyyy-MM"),
                "invoice_year": F.year(invoice_date),
                "invoice_month": F.month(invoice_date),
            }
        )
    )
