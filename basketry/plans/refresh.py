"""Full refresh of the layers: raw files -> bronze -> silver -> gold tables.

Each layer is one Spark job per table, written and then read back, so silver is
cleansed once however many gold tables are built from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from basketry.functions.cells import money
from basketry.operators import gold, layout, partials, silver
from basketry.schema import (
    BRONZE,
    EXAMINED,
    FACT,
    NUMBERS,
    PARTIALS,
    REJECTS,
    SILVER,
    SILVER_COLUMNS,
    ZONES,
)
from basketry.sources.raw_csv import read_raw
from basketry.sources.tables import Lake, Snapshot

MONTH = "invoice_year_month"


def published(rows: DataFrame) -> DataFrame:
    """Rows for reading: exact decimal amounts, as the tables keep them, as DOUBLE."""
    amounts = [name for name, kind in rows.dtypes if kind.startswith("decimal")]
    return rows.withColumns({name: money(F.col(name)) for name in amounts})


def row_counts(raw: DataFrame, price_scale: int = silver.PRICE_SCALE) -> DataFrame:
    """layer, row_count for bronze and silver, from one pass over the raw lines."""
    counted = silver.typed(raw, price_scale).agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(silver.is_valid_line()).alias("valid_rows")
    )
    layers = {BRONZE: "raw_rows", SILVER: "valid_rows"}
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(layer).alias("layer"), F.col(name).alias("row_count"))
                    for layer, name in layers.items()
                ]
            )
        )
    )


def ingest(lake: Lake, csv_path: str, multi_line: bool | None = None) -> int:
    """Raw files into the bronze table; returns its row count."""
    return lake.replace_counted(BRONZE, read_raw(lake.spark, csv_path, multi_line))


def cleanse(
    lake: Lake,
    date_format: str = silver.DATE_FORMAT,
    price_scale: int = silver.PRICE_SCALE,
    by_month: bool = False,
) -> int:
    """Bronze into silver; returns its row count."""
    lines = silver.cleanse(lake.table(BRONZE), date_format, price_scale)
    return lake.replace_counted(SILVER, lines, MONTH if by_month else None)


def cleanse_with_rejects(
    lake: Lake,
    csv_path: str,
    date_format: str = silver.DATE_FORMAT,
    multi_line: bool | None = None,
    price_scale: int = silver.PRICE_SCALE,
) -> dict[str, int]:
    """Raw files into silver and rejects, in one pass and one write; returns the row counts.

    Silver and the rejects are views of the two partitions of one table, so either reads
    its own files only.  No line is lost or changed: what cannot be read is a reject with
    its reason, file, block and cells.
    """
    seen = Observation()
    raw = read_raw(lake.spark, csv_path, multi_line, places=True).observe(
        seen, F.count(F.lit(1)).alias("raw")
    )
    judged, kept = F.col("reject_reason").isNotNull(), Observation()
    rows = silver.examined(raw, date_format, price_scale).withColumn("rejected", judged)
    counted = rows.observe(kept, F.count_if(judged).alias("rejected"), F.count_if(~judged).alias("valid"))
    lake.replace(EXAMINED, counted, "rejected")
    lake.view(SILVER, EXAMINED, ", ".join(SILVER_COLUMNS), "NOT rejected")
    lake.view(REJECTS, EXAMINED, "reject_reason, source_file, source_block, raw_cells", "rejected")
    return {BRONZE: seen.get["raw"], SILVER: kept.get["valid"], REJECTS: kept.get["rejected"]}


def publish_clustered_fact(lake: Lake, rows_per_file: int = layout.ROWS_PER_FILE) -> None:
    """Silver into a fact clustered by month, country and product, and the zones of its files."""
    lines = lake.table(SILVER).select(SILVER_COLUMNS)
    lake.replace(FACT, layout.clustered(lines, rows_per_file=rows_per_file))
    lake.replace(ZONES, layout.zones(lake.table(FACT)))


def publish(lake: Lake, copy_fact: bool = False, by_month: bool = False, cluster: bool = False) -> None:
    """Silver into the gold tables.

    The fact equals silver line by line.  It is published as a view unless a
    copy is asked for, which rewrites all lines to keep them when silver changes, or a
    clustered copy, whose files `kpis.fact_lines` can leave out.  The aggregates are stored
    in report order.
    The lines are scanned once, for the partials that all aggregates derive from.
    """
    lines = lake.table(SILVER).select(SILVER_COLUMNS)
    if not cluster:
        lake.drop(ZONES)
    if cluster:
        publish_clustered_fact(lake)
    elif copy_fact:
        lake.replace(FACT, gold.sales_fact(lines))
    else:
        lake.view(FACT, SILVER, ", ".join(SILVER_COLUMNS))
    lake.replace(PARTIALS, partials.partials(lines), MONTH if by_month else None)
    parts = lake.table(PARTIALS)
    for name, build in partials.BUILDERS.items():
        lake.replace_in_order(name, build(parts))


def publish_sets(lake: Lake) -> None:
    """Partials into sets of invoices and customers that can be united, and their numbers."""
    parts = lake.table(PARTIALS)
    numbers = {}
    for kind, name in NUMBERS.items():
        lake.replace(f"{name}_placed", partials.placed(partials.members(parts, kind)))
        lake.replace(name, partials.numbered(lake.table(f"{name}_placed")))
        lake.drop(f"{name}_placed")
        numbers[kind] = lake.table(name)
    for name, keys in partials.SET_GROUPS.items():
        lake.replace(name, partials.sets_of(parts, keys, numbers))


def refresh_month(
    lake: Lake,
    month: str,
    csv_path: str,
    date_format: str = silver.DATE_FORMAT,
    multi_line: bool | None = None,
    price_scale: int = silver.PRICE_SCALE,
) -> int:
    """Replace one month (`yyyy-MM`) of a lake refreshed `by_month`; returns its valid lines.

    `csv_path` names the month's raw files, the only ones that are read.  They hold all its
    lines and none of other months or without a readable date, which would be an error.
    The tables become those of a full refresh: groups that lost or gained lines are built
    anew from the partials, all others stay.  Everything is computed before the first
    table changes, and the state last, so that a month interrupted there can be repeated.
    Sets are built anew by `publish_sets`.  Not for lakes with bronze or a copied fact,
    which would keep the old lines.
    """
    if lake.exists(BRONZE) or not lake._is_view(FACT):
        raise ValueError("a month can be refreshed without bronze and with the fact as a view only")
    seen = Observation()
    outside = F.count_if(~F.col(MONTH).eqNullSafe(month))
    lines = silver.cleanse(read_raw(lake.spark, csv_path, multi_line), date_format, price_scale)
    lake.replace(f"{SILVER}_staged", lines.observe(seen, F.count(F.lit(1)).alias("rows"), outside.alias("outside")))
    if seen.get["outside"]:
        lake.drop(f"{SILVER}_staged")
        raise ValueError(f"{seen.get['outside']} lines are not of {month}")
    came = lake.table(f"{SILVER}_staged")
    lake.replace(f"{PARTIALS}_staged", partials.partials(came))
    new = lake.table(f"{PARTIALS}_staged")
    parts = lake.table(PARTIALS).select(new.columns)
    gone = parts.where(F.col(MONTH) == month)
    now = parts.where(~F.col(MONTH).eqNullSafe(month)).unionByName(new)
    for name in partials.BUILDERS:
        changed = gone.unionByName(new)
        lake.replace(f"{name}_staged", partials.refreshed(name, lake.table(name), now, changed))
    for name in partials.BUILDERS:
        lake.replace_in_order(name, lake.table(f"{name}_staged"))
    lake.replace_partition(PARTIALS, MONTH, month, new)
    lake.replace_partition(SILVER, MONTH, month, came)
    for name in [SILVER, PARTIALS, *partials.BUILDERS]:
        lake.drop(f"{name}_staged")
    return seen.get["rows"]


def refresh(
    spark: SparkSession,
    csv_path: str,
    database: str = "default",
    date_format: str = silver.DATE_FORMAT,
    multi_line: bool | None = None,
    keep_bronze: bool = True,
    copy_fact: bool = False,
    price_scale: int = silver.PRICE_SCALE,
    by_month: bool = False,
    sets: bool = False,
    snapshot: bool = False,
    quarantine: bool = False,
    cluster: bool = False,
) -> dict[str, int]:
    """All layers in one go; returns the row counts of bronze and silver.

    Without bronze the raw files are cleansed as they are read.  `by_month` partitions
    silver and the partials by month, for `refresh_month`.  `sets` keeps sets of invoices
    and customers, for distinct counts of unions.  With `snapshot` the tables are a new
    version, which is published when all of them are written (`Snapshot.current`).
    With `quarantine` lines that cannot be read are kept as rejects and counted, where they
    are errors otherwise; it needs neither bronze nor `by_month`.  `cluster` publishes a
    copy of the fact clustered by month, country and product.
    """
    if quarantine and (keep_bronze or by_month):
        raise ValueError("quarantine cleanses the raw files as they are read: no bronze, no months")
    lake = Snapshot.new(spark, database) if snapshot else Lake(spark, database)
    if quarantine:
        counts = cleanse_with_rejects(lake, csv_path, date_format, multi_line, price_scale)
    elif keep_bronze:
        raw_rows = ingest(lake, csv_path, multi_line)
        counts = {BRONZE: raw_rows, SILVER: cleanse(lake, date_format, price_scale, by_month)}
    else:
        seen = Observation()
        raw = read_raw(spark, csv_path, multi_line).observe(seen, F.count(F.lit(1)).alias("rows"))
        lines = silver.cleanse(raw, date_format, price_scale)
        valid = lake.replace_counted(SILVER, lines, MONTH if by_month else None)
        counts = {BRONZE: seen.get["rows"], SILVER: valid}
    publish(lake, copy_fact, by_month, cluster)
    if sets:
        publish_sets(lake)
    if snapshot:
        lake.publish()
    return counts
