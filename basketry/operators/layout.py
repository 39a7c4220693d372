"""How stored tables lie in their files: in an order, or clustered by several columns.

Ordered tables are sorted as a whole before they are written, so the files by name, and the
rows in each file, follow one another.  Readers get that order, and a row's place in it,
from the files alone.

Clustered lines are laid along a Z-order curve over the ranks of several columns, so every
file holds narrow ranges of each of them.  A table of zones, one row per file, keeps these
ranges; a filter on any of the columns leaves out the files that cannot meet it before they
are opened.  Files that the zones do not know are read, so stale zones lose no row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.schema import CLUSTERED_BY

FILE = "_metadata.file_name"
ROWS_PER_FILE = 5_000_000
SMALL_FILES = 256
SAMPLE_ROWS = 100_000
BITS = 5


# Spark names files part-<task>-<id>-c<file of the task>; either number may outgrow its zeros.
def _file_order(name: Column) -> list[Column]:
    return [F.regexp_extract(name, pattern, 1).cast("bigint") for pattern in (r"^part-(\d+)", r"-c(\d+)")]


def in_stored_order(table: DataFrame) -> DataFrame:
    """The rows of a stored table in the order of its files, without a sort.

    A union of the files by name, so one scan each: meant for tables of aggregates.  `take`
    and `collect` keep the order, and `take` opens no more files than it needs.
    """
    files = table.select(F.col(FILE).alias("file")).distinct()
    names = [r["file"] for r in files.orderBy(*_file_order(F.col("file"))).collect()]
    if not names:
        return table
    return reduce(DataFrame.union, [table.where(F.col(FILE) == name) for name in names])


def with_position(table: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a stored table with their place in it from 1, without a sort of the rows.

    Counts per file give each file's offset; only one row per file is put in order.
    """
    place = f"{name}_"
    while place in table.columns:
        place += "_"
    sizes = table.groupBy(F.col(FILE).alias(f"{place}file")).agg(F.count(F.lit(1)).alias(f"{place}rows"))
    before = Window.orderBy(*_file_order(F.col(f"{place}file"))).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        f"{place}file", F.coalesce(F.sum(f"{place}rows").over(before), F.lit(0)).alias(f"{place}offset")
    )
    placed = table.select("*", F.col(FILE).alias(f"{place}file"), F.col("_metadata.row_index").alias(place))
    return placed.join(offsets, f"{place}file").select(
        *table.columns, (F.col(f"{place}offset") + F.col(place) + 1).alias(name)
    )


def edges_of(
    lines: DataFrame, columns: Sequence[str], bins: int, n_lines: int, sample_rows: int = SAMPLE_ROWS
) -> dict[str, list[str]]:
    """Per column at most `bins - 1` values that cut a sample of about `sample_rows` lines evenly.

    They decide how lines lie, never which lines there are.
    """
    fraction = min(1.0, sample_rows / max(n_lines, 1))

    def cuts(column: str) -> Column:
        places = [F.floor(F.size(column) * k / bins).cast("int") for k in range(1, bins)]
        at = F.array(*[F.get(column, place) for place in places])
        return F.array_distinct(F.array_compact(at)).alias(column)

    # Sorted first, in a step of their own: cuts refer to the values many times.
    values = lines.sample(fraction, seed=1).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])
    found = values.select(*[cuts(c) for c in columns]).first()
    return {c: found[c] for c in columns}


def _rank(value: Column, edges: Sequence[str]) -> Column:
    """How many edges are at most the value, by bisection; 0 for NULL."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(edges[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(edges))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """Ranks below 2^bits as one number that takes a bit of each in turn."""
    parts = [
        F.shiftleft(F.shiftright(rank.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(ranks) + turn)
        for bit in range(bits)
        for turn, rank in enumerate(ranks)
    ]
    return reduce(Column.bitwiseOR, parts)


def files_for(n_lines: int, rows_per_file: int) -> int:
    """How many files of about `rows_per_file` lines hold `n_lines`.

    Each file costs a task, a row of zones and an open by its readers, whatever it holds.  So
    `SMALL_FILES` grow with the table, up to `ROWS_PER_FILE` lines each, before there are more.
    """
    wanted = -(-n_lines // rows_per_file)
    return max(1, min(wanted, SMALL_FILES), min(wanted, -(-n_lines // ROWS_PER_FILE)))


def clustered(
    lines: DataFrame,
    columns: Sequence[str] = CLUSTERED_BY,
    rows_per_file: int = ROWS_PER_FILE,
    bits: int = BITS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The same lines along the Z-order curve of some text columns, ready to be written.

    One shuffle by ranges of (place on the curve, hash of the line): a place that holds a
    third of all lines is cut by hash, only copies of one whole line stay together.  Small
    files are few (`files_for`).  An empty table stays empty; lines with NULLs lie with the smallest values.
    """
    n_lines = lines.count()
    edges = edges_of(lines, columns, 1 << bits, n_lines, sample_rows)
    # Ranks are columns of their own, so that each is found once and not once per bit.
    ranks = {f"_rank_{turn}": _rank(F.col(c), edges[c]) for turn, c in enumerate(columns)}
    ranked = lines.withColumns({**ranks, "_hash": F.xxhash64(*lines.columns)})
    ranked = ranked.withColumn("_curve", interleaved([F.col(r) for r in ranks], bits))
    return (
        ranked.repartitionByRange(files_for(n_lines, rows_per_file), "_curve", "_hash")
        .sortWithinPartitions("_curve", *columns)
        .select(*lines.columns)
    )


def zones(table: DataFrame, columns: Sequence[str] = CLUSTERED_BY) -> DataFrame:
    """One row per file of a stored table: file, lines, and the least and greatest of each column."""
    ends = [end(c).alias(f"{prefix}_{c}") for c in columns for prefix, end in (("min", F.min), ("max", F.max))]
    return table.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("lines"), *ends)


def without_other_zones(table: DataFrame, zones: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """The stored table less the files whose zones meet none of a column's (from, to), ends included.

    An end of None is open.  The names of the files left out pass through the driver, which
    lists all files of a scan in any case.
    """
    meets = F.lit(True)
    for column, (low, high) in ranges.items():
        if low is not None:
            meets &= F.coalesce(F.col(f"max_{column}") >= F.lit(low), F.lit(False))
        if high is not None:
            meets &= F.coalesce(F.col(f"min_{column}") <= F.lit(high), F.lit(False))
    names = [r["file"] for r in zones.where(~meets).select("file").collect()]
    return table.where(~F.col(FILE).isin(names)) if names else table
