"""Order-aware steps over a log whose busiest key may hold most of the rows.

A window over a whole key would put all its rows into one task.  Here the key's
rows are cut into slices of consecutive sequence numbers; the heavy window runs
per (key, slice), and only one summary row per slice meets in a second window.
`seq` must be unique within a key, so a slice never holds more than `width` rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

SLICE_WIDTH = 65_536


def sliced(log: DataFrame, key: str, seq: str, width: int = SLICE_WIDTH) -> DataFrame:
    """Add `slice`.  A row without a key or number has no place in the order: an error.

    The rows are brought together by (key, slice) here, once: later steps with
    different needs would each shuffle the log in a shape of their own.
    """
    placed = F.expr(f"`{seq}` div {int(width)}")
    known = F.col(key).isNotNull() & placed.isNotNull()
    unplaced = F.raise_error(F.lit(f"a log row lacks {key} or {seq}")).cast("bigint")
    return log.withColumn("slice", F.when(known, placed).otherwise(unplaced)).repartition(key, "slice")


def with_previous(log: DataFrame, key: str, seq: str, columns: list[str]) -> DataFrame:
    """Add `previous`, a struct of `columns` from the row before; NULL on a key's first row."""
    row = f"struct({', '.join(columns)})"
    in_slice = f"PARTITION BY {key}, slice ORDER BY {seq}"
    near = log.selectExpr(
        "*",
        f"lag({row}) OVER ({in_slice}) AS near",
        f"lead(true) OVER ({in_slice}) IS NULL AS closes_slice",
    )
    carried = near.where("closes_slice").selectExpr(
        key, "slice", f"lag({row}) OVER (PARTITION BY {key} ORDER BY slice) AS carried"
    )
    return near.join(carried, [key, "slice"], "left").selectExpr(
        *log.columns, "coalesce(near, carried) AS previous"
    )


def with_positions(log: DataFrame, key: str, seq: str, counters: Mapping[str, str]) -> DataFrame:
    """Number each key's rows from 1: per counter the rows so far that meet its condition.

    A condition may also be a number, which is added up.  Also adds `<counter>_total`,
    the count over the whole key.
    """
    flags = {name: f"bigint({condition})" for name, condition in counters.items()}
    in_slice = f"PARTITION BY {key}, slice ORDER BY {seq} ROWS UNBOUNDED PRECEDING"
    before = f"PARTITION BY {key} ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    counts = [F.expr(f"sum({flag})").alias(f"{name}_rows") for name, flag in flags.items()]
    offsets = (
        log.groupBy(key, "slice")
        .agg(*counts)
        .selectExpr(
            key,
            "slice",
            *[f"coalesce(sum({n}_rows) OVER ({before}), 0) AS {n}_before" for n in flags],
            *[f"sum({n}_rows) OVER (PARTITION BY {key}) AS {n}_total" for n in flags],
        )
    )
    numbered = log.selectExpr(
        "*", *[f"sum({flag}) OVER ({in_slice}) AS {name}_here" for name, flag in flags.items()]
    )
    return numbered.join(offsets, [key, "slice"]).selectExpr(
        *log.columns,
        *[f"{n}_before + {n}_here AS {n}" for n in flags],
        *[f"{n}_total" for n in flags],
    )
