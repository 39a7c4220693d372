"""Exact deduplication by most-significant-digit radix partitioning.

A digit is a run of successive bytes of the text; the text's length is the first
digit.  Rows that share all digits so far form a group.  A round splits every
group by the next digit: groups of one row are done, groups whose texts have
ended hold equal texts, all others go on.  Texts are compared byte by byte, never
by digest.  Digits grow, so a text of n bytes takes O(log n) rounds.

Scale: the first round shuffles one digit per row; texts travel only for rows that
still share a group after it, and are stored without the bytes looked at.  Groups are counted with
map-side sums, and the rows of a hot group are joined back in parts, so that a group with a
third of all rows is spread over the tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import ROW, pinned, stored, with_row_id
from .graph import join_few, join_spread, only_rows

FIRST_DIGIT = 64
GROWTH = 16


def _cut(width: int) -> list[Column]:
    return [
        F.substring("_rest", 1, width).alias("_digit"),
        F.expr(f"substring(_rest, {width + 1})").alias("_rest"),
        F.greatest(F.octet_length("_rest") - width, F.lit(0)).alias("_left"),
    ]


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are done, and rows that still share a group, with its new number."""
    keys = ["_group", "_digit"]
    # A group's texts have one length, so all of them end in the same round.
    groups = stored(
        rows.groupBy(*keys)
        .agg(
            F.count("*").alias("group_size"),
            F.max(F.struct(F.col("doc_id").alias("id"), (-F.col(ROW)).alias("at"))).alias("_best"),
        )
        .where("group_size > 1")
    ).withColumn("_next", F.monotonically_increasing_id())
    rest = [c for c in rows.columns if c == "_rest"]
    joined = stored(
        join_spread(rows, groups, keys, "group_size", "left").select(
            ROW, "doc_id", "_sha", "_next", "group_size", "_best",
            (F.col("_next").isNull() | (F.col("_left") == 0)).alias("_done"), *rest,
        )
    )
    on = joined.where("NOT _done").select(ROW, "doc_id", "_sha", F.col("_next").alias("_group"), *rest)
    return joined.where("_done").select(ROW, "doc_id", "_sha", "group_size", "_best"), on


def _bytes(text: str) -> Column:
    return F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")


def duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first_digit: int = FIRST_DIGIT,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per document: (_row_id, doc_id, keep_id, group_size, kept, text_sha256).

    NULL and empty texts are equal.  Of equal texts the row with the largest id
    stays, NULL ids last; of rows that repeat that id, exactly one (the first in
    scan order) stays.  `keep_id` is NULL only if all ids of the group are.  An
    empty table gives an empty result; other columns of `docs` are ignored.
    """
    docs, data = pinned(docs), _bytes(text_column)
    whole = with_row_id(docs).select(ROW, data.alias("_rest"))
    cut = with_row_id(docs).select(
        ROW,
        F.col(id_column).alias("doc_id"),
        F.unhex(F.sha2(data, 256)).alias("_sha"),
        F.octet_length(data).alias("_group"),
        F.substring(data, 1, first_digit).alias("_digit"),
        F.greatest(F.octet_length(data) - first_digit, F.lit(0)).alias("_left"),
    )
    width = first_digit
    done, shared = _split(cut)
    ended = [done]
    if not shared.isEmpty():
        # Only now do texts travel, and only those that share a group.
        rows = join_few(whole, shared, ROW).withColumn("_rest", F.expr(f"substring(_rest, {width + 1})"))
    while not shared.isEmpty():
        width *= growth
        done, shared = _split(rows.select(ROW, "doc_id", "_sha", "_group", *_cut(width)))
        ended.append(done)
        rows = shared
    return reduce(DataFrame.unionByName, ended).select(
        ROW,
        "doc_id",
        F.coalesce("_best.id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("_best.at") == -F.col(ROW), F.lit(True)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns kept."""
    docs = pinned(docs)
    return only_rows(docs, duplicate_groups(docs, id_column, text_column).where("kept"))
