"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that stays together.  Groups, largest first,
go to the least-loaded shard, taken from a heap.  Groups of one size are
interchangeable, so the schedule is computed on the histogram (size, number of
groups): its length is the number of distinct sizes, not of groups.  Everything
that grows with the rows is a Spark aggregate, join or ranking.

Ranks within a size and slots within a shard are two-level: rows are ranked within
small buckets, whose offsets come from their counts, so neither a common size nor
a shard's rows ever meet in one task; the rows of a common text learn their shard in parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ROW, stored, with_row_id
from .graph import join_spread

OVERHEAD_BYTES = 8
LAW = "bytes"


def schedule(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """For each (size, groups) in falling order of size: how many groups each shard gets.

    The same as popping the least-loaded shard (ties: the smaller number) once per
    group; shards that get whole rounds of equal groups are served at once.
    """
    loads = [(0, shard) for shard in range(shards)]
    heapq.heapify(loads)
    for size, groups in sizes:
        given = [0] * shards
        if size > 0 and groups > 4 * shards:
            # All shards below `level` are filled up to it before any rises above it.
            low, high = 0, (sum(load for load, _ in loads) + size * groups) // shards + size
            while low < high:
                level = (low + high + 1) // 2
                if sum(max(0, -(-(level - load) // size)) for load, _ in loads) <= groups:
                    low = level
                else:
                    high = level - 1
            for load, shard in loads:
                given[shard] = max(0, -(-(low - load) // size))
            groups -= sum(given)
            loads = [(load + given[shard] * size, shard) for load, shard in loads]
            heapq.heapify(loads)
        for _ in range(groups):
            load, shard = loads[0]
            given[shard] += 1
            heapq.heapreplace(loads, (load + size, shard))
        yield size, given


def _rank(rows: DataFrame, within: str, spread: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless ranks from 0 within each value of `within`, bucket by bucket."""
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    rows = rows.withColumn("_bucket", F.pmod(spread, F.lit(buckets)))
    counts = rows.groupBy(within, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(Window.partitionBy(within, "_bucket").orderBy(*order))
    return (
        rows.withColumn("_local", local)
        .join(offsets, [within, "_bucket"])
        .withColumn(name, F.col("_offset") + F.col("_local") - 1)
        .drop("_bucket", "_local", "_offset")
    )


def assign_shards(
    docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: (_row_id, doc_id, size, text_crc32, law, shard, slot, grown_shard).

    A row's size is its text's UTF-8 bytes plus 8; a NULL text has no bytes and
    groups with empty ones.  Rows repeated in full are rows like any other.  Slots
    run from 0 without gap in each shard.  `law` is always `bytes`, `grown_shard`
    NULL.  An empty table gives an empty result; other columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    data = F.encode(F.coalesce(F.col(text_column).cast("string"), F.lit("")), "UTF-8")
    rows = stored(
        with_row_id(docs).select(
            ROW,
            F.col(id_column).alias("doc_id"),
            (F.octet_length(data) + OVERHEAD_BYTES).cast("bigint").alias("size"),
            F.crc32(data).alias("text_crc32"),
            F.unhex(F.sha2(data, 256)).alias("_text"),
        )
    )
    groups = stored(rows.groupBy("_text").agg(F.sum("size").alias("_load"), F.count("*").alias("_rows")))
    histogram = groups.groupBy("_load").count().orderBy(F.desc("_load"))
    spark = docs.sparkSession
    # One row per distinct size passes here, never one per group or row.
    plan = spark.createDataFrame(
        list(schedule(((r["_load"], r["count"]) for r in histogram.toLocalIterator()), shards)),
        "_load bigint, _given array<bigint>",
    )
    ranked = _rank(groups, "_load", F.xxhash64("_text"), [F.col("_text")], "_at")
    upto = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda n: F.aggregate(F.slice("_given", 1, n), F.lit(0).cast("bigint"), lambda a, b: a + b),
    )
    placed = stored(
        ranked.join(plan, "_load").select(
            "_text", "_rows", F.size(F.filter(upto, lambda end: end <= F.col("_at"))).alias("shard")
        )
    )
    dealt = join_spread(rows, placed, ["_text"], "_rows").drop("_rows")
    return _rank(dealt, "shard", F.xxhash64(ROW), [F.col(ROW)], "slot").select(
        ROW,
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
