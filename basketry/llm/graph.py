"""Helpers on links between rows: connected components and checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import ROW, stored, with_row_id

BROADCAST_ROWS = 500_000
ONE_TASK_LINKS = 200_000
HOT_SHARE = 1000


def join_few(rows: DataFrame, few: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a stored frame of narrow rows, broadcast only if it is counted to be small.

    `few` must have fixed-width columns of at most 100 bytes in all; above
    `BROADCAST_ROWS` rows Spark shuffles both sides instead.
    """
    if few.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    return rows.join(few, on, how)


def join_spread(rows: DataFrame, groups: DataFrame, on: list[str], rows_in: str, how: str = "inner") -> DataFrame:
    """Join rows with their groups so that the rows of a hot group are spread over many tasks.

    `groups` is stored, with one row per value of `on` and its number of rows in `rows_in`.
    A group is hot that has more than one in `HOT_SHARE` of the rows counted there.  It is cut into
    parts of about that share: its rows get the number of one by their row id, the group a copy
    for each.  There are fewer than `HOT_SHARE` hot groups, which bounds what is broadcast (a
    hash and the parts of each), and at most twice as many copies.  The hash only spreads; rows and
    groups meet on `on` itself.
    """
    total = groups.agg(F.sum(rows_in).alias("n")).first()["n"] or 0
    place, share = F.xxhash64(*on), F.col(rows_in) * HOT_SHARE
    hot = groups.where(share > total).groupBy(place.alias("_hash")).agg(
        F.max(F.ceil(share / total)).cast("int").alias("_parts")
    )

    def marked(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_hash", place).join(F.broadcast(hot), "_hash", "left").drop("_hash")

    part = F.pmod(F.xxhash64(ROW), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = marked(rows).withColumn("_part", part).drop("_parts")
    copies = marked(groups).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return dealt.join(copies.drop("_parts"), [*on, "_part"], how).drop("_part")


def only_rows(frame: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a scanned frame whose row id is in `kept`, with its own columns."""
    name = ROW
    while name in frame.columns:
        name += "_"
    rows = with_row_id(frame, name)
    few = stored(kept.select(F.col(ROW).alias(name)))
    return join_few(rows, few, name, "left_semi").select(*frame.columns)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (u, v): the smallest node it reaches.

    Alternates large-star and small-star steps, each a grouped minimum joined back,
    until the links no longer change: O(log^2 n) rounds on any shape of graph.  Links
    counted to be at most `ONE_TASK_LINKS` take the same steps in one task, where
    shuffling them would take longer than the work.
    """
    links = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        mark = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if mark == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        few = mark["n"] <= ONE_TASK_LINKS
        links = links.coalesce(1) if few else links
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        large = stored(large)
        large = large.coalesce(1) if few else large
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(
            small.where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
