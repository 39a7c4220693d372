"""Stored order of the aggregates; a fact clustered by month, country and product."""

import csv
import itertools
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from basketry.operators import gold, kpis, layout
from basketry.plans import driver_tables as given
from basketry.plans.refresh import publish, publish_clustered_fact, refresh, refresh_month
from basketry.schema import FACT, GOLD_TABLES, PRODUCT, RAW_COLUMNS, RFM, SILVER, ZONES
from basketry.sources.tables import Lake, Snapshot

SF = "/root/testdata/sf0.001"
AGGREGATES = [name for name in GOLD_TABLES if name != FACT]


@pytest.fixture(scope="module")
def raw_file(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "all.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(RAW_COLUMNS)
        writer.writerows(tuple(r) for r in given.raw_text(spark, SF).collect())
    return str(path)


@pytest.fixture(scope="module")
def lake(spark, raw_file):
    spark.sql("CREATE DATABASE lake_layout")
    refresh(spark, raw_file, "lake_layout", keep_bronze=False, cluster=True)
    lake = Lake(spark, "lake_layout")
    publish_clustered_fact(lake, rows_per_file=100)
    return lake


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def in_many_files(spark, frame, path):
    """The frame written with one file per shuffle partition, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", AGGREGATES)
def test_published_aggregates_are_read_in_order_without_a_sort(lake, name):
    stored = lake.report(name)
    assert "Sort" not in plan_of(stored) and "Exchange" not in plan_of(stored)
    assert stored.collect() == gold.in_report_order(name, lake.table(name)).collect()


@pytest.mark.parametrize("name", [PRODUCT, RFM])
def test_order_and_positions_over_many_files(spark, lake, tmp_path, name):
    expected = gold.in_report_order(name, lake.table(name)).collect()
    table = in_many_files(spark, gold.in_report_order(name, lake.table(name)), str(tmp_path / "t"))
    assert len(table.inputFiles()) > 2
    assert layout.in_stored_order(table).collect() == expected
    placed = layout.with_position(table).collect()
    assert [r[:-1] for r in sorted(placed, key=lambda r: r.position)] == [tuple(r) for r in expected]
    assert sorted(r.position for r in placed) == list(range(1, len(expected) + 1))


def test_order_of_files_whose_numbers_outgrow_their_zeros(spark):
    names = ["part-99999-a-c000", "part-100000-a-c000", "part-99999-a-c001", "part-99999-a-c1000"]
    rows = spark.createDataFrame([(n,) for n in names], "file string")
    found = [r.file for r in rows.orderBy(*layout._file_order(F.col("file"))).collect()]
    assert found == ["part-99999-a-c000", "part-99999-a-c001", "part-99999-a-c1000", "part-100000-a-c000"]


def test_positions_beside_clashing_columns_and_in_empty_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2, "x")], "position_ int, position__ int, file string")
    frame.write.parquet(str(tmp_path / "a"))
    assert layout.with_position(spark.read.parquet(str(tmp_path / "a"))).first().position == 1
    frame.limit(0).write.parquet(str(tmp_path / "b"))
    empty = spark.read.parquet(str(tmp_path / "b"))
    assert layout.with_position(empty).count() == layout.in_stored_order(empty).count() == 0


def test_a_table_without_order_is_refused(lake):
    with pytest.raises(ValueError, match="not stored in an order"):
        lake.report(FACT)


def test_a_month_refresh_and_a_snapshot_keep_the_order(spark, raw_file, tmp_path):
    spark.sql("CREATE DATABASE lake_layout_months")
    refresh(spark, raw_file, "lake_layout_months", keep_bronze=False, by_month=True)
    lake = Lake(spark, "lake_layout_months")
    month = lake.table(SILVER).where("invoice_year_month IS NOT NULL").first().invoice_year_month
    with open(tmp_path / "none.csv", "w") as out:
        out.write(",".join(RAW_COLUMNS) + "\n")
    refresh_month(lake, month, str(tmp_path / "none.csv"))
    refresh(spark, raw_file, "lake_layout", keep_bronze=False, snapshot=False)
    for name in AGGREGATES:
        assert lake.report(name).collect() == gold.in_report_order(name, lake.table(name)).collect()
    spark.sql("CREATE DATABASE lake_layout_versions")
    refresh(spark, raw_file, "lake_layout_versions", keep_bronze=False, snapshot=True, cluster=True)
    current = Snapshot.current(spark, "lake_layout_versions")
    assert current.report(RFM).count() == current.table(RFM).count()
    assert ZONES in current.gold()
    # The plain names are views, which have no files of their own.
    plain = Lake(spark, "lake_layout_versions")
    assert ZONES not in plain.gold()
    assert kpis.fact_lines(plain.gold(), country="NATION_7").count() > 0


@pytest.fixture(scope="module")
def clustered_tables(spark, raw_file):
    spark.sql("CREATE DATABASE lake_clustered")
    refresh(spark, raw_file, "lake_clustered", keep_bronze=False)
    lake = Lake(spark, "lake_clustered")
    publish_clustered_fact(lake, rows_per_file=100)
    return lake.gold(), {FACT: lake.table(SILVER)}


CONDITIONS = [
    {"month": "1997-05"}, {"country": "NATION_7"}, {"stock_code": "77"}, {"month": "1997-05", "country": "NATION_7"},
    {"from_date": date(1996, 3, 5), "to_date": date(1996, 4, 2)}, {"from_date": date(1998, 6, 1)},
    {"to_date": date(1992, 2, 3)}, {"to_date": date(1900, 1, 1)}, {"country": "nowhere"}, {"cancelled": True}, {},
]


@pytest.mark.parametrize("condition", CONDITIONS, ids=str)
def test_lines_of_a_clustered_fact_are_those_of_silver(clustered_tables, condition):
    tables, plain = clustered_tables
    assertDataFrameEqual(kpis.fact_lines(tables, **condition), kpis.fact_lines(plain, **condition))


@pytest.mark.parametrize("condition", CONDITIONS[:3], ids=str)
def test_one_condition_reads_a_fraction_of_the_files(clustered_tables, condition):
    tables, _ = clustered_tables
    n_files = tables[ZONES].count()
    assert n_files > 40
    lines = kpis.fact_lines(tables, **condition)
    assert files_read(lines) < n_files / 2


def files_read(frame):
    """The scan's own metric of files, from a run of the plan."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    plans, scans = [execution.executedPlan()], []
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("Scan"):
            scans.append(plan)
        below = plan.children()
        plans += [below.apply(k) for k in range(below.size())]
    assert len(scans) == 1
    return scans[0].metrics().apply("numFiles").value()


def test_files_that_the_zones_do_not_know_are_read(spark, clustered_tables):
    tables, plain = clustered_tables
    some = tables[ZONES].limit(3)
    rows = kpis.fact_lines({**tables, ZONES: some}, country="NATION_7")
    assertDataFrameEqual(rows, kpis.fact_lines(plain, country="NATION_7"))


def test_zones_go_when_the_fact_is_no_longer_clustered(spark, raw_file):
    spark.sql("CREATE DATABASE lake_unclustered")
    refresh(spark, raw_file, "lake_unclustered", keep_bronze=False, cluster=True)
    lake = Lake(spark, "lake_unclustered")
    assert ZONES in lake.gold()
    publish(lake)
    assert not lake.exists(ZONES) and ZONES not in lake.gold()


def test_odd_lines_are_kept(spark, tmp_path):
    schema = "invoice_year_month string, country string, stock_code string, n int"
    hot = [("2010-01", "UK", "1", n) for n in range(600)]
    odd = [(None, None, None, 1), (None, None, None, 1), ("", "", "", 2), ("2011-01", None, "x" * 5000, 3)]
    rest = [(f"20{y:02}-01", c, str(n), n) for y, c, n in itertools.product(range(5), "ABC", range(20))]
    rows = spark.createDataFrame(hot + odd + rest, schema)
    layout.clustered(rows, rows_per_file=50).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assertDataFrameEqual(table, rows)
    found = layout.zones(table).collect()
    assert sum(z.lines for z in found) == rows.count()
    assert max(z.lines for z in found) < 300  # the hot place is cut
    layout.clustered(rows.limit(0)).write.parquet(str(tmp_path / "e"))
    assert layout.zones(spark.read.parquet(str(tmp_path / "e"))).count() == 0


def test_small_files_grow_before_there_are_more():
    assert [layout.files_for(n, 2_000) for n in (0, 1, 2_000, 2_001, 512_000)] == [1, 1, 1, 2, 256]
    assert layout.files_for(36_000_000, 2_000) == layout.files_for(216_000_000, 2_000) == 256
    assert layout.files_for(5_000_000_000, 2_000) == layout.files_for(5_000_000_000, 5_000_000) == 1000
    assert layout.files_for(5_000_000_000, 10_000_000) == 500


def test_many_lines_in_small_files_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "SMALL_FILES", 8)
    schema = "invoice_year_month string, country string, stock_code string, n int"
    rows = spark.createDataFrame([(f"20{n % 7:02}-01", "ABC"[n % 3], str(n % 50), n) for n in range(400)], schema)
    layout.clustered(rows, rows_per_file=1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assertDataFrameEqual(table, rows)
    assert 4 < len(table.inputFiles()) <= 8


def test_ranks_interleave(spark):
    rows = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int")
    curve = rows.select("x", "y", layout.interleaved([F.col("x"), F.col("y")], 3).alias("z")).collect()
    for r in curve:
        expected = sum((r.x >> b & 1) << 2 * b | (r.y >> b & 1) << 2 * b + 1 for b in range(3))
        assert r.z == expected
    texts = spark.createDataFrame([(c,) for c in ["", "a", "b", "c", "zz", None]], "t string")
    ranks = [r[0] for r in texts.select(layout._rank(F.col("t"), ["a", "b", "z"])).collect()]
    assert ranks == [0, 1, 2, 2, 3, 0]
