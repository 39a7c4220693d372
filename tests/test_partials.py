"""Shared partials, sets that can be united, month refresh and snapshots."""

import csv
import itertools

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from basketry.operators import gold, kpis, partials
from basketry.plans import driver_tables as given, refresh as plan
from basketry.plans.refresh import refresh, refresh_month
from basketry.schema import FACT, GOLD_TABLES, PARTIALS, RAW_COLUMNS, SILVER, SILVER_COLUMNS
from basketry.sources.tables import Lake, Snapshot

SF = "/root/testdata/sf0.001"


def write(folder, name, rows):
    with open(folder / name, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(RAW_COLUMNS)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def raw_rows(spark):
    return [tuple(r) for r in given.raw_text(spark, SF).collect()]


@pytest.fixture(scope="module")
def raw_files(tmp_path_factory, raw_rows):
    folder = tmp_path_factory.mktemp("raw")
    write(folder, "all.csv", raw_rows)
    return str(folder)


@pytest.fixture(scope="module")
def lines(spark):
    return given.silver_lines(spark, SF).cache()


def test_aggregates_from_partials_equal_those_from_lines(lines):
    parts = partials.partials(lines).cache()
    for name, build in partials.BUILDERS.items():
        expected = gold.BUILDERS[name](lines)
        assert build(parts).dtypes == expected.dtypes
        assertDataFrameEqual(build(parts), expected)


def test_partials_of_missing_cells(spark):
    schema = dict(given.silver_lines(spark, SF).dtypes)
    rows = [
        ("1", 2, "1.5", None, 0), ("1", None, None, None, 0), (None, 1, "2.0", "2010-01", 0),
        ("C1", -1, "-2.0", "2010-01", 1), ("C1", None, None, "2010-02", 1), (None, None, None, None, 0),
    ]
    frame = spark.createDataFrame(rows, "invoice_no string, quantity int, total string, month string, is_cancelled int")
    frame = frame.selectExpr("*", "CAST(total AS DECIMAL(29,4)) AS total_line_price", "month AS invoice_year_month",
                             "-1L AS customer_id", "IF(quantity = 2, NULL, 'x') AS country")
    absent = [c for c in SILVER_COLUMNS if c not in frame.columns]
    frame = frame.select("*", *[F.lit(None).cast(schema[c]).alias(c) for c in absent]).select(SILVER_COLUMNS)
    for name, build in partials.BUILDERS.items():
        assertDataFrameEqual(build(partials.partials(frame)), gold.BUILDERS[name](frame))
        none = frame.where("false")
        assertDataFrameEqual(build(partials.partials(none)), gold.BUILDERS[name](none))


def test_lines_are_scanned_once_for_all_aggregates(spark, lines, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE lake_once")
    lake = Lake(spark, "lake_once")
    lake.replace(SILVER, lines)
    read = []
    table = Lake.table
    monkeypatch.setattr(Lake, "table", lambda self, name: read.append(name) or table(self, name))
    plan.publish(lake)
    assert read.count(SILVER) == 1 and set(read) == {SILVER, PARTIALS}


@pytest.fixture(scope="module")
def with_sets(spark, raw_files):
    spark.sql("CREATE DATABASE lake_sets")
    few, partials.FEW = partials.FEW, 20  # lists and bitmaps both
    refresh(spark, raw_files, "lake_sets", keep_bronze=False, sets=True)
    partials.FEW = few
    lake = Lake(spark, "lake_sets")
    return {name: lake.table(name) for name in [*GOLD_TABLES, *partials.SET_GROUPS]}


def test_both_kinds_of_container_occur(with_sets):
    kinds = with_sets["gold_sets_country"].select(F.col("bits").isNull().alias("listed"), "positions")
    assert {r.listed for r in kinds.collect()} == {True, False}
    assert with_sets["gold_sets_country"].where("isnull(bits) = isnull(positions)").count() == 0


def test_unions_equal_the_fact(with_sets, lines):
    countries = [r.country for r in lines.select("country").distinct().orderBy("country").collect()]
    months = [tuple(r) for r in lines.select("invoice_year_month", "invoice_year").distinct().collect()]
    wanted = [{"country": c} for c in (countries, countries[:1], countries[2:9], ["nowhere"], [])]
    wanted += [{"invoice_year_month": [m for m, _ in months[:k]]} for k in (1, 7)]
    wanted += [{"invoice_year_month": [None]}, {"invoice_year": [1995, 1997]}, {}]
    wanted += [{"stock_code": ["1", "2", "50", "100"]}, {"product_description": [None]}]
    for filters, (name, column) in itertools.product(wanted, [("distinct_invoices", "invoice_no"), ("distinct_customers", "customer_id")]):
        assert filters == {} or kpis.sets_source(filters) in partials.SET_GROUPS
        rows = lines if column == "invoice_no" else lines.where("customer_id <> -1")
        for key, values in filters.items():
            rows = rows.where(F.col(key).isin([v for v in values if v is not None]) if None not in values else F.col(key).isNull())
        expected = rows.agg(F.count_distinct(column)).first()[0]
        assert kpis.distinct_members(with_sets, name, **filters).first()[0] == expected, (name, filters)


def test_unions_over_two_dimensions_come_from_the_fact(with_sets, lines):
    filters = {"country": ["NATION_1", "NATION_2"], "invoice_year": [1996]}
    assert kpis.sets_source(filters) == FACT
    expected = lines.where("country IN ('NATION_1', 'NATION_2') AND invoice_year = 1996")
    found = kpis.distinct_members(with_sets, "distinct_invoices", **filters).first()[0]
    assert found == expected.agg(F.count_distinct("invoice_no")).first()[0]


def by_month(rows):
    months = {}
    for row in rows:
        month = row[4][:7] if row[4] and row[4][:2] in ("19", "20") else None
        months.setdefault(month, []).append(row)
    return months


def same_tables(spark, one, other):
    for name in [*GOLD_TABLES, PARTIALS]:
        left, right = Lake(spark, one).table(name), Lake(spark, other).table(name)
        assertDataFrameEqual(left.select(right.columns), right)


def test_a_refreshed_month_equals_a_full_refresh(spark, raw_rows, tmp_path):
    months = by_month(raw_rows)
    old, new = sorted(m for m in months if m)[3], sorted(m for m in months if m)[5]
    files = tmp_path / "files"
    files.mkdir()
    for month, rows in months.items():
        write(files, f"{month}.csv", rows)
    for database in ("lake_month", "lake_whole"):
        spark.sql(f"CREATE DATABASE {database}")
    refresh(spark, str(files), "lake_month", keep_bronze=False, by_month=True)
    lake = Lake(spark, "lake_month")
    # Lines go, change and come; one invoice moves in from another month, one product is new.
    changed = months[old][5:] + [(*r[:3], "7", *r[4:]) for r in months[old][:3]]
    changed += [(months[new][0][0], "new", "A new thing", "3", f"{old}-05 10:00:00", "2.5", "77777", "NATION_9")]
    write(files, f"{old}.csv", changed)
    valid = refresh_month(lake, old, str(files / f"{old}.csv"))
    assert valid == lake.table(SILVER).where(F.col("invoice_year_month") == old).count()
    refresh(spark, str(files), "lake_whole", keep_bronze=False, by_month=True)
    same_tables(spark, "lake_month", "lake_whole")
    # A month without lines is gone; again is the same; and back.
    for rows in ([], [], months[old]):
        write(files, f"{old}.csv", rows)
        refresh_month(lake, old, str(files / f"{old}.csv"))
    write(files, f"{old}.csv", months[old])
    refresh(spark, str(files), "lake_whole", keep_bronze=False, by_month=True)
    same_tables(spark, "lake_month", "lake_whole")
    assert not [t.name for t in spark.catalog.listTables("lake_month") if "staged" in t.name]


def test_an_interrupted_month_can_be_repeated(spark, raw_rows, tmp_path, monkeypatch):
    months = by_month(raw_rows)
    month = sorted(m for m in months if m)[2]
    write(tmp_path, "all.csv", raw_rows)
    for database in ("lake_broken", "lake_mended"):
        spark.sql(f"CREATE DATABASE {database}")
        refresh(spark, str(tmp_path / "all.csv"), database, keep_bronze=False, by_month=True)
    write(tmp_path, "month.csv", months[month][: len(months[month]) // 2])
    refresh_month(Lake(spark, "lake_mended"), month, str(tmp_path / "month.csv"))
    lake = Lake(spark, "lake_broken")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Lake, "replace_partition", fail)
        with pytest.raises(RuntimeError):
            refresh_month(lake, month, str(tmp_path / "month.csv"))
    refresh_month(lake, month, str(tmp_path / "month.csv"))
    same_tables(spark, "lake_broken", "lake_mended")


def test_lines_of_other_months_are_refused_before_anything_changes(spark, raw_files, raw_rows, tmp_path):
    spark.sql("CREATE DATABASE lake_refused")
    refresh(spark, raw_files, "lake_refused", keep_bronze=False, by_month=True)
    lake = Lake(spark, "lake_refused")
    before = {name: lake.table(name).collect() for name in partials.BUILDERS}
    with pytest.raises(ValueError, match="lines are not of 1996-01"):
        refresh_month(lake, "1996-01", raw_files)
    assert {name: lake.table(name).collect() for name in partials.BUILDERS} == before
    refresh(spark, raw_files, "lake_refused", by_month=True)
    with pytest.raises(ValueError, match="without bronze"):
        refresh_month(lake, "1996-01", raw_files)


def test_a_failure_between_tables_leaves_the_old_set_whole(spark, raw_files, raw_rows, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE lake_versions")
    with pytest.raises(ValueError, match="no published version"):
        Snapshot.current(spark, "lake_versions")
    refresh(spark, raw_files, "lake_versions", snapshot=True, keep_bronze=False)
    first = Snapshot.current(spark, "lake_versions")
    old = {name: sorted(map(str, table.collect())) for name, table in first.gold().items()}
    write(tmp_path, "half.csv", raw_rows[: len(raw_rows) // 2])
    build = dict(partials.BUILDERS)
    for broken in build:  # each aggregate in turn
        with monkeypatch.context() as patched:
            patched.setitem(partials.BUILDERS, broken, lambda parts: parts.select("no_such_column"))
            with pytest.raises(AnalysisException):
                refresh(spark, str(tmp_path / "half.csv"), "lake_versions", snapshot=True, keep_bronze=False)
        now = Snapshot.current(spark, "lake_versions")
        assert now == first
        assert {name: sorted(map(str, table.collect())) for name, table in now.gold().items()} == old
        assert sorted(map(str, Lake(spark, "lake_versions").table(FACT).collect())) == old[FACT]
    refresh(spark, str(tmp_path / "half.csv"), "lake_versions", snapshot=True, keep_bronze=False)
    second = Snapshot.current(spark, "lake_versions")
    assert second.version > first.version and second.table(FACT).count() < first.table(FACT).count()
    # The version before stays for its readers, abandoned ones are gone, plain names follow.
    assert {name: sorted(map(str, table.collect())) for name, table in first.gold().items()} == old
    assert set(Snapshot._versions(spark, "lake_versions").values()) == {first.version, second.version}
    for name in GOLD_TABLES:
        assertDataFrameEqual(Lake(spark, "lake_versions").table(name), second.table(name))
    refresh(spark, raw_files, "lake_versions", snapshot=True, keep_bronze=False)
    assert first.version not in Snapshot._versions(spark, "lake_versions").values()
