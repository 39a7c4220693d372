"""Raw files in, layer tables out."""

import csv

import pytest
from pyspark.testing import assertDataFrameEqual

from basketry.operators import gold, silver
from basketry.plans import driver_tables as given
from basketry.plans.refresh import refresh, row_counts
from basketry.schema import BRONZE, FACT, GOLD_TABLES, RAW_COLUMNS, SILVER
from basketry.sources.raw_csv import files_with_quoted_newlines, read_raw
from basketry.sources.tables import Lake

HEADER = ",".join(RAW_COLUMNS)
SF = "/root/testdata/sf0.001"


def write(path, *lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_quotes_and_commas(spark, tmp_path):
    path = write(tmp_path / "a.csv", '1,2,"A ""B"", C",3,2010-01-01 00:00:00,1.5,9,UK', "1,2,,,,,,")
    assert not files_with_quoted_newlines(spark, path)
    rows = read_raw(spark, path).collect()
    assert rows[0]["Description"] == 'A "B", C'
    assert list(rows[1])[2:] == [None] * 6


def test_line_breaks_inside_fields_are_noticed(spark, tmp_path):
    path = write(tmp_path / "a.csv", '1,2,"two\nlines",3,x,1.5,9,UK', "2,2,plain,3,x,1.5,9,UK")
    assert files_with_quoted_newlines(spark, path)
    rows = read_raw(spark, path).collect()
    assert [r["Description"] for r in rows] == ["two\nlines", "plain"]


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    write(folder / "a b.csv", '1,2,"two\nlines",3,x,1.5,9,UK')
    write(folder / "c.csv", "2,2,plain,3,x,1.5,9,UK")
    assert len(files_with_quoted_newlines(spark, str(folder))) == 1
    rows = read_raw(spark, str(folder)).collect()
    assert sorted(r["Description"] for r in rows) == ["plain", "two\nlines"]


@pytest.mark.parametrize("multi_line", [True, False, None])
def test_cells_beyond_the_header_are_an_error(spark, tmp_path, multi_line):
    path = write(tmp_path / "a.csv", "1,2,d,3,x,1.5,9,UK", "2,2,short")
    assert [r["Price"] for r in read_raw(spark, path, multi_line).collect()] == ["1.5", None]
    path = write(tmp_path / "b.csv", "1,2,d,3,x,1.5,9,UK", "1,2,d,3,x,1.5,9,UK,beyond")
    with pytest.raises(Exception, match="beyond the header"):
        read_raw(spark, path, multi_line).collect()


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Country,Extra,Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID\n"
                    "UK,e,1,2,d,3,x,1.5,9\n")
    assert read_raw(spark, str(path)).first().asDict()["Country"] == "UK"
    path.write_text("Invoice,Country\n1,UK\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_raw(spark, str(path))


def test_files_with_different_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", "1,2,d,3,x,1.5,9,UK")
    (folder / "b.csv").write_text(",".join(reversed(RAW_COLUMNS)) + "\nUK,9,1.5,x,3,d,2,1\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_raw(spark, str(folder)).collect()


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    """The derived raw lines as four CSV files, written without Spark."""
    folder = tmp_path_factory.mktemp("raw")
    rows = given.raw_text(spark, SF).collect()
    for n in range(4):
        with open(folder / f"{n}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(RAW_COLUMNS)
            writer.writerows(rows[n::4])
    return str(folder)


@pytest.mark.parametrize("keep_bronze", [True, False])
@pytest.mark.parametrize("copy_fact", [True, False])
def test_staged_and_direct_refresh_give_the_same_tables(spark, raw_files, keep_bronze, copy_fact):
    database = f"lake_{keep_bronze}_{copy_fact}".lower()
    spark.sql(f"CREATE DATABASE {database}")
    for _ in range(2):  # a refresh replaces what is there
        counts = refresh(
            spark, raw_files, database, keep_bronze=keep_bronze, copy_fact=copy_fact
        )
    assert counts == {BRONZE: 6000, SILVER: 5703}
    lake = Lake(spark, database)
    assert spark.catalog.tableExists(f"{database}.{BRONZE}") == keep_bronze
    expected = given.silver_lines(spark, SF)
    tables = lake.gold()
    assert set(tables) == set(GOLD_TABLES)
    for name, table in tables.items():
        assertDataFrameEqual(table, gold.BUILDERS[name](expected))
    kind = spark.catalog.getTable(f"{database}.{FACT}").tableType
    assert kind == ("MANAGED" if copy_fact else "VIEW")


def test_the_fact_can_change_from_copy_to_view_and_back(spark, raw_files):
    spark.sql("CREATE DATABASE lake_switch")
    for copy_fact in (True, False, True):
        refresh(spark, raw_files, "lake_switch", copy_fact=copy_fact)
    assert Lake(spark, "lake_switch").table(FACT).count() == 5703


def test_row_counts_come_from_one_scan(spark):
    counts = row_counts(given.bronze(spark, SF))
    assert {tuple(r) for r in counts.collect()} == {(BRONZE, 6000), (SILVER, 5703)}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber#") > 0 and plan.count("Aggregate") == 1
