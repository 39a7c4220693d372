"""Rejected lines, and a report with one question that holds half of the log."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from basketry.operators import scoring, silver
from basketry.plans import driver_tables as given
from basketry.plans.refresh import refresh
from basketry.schema import BRONZE, FACT, MONTHLY, RAW_COLUMNS, REJECTS, SILVER
from basketry.sources.tables import Lake

HEADER = ",".join(RAW_COLUMNS)
GOOD = "1,2,d,3,2010-01-01 00:00:00,1.5,9,UK"
BAD = {
    "2,2,d,3.5,2010-01-01 00:00:00,1.5,9,UK": "quantity is not a whole number: 3.5",
    "3,2,d,three,2010-01-01 00:00:00,1.5,9,UK": "quantity is not a whole number: three",
    "4,2,d,3,2010-01-01 00:00:00,1.23456,9,UK": "unit_price does not fit decimal(18,4): 1.23456",
    "5,2,d,3,2010-01-01 00:00:00,1.5,nobody,UK": "customer_id is not a whole number: nobody",
    "6,2,d,x,2010-01-01 00:00:00,y,z,UK": "quantity is not a whole number: x; "
    "unit_price does not fit decimal(18,4): y; customer_id is not a whole number: z",
    "7,2,d,0,2010-01-01 00:00:00,cheap,9,UK": "unit_price does not fit decimal(18,4): cheap",
    "8,2,d,99999999999,2010-01-01 00:00:00,1,9,UK": "quantity is not a whole number: 99999999999",
}
DROPPED = ["9,2,d,0,2010-01-01 00:00:00,1.5,9,UK", "10,2,d,3,2010-01-01 00:00:00,-1,9,UK", "11,2,d,3,x,,9,UK"]
KEPT = [GOOD, "12,2,d,,not a date,1.50000,,UK", "13,2,d,6.0, ,1e1,8.0,UK", "14,,,,,+1,,"]


@pytest.mark.parametrize("multi_line", [True, False, None])
def test_rejects_are_counted_and_nothing_is_lost(spark, tmp_path, multi_line):
    wide = GOOD + ",beyond"
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *KEPT, *BAD]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER, wide, *DROPPED, GOOD]) + "\n")
    database = f"lake_rejects_{multi_line}".lower()
    spark.sql(f"CREATE DATABASE {database}")
    counts = refresh(spark, str(tmp_path), database, multi_line=multi_line, keep_bronze=False, quarantine=True)
    assert counts == {BRONZE: len(KEPT) + len(BAD) + len(DROPPED) + 2, SILVER: len(KEPT) + 1, REJECTS: len(BAD) + 1}
    lake = Lake(spark, database)
    rejects = lake.table(REJECTS).collect()
    reasons = [r.reject_reason for r in rejects if "beyond" not in r.reject_reason]
    assert Counter(reasons) == Counter(BAD.values())
    for row in rejects:
        cells = json.loads(row.raw_cells)
        line = ",".join("" if c is None else c for c in cells.values())
        assert line in BAD or line == GOOD and "beyond" in row.reject_reason
        assert row.source_file.endswith("b.csv" if "beyond" in row.reject_reason else "a.csv")
        assert row.source_block >= 0
    # The good lines are what they would be without the bad ones.
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.csv").write_text("\n".join([HEADER, *KEPT, *DROPPED, GOOD]) + "\n")
    spark.sql(f"CREATE DATABASE {database}_good")
    refresh(spark, str(tmp_path / "good"), f"{database}_good", multi_line=multi_line, keep_bronze=False)
    for name in (SILVER, FACT, MONTHLY):
        assertDataFrameEqual(lake.table(name), Lake(spark, f"{database}_good").table(name))


def test_bad_cells_stay_errors_without_quarantine(spark, tmp_path):
    spark.sql("CREATE DATABASE lake_strict")
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *KEPT, next(iter(BAD))]) + "\n")
    with pytest.raises(Exception, match="quantity is not a whole number: 3.5"):
        refresh(spark, str(tmp_path), "lake_strict", keep_bronze=False)
    with pytest.raises(ValueError, match="no bronze"):
        refresh(spark, str(tmp_path), "lake_strict", quarantine=True)


def test_examined_lines_equal_cleansed_ones(spark):
    raw = given.bronze(spark, "/root/testdata/sf0.001")
    rows = silver.examined(raw)
    assert rows.where("reject_reason IS NOT NULL").count() == 0
    assertDataFrameEqual(rows.drop("reject_reason", "raw_cells"), silver.cleanse(raw))


def test_a_question_with_half_of_the_log_is_spread(spark):
    many, others = 20_000, 400
    rows = [(0, k, "q", "r") for k in range(1, many + 1)]
    rows += [(i, k, "q", "r") for i in range(1, others) for k in range(1, 51)]
    queries = spark.createDataFrame(rows, "id bigint, query_no bigint, query string, result string")
    golden = spark.range(others).selectExpr(
        "id", "id AS position", "'why' AS question", "true AS has_expected", "1D AS expected_num",
        "CAST(NULL AS STRING) AS expected_str")
    runs = golden.selectExpr("id", "'so' AS final_output", "1D AS latency_sec", "false AS failed", "CAST(NULL AS STRING) AS error")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = scoring.report_lines(golden, runs, queries, slice_queries=100)
        steps = lines.where("line LIKE 'SQL%'").withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in steps.groupBy("part").count().collect()]
        assert sum(sizes) == len(rows) and max(sizes) <= 2 * len(rows) / 8
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    whole = scoring.report_lines(golden, runs, queries, slice_queries=1_000_000)
    assert lines.exceptAll(whole).count() == 0 and whole.count() == lines.count()
