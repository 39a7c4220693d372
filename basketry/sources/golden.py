"""Golden question sets (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.scoring import expected_value

# `result_preview` is read as its JSON text, which keeps the order of its keys.
_SCHEMA = "id bigint, question string, result_preview string"


def read_golden(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """A golden set: a JSON array in one file, or one JSON object per line.

    `position` follows the order in the file.
    """
    rows = spark.read.schema(_SCHEMA).json(path, multiLine=not json_lines, mode="FAILFAST")
    return normalise_golden(rows.withColumn("position", F.monotonically_increasing_id()))


def normalise_golden(rows: DataFrame) -> DataFrame:
    """id, position, question and what the preview expects."""
    expected = expected_value(F.col("result_preview"))
    return rows.select(
        "id", "position", "question", *[column.alias(name) for name, column in expected.items()]
    )
