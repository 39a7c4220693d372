"""Numbers and markers in free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what counts as a number in an answer.
NUMBER = r"-?\d+\.?\d*"

# Texts that mark a refused or failed query.
FAILURE_MARKS = ("Error", "BLOCKED")


def numbers(text: Column) -> Column:
    """All numbers in a text, left to right, as array<double>."""
    return F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)).cast("array<double>")


def any_near(values: Column, expected: Column, tolerance: float) -> Column:
    """Whether some value lies within the tolerance; false when nothing is expected."""
    return F.coalesce(
        F.exists(values, lambda value: F.abs(value - expected) <= tolerance), F.lit(False)
    )


def mentions(text: Column, expected: Column) -> Column:
    """Case-insensitive containment; false when nothing is expected."""
    return F.coalesce(F.contains(F.lower(text), F.lower(expected)), F.lit(False))


def marks_failure(result: Column) -> Column:
    """Case-sensitive test for the failure marks."""
    refused = F.lit(False)
    for mark in FAILURE_MARKS:
        refused = refused | F.contains(result, F.lit(mark))
    return F.coalesce(refused, F.lit(False))
