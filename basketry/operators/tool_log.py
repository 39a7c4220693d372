"""Tool events of question-answering runs -> the queries each question executed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.text import marks_failure
from basketry.operators.ordered_log import SLICE_WIDTH, sliced, with_positions, with_previous

# Fixed value: the tool whose calls are logged.
QUERY_TOOL = "sql_db_query"


def executed_queries(events: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """One row per executed query: id, slice, seq, query, result.

    `events` has id, seq, kind ('tool_start' / 'tool_end'), tool, payload.  An
    end belongs to the start right before it: a second start replaces an open
    one, and an end clears it, so later ends without a start log nothing.
    """
    steps = events.where("kind IN ('tool_start', 'tool_end')").select(
        "id", "seq", "kind", "tool", "payload"
    )
    return (
        with_previous(sliced(steps, "id", "seq", width), "id", "seq", ["kind", "tool", "payload"])
        .where(
            "kind = 'tool_end' AND previous.kind = 'tool_start' "
            f"AND previous.tool = '{QUERY_TOOL}'"
        )
        .selectExpr("id", "slice", "seq", "previous.payload AS query", "payload AS result")
    )


def numbered(executed: DataFrame) -> DataFrame:
    """Executed queries as id, query_no, seq, query, result, text_end, texts.

    `text_end` counts the characters of the question's results so far, this one
    included, `texts` those of all of them.
    """
    counters = {"query_no": "true", "text_end": "coalesce(length(result), 0)"}
    return with_positions(executed, "id", "seq", counters).select(
        "id", "query_no", "seq", "query", "result", "text_end", F.col("text_end_total").alias("texts")
    )


def query_log(events: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """The numbered queries of a log, in one plan."""
    return numbered(executed_queries(events, width))


def retries(queries: DataFrame) -> DataFrame:
    """Refused or failed queries per question, counted before the shuffle."""
    return queries.groupBy("id").agg(
        F.count_if(marks_failure(F.col("result"))).alias("retries"),
        F.count(F.lit(1)).alias("queries"),
    )


def without_queries(golden: DataFrame, runs: DataFrame, queries: DataFrame) -> DataFrame:
    """Questions whose run succeeded without a single logged query."""
    succeeded = runs.where("NOT failed").select("id")
    answered = golden.join(succeeded, "id", "left_semi")
    return answered.join(queries.select("id").distinct(), "id", "left_anti")
