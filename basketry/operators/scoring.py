"""Scoring logged answers against golden questions.

Golden rows have id, position, question, has_expected, expected_num and
expected_str; runs have id, final_output, latency_sec, failed and error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.cells import money
from basketry.functions.text import any_near, mentions, numbers
from basketry.operators.observation import (
    PART_WIDTH,
    asked_of_parts,
    mentions_across,
    numbers_across,
)
from basketry.operators.usage import TOKENS, call_tokens, with_cost

# Fixed value: how far a stated number may be off.
TOLERANCE = 0.01

# Wording of the report.
NO_QUERY_LINE = " MODEL HALLUCINATED! (No DB queries executed)"
RULE_LINE = "\n======================="
EMPTY_ROW_ERROR = "list index out of range"
FAILED_PREFIX = "CRITICAL FAIL | "
NO_RUN_ERROR = "no run logged"
QUESTION_PREFIX, QUESTION_END = "Q", ": "
ANSWER_PREFIX = "Final Output: "
QUERY_PREFIX, QUERY_END = "--- Query ", " ---"
SQL_PREFIX = "SQL: "
RESULT_PREFIX = "DB Result: "
NO_TEXT = "None"

# Queries of one question that meet its answer in one task.
SLICE_QUERIES = 10_000


def first_items(golden: DataFrame, count: int | None) -> DataFrame:
    """The first `count` golden questions in file order; all of them for None."""
    return golden if count is None else golden.orderBy("position").limit(count)


def expected_value(preview: Column) -> dict[str, Column]:
    """Normalise a preview, given as the JSON text of a list of row objects.

    Only the first value of the first row is expected.  Numbers and booleans
    compare as numbers, all else as text, a null as the text `none`.  A preview
    whose first row is empty is expected but has no value: it never matches.
    """
    row = F.get(F.from_json(preview, "array<string>"), F.lit(0))
    value = F.get(F.map_values(F.from_json(row, "map<string,string>")), F.lit(0))
    # The character that opens the first value tells its type.
    opening = F.regexp_extract(row, r'^\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*(.)', 1)
    is_flag = opening.isin("t", "f") & value.isin("true", "false")
    is_number = opening.rlike(r"[-0-9NI]")
    is_null = (opening == "n") & value.isNull()
    return {
        "has_expected": F.coalesce(F.size(F.from_json(preview, "array<string>")) > 0, F.lit(False)),
        "expected_num": F.when(is_flag, (value == "true").cast("double")).when(
            is_number, value.cast("double")
        ),
        "expected_str": F.when(is_null, "none").when(~is_flag & ~is_number, value),
    }


def _observed(parts: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """id, observed, retries: whether the results state what is expected, per question."""
    num, text = F.col("expected_num"), F.col("observation")
    hit = any_near(numbers(text), num, TOLERANCE) | mentions(text, F.col("expected_str"))
    whole = parts.where("is_whole").join(asked, "id").select("id", hit.alias("hit"), "retries")
    # Questions of several parts: counts add up, texts are looked at across parts.
    split = parts.where("NOT is_whole")
    of_parts = asked_of_parts(split, asked)
    near = numbers_across(of_parts.where("expected_num IS NOT NULL"))
    across = near.select("id", any_near(F.col("values"), num, TOLERANCE).alias("hit")).unionAll(
        mentions_across(of_parts.where("expected_str IS NOT NULL"), width)
    )
    split_rows = across.withColumn("retries", F.lit(0).cast("bigint")).unionAll(
        split.select("id", F.lit(False).alias("hit"), "retries")
    )
    return (
        whole.unionAll(split_rows)
        .groupBy("id")
        .agg(F.bool_or("hit").alias("observed"), F.sum("retries").alias("retries"))
    )


def scored_questions(
    golden: DataFrame, runs: DataFrame, parts: DataFrame, width: int = PART_WIDTH
) -> DataFrame:
    """One row per golden question: success, correctness, latency, retries.

    `parts` are the observations cut at `width`.  A question without a logged run counts as failed; a failed one is not
    correct and adds no latency and no retries.
    """
    asked = golden.select("id", "has_expected", "expected_num", "expected_str")
    observed = _observed(parts, asked, width)
    answer = F.coalesce("final_output", F.lit(""))
    stated = any_near(numbers(answer), F.col("expected_num"), TOLERANCE) | mentions(
        answer, F.col("expected_str")
    )
    correct = F.col("has_expected") & (stated | F.coalesce("observed", F.lit(False)))
    successful = F.col("successful")
    return (
        asked.join(runs.select("id", "failed", "latency_sec", "final_output"), "id", "left")
        .join(observed, "id", "left")
        .withColumn("successful", ~F.coalesce("failed", F.lit(True)))
        .select(
            "id",
            "successful",
            (successful & correct).alias("is_correct"),
            F.when(successful, F.col("latency_sec")).alias("latency_sec"),
            F.when(successful, F.coalesce("retries", F.lit(0))).otherwise(0).alias("retries"),
        )
    )


def run_metrics(
    scored: DataFrame, calls: DataFrame, labels: dict[str, object] | None = None
) -> DataFrame:
    """One row per run.  Failed questions stay in every denominator."""
    total = F.count("successful")

    def share_of_total(amount: Column, scale: float = 1.0) -> Column:
        share = amount.cast("double") / F.nullif(total, F.lit(0)) * F.lit(scale)
        return F.coalesce(share, F.lit(0.0))

    # Questions and calls in one frame and one aggregation: nothing to join.
    rows = scored.unionByName(call_tokens(calls).drop("call_id"), allowMissingColumns=True)
    measured = rows.agg(
        total.alias("batch_size"),
        F.count_if("successful").alias("successful_executions"),
        F.count_if("is_correct").alias("correct_results"),
        share_of_total(F.count_if("successful"), 100.0).alias("execution_accuracy"),
        share_of_total(F.count_if("is_correct"), 100.0).alias("result_accuracy"),
        # Exact decimals: the sum does not depend on the order of the rows.
        share_of_total(
            money(F.coalesce(F.sum(F.col("latency_sec").cast("decimal(18,6)")), F.lit(0)))
        ).alias("avg_latency_sec"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("total_firewall_blocks_and_retries"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in TOKENS],
    )
    return (
        with_cost(measured)
        .drop("prompt_tokens", "completion_tokens")
        .withColumns({name: F.lit(value) for name, value in (labels or {}).items()})
    )


def report_lines(
    golden: DataFrame, runs: DataFrame, queries: DataFrame, slice_queries: int = SLICE_QUERIES
) -> DataFrame:
    """id, position, line_no, line: what each question asked, ran and answered.

    Line numbers follow from the query numbers, so no question's lines are brought
    together; sorting by (position, line_no) gives the report.  A question's queries meet
    its answer in slices of `SLICE_QUERIES`, each with a copy of the answer's two numbers,
    so a question with half of the log is spread like any other.
    """
    asked = golden.select("id", "position", "question", "has_expected", "expected_num", "expected_str")
    counted = queries.groupBy("id").agg(F.count(F.lit(1)).alias("queries"))
    failed = F.coalesce("failed", F.lit(True))
    answers = (
        asked.join(runs, "id", "left")
        .join(counted, "id", "left")
        .withColumn("queries", F.coalesce("queries", F.lit(0)))
    )
    closing = F.lit(3) + F.greatest(F.col("queries") * 3, F.lit(1))
    no_first_value = (
        F.col("has_expected") & F.col("expected_num").isNull() & F.col("expected_str").isNull()
    )

    def numbered(number: Column | int, text: Column, when: Column | None = None) -> Column:
        number = F.lit(number) if isinstance(number, int) else number
        line = F.struct(number.cast("bigint").alias("line_no"), text.alias("line"))
        return line if when is None else F.when(when, line)

    crash = F.concat(F.lit(FAILED_PREFIX), F.coalesce("error", F.lit(NO_RUN_ERROR)))
    framing = F.when(failed, F.array(numbered(1, crash))).otherwise(
        F.array_compact(
            F.array(
                numbered(1, F.lit(RULE_LINE)),
                numbered(
                    2, F.concat(F.lit(QUESTION_PREFIX), F.col("id").cast("string"), F.lit(QUESTION_END), "question")
                ),
                numbered(3, F.lit(NO_QUERY_LINE), F.col("queries") == 0),
                numbered(
                    closing,
                    F.concat(F.lit(ANSWER_PREFIX), F.coalesce("final_output", F.lit(""))),
                ),
                numbered(
                    closing + 1, F.lit(FAILED_PREFIX + EMPTY_ROW_ERROR), no_first_value
                ),
            )
        )
    )
    at = F.col("query_no") * 3
    steps = F.array(
        numbered(at, F.concat(F.lit(QUERY_PREFIX), F.col("query_no").cast("string"), F.lit(QUERY_END))),
        numbered(at + 1, F.concat(F.lit(SQL_PREFIX), F.coalesce("query", F.lit(NO_TEXT)))),
        numbered(at + 2, F.concat(F.lit(RESULT_PREFIX), F.coalesce("result", F.lit(NO_TEXT)))),
    )
    last = F.expr(f"greatest(queries - 1, 0) div {slice_queries}")
    succeeded = answers.where(~failed).select("id", "position", F.explode(F.sequence(F.lit(0), last)).alias("slice"))
    sliced = queries.withColumn("slice", F.expr(f"(query_no - 1) div {slice_queries}"))
    return (
        answers.select("id", "position", F.inline(framing))
        .unionByName(sliced.join(succeeded, ["id", "slice"]).select("id", "position", F.inline(steps)))
    )
