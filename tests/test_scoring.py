"""Tool-call pairing, verification, run metrics, tokens and the report."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from basketry.functions.text import marks_failure, numbers
from basketry.operators import scoring, tool_log, usage
from basketry.operators.observation import observation_parts
from basketry.plans.evaluate import RUNS_TABLE, LoggedRun, evaluate
from basketry.sources.golden import normalise_golden, read_golden
from basketry.sources.tables import Lake, write_report

EVENTS = "id bigint, seq bigint, kind string, tool string, payload string"
RUNS = "id bigint, final_output string, latency_sec double, failed boolean, error string"
QUERIES = """id bigint, query_no bigint, seq bigint, query string, result string,
  text_end bigint, texts bigint"""
GOLDEN = "id bigint, position bigint, question string, result_preview string"
CALLS = """call_id bigint, id bigint,
  usage_metadata struct<input_tokens: bigint, output_tokens: bigint, total_tokens: bigint>,
  token_usage struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>"""


def golden_of(spark, *previews):
    rows = [(i, i, f"question {i}", preview) for i, preview in enumerate(previews)]
    return normalise_golden(spark.createDataFrame(rows, GOLDEN))


def start(payload, tool="sql_db_query"):
    return ("tool_start", tool, payload)


def end(payload):
    return ("tool_end", None, payload)


PAIRINGS = {
    "plain": ([start("a"), end("1")], [("a", "1")]),
    "second start replaces the first": ([start("a"), start("b"), end("1")], [("b", "1")]),
    "other tool": ([start("a", "sql_db_schema"), end("1")], []),
    "other tool replaces": ([start("a"), start("b", "checker"), end("1")], []),
    "end without start": ([end("1"), end("2")], []),
    "one end per start": ([start("a"), end("1"), end("2")], [("a", "1")]),
    "several": ([start("a"), end("1"), start("b"), end("2")], [("a", "1"), ("b", "2")]),
    "open at the end": ([start("a")], []),
}


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_pairing(spark, width):
    rows, expected = [], {}
    for i, (steps, logged) in enumerate(PAIRINGS.values()):
        rows += [(i, 10 * n, *step) for n, step in enumerate(steps)]
        rows += [(i, 10 * n + 5, "llm_end", None, "x") for n in range(3)]
        expected[i] = logged
    log = tool_log.query_log(spark.createDataFrame(rows, EVENTS).repartition(3), width).collect()
    for i, logged in expected.items():
        found = sorted((r["query_no"], r["query"], r["result"]) for r in log if r["id"] == i)
        assert found == [(n, *pair) for n, pair in enumerate(logged, 1)]


@pytest.mark.parametrize(
    "text, found",
    [
        ("-3.", [-3.0]),
        ("1,234.5", [1.0, 234.5]),
        ("2010-12", [2010.0, -12.0]),
        ("1.5e7", [1.5, 7.0]),
        ("none", []),
        ("1.2.3", [1.2, 3.0]),
    ],
)
def test_numbers(spark, text, found):
    assert spark.range(1).select(numbers(F.lit(text))).first()[0] == found


def test_failure_marks_are_case_sensitive(spark):
    frame = spark.createDataFrame(
        [("Error: x", True), ("BLOCKED", True), ("error blocked", False), (None, False)],
        "result string, expected boolean",
    )
    assert frame.where(marks_failure(F.col("result")) != F.col("expected")).isEmpty()


PREVIEWS = [
    # preview, has_expected, expected_num, expected_str
    ('[{"z": 12.5, "a": 1}]', True, 12.5, None),  # the first key, not the smallest
    ('[{"n": 7}, {"n": 8}]', True, 7.0, None),
    ('[{"flag": true}]', True, 1.0, None),
    ('[{"flag": false}]', True, 0.0, None),
    ('[{"name": "Foo \\"x\\""}]', True, None, 'Foo "x"'),
    ('[{"name": "12"}]', True, None, "12"),
    ('[{"name": "true"}]', True, None, "true"),
    ('[{"name": ""}]', True, None, ""),
    ('[{"a\\"b": null}]', True, None, "none"),
    ("[{}]", True, None, None),
    ("[]", False, None, None),
    (None, False, None, None),
    ('[{"n": -1.5e3}]', True, -1500.0, None),
]


def test_expected_values(spark):
    golden = golden_of(spark, *[case[0] for case in PREVIEWS])
    found = [
        (r["has_expected"], r["expected_num"], r["expected_str"])
        for r in golden.orderBy("position").collect()
    ]
    assert found == [case[1:] for case in PREVIEWS]


def test_golden_file_keeps_its_order(spark, tmp_path):
    items = [
        {"id": 9, "question": "first", "result_preview": [{"z": 1, "a": 2}]},
        {"id": 2, "question": "second", "result_preview": []},
        {"id": 5, "question": "third", "result_preview": [{"name": "UK"}], "sql": "SELECT 1"},
    ]
    array = tmp_path / "golden.json"
    array.write_text(json.dumps(items, indent=1))
    lines = tmp_path / "golden.jsonl"
    lines.write_text("\n".join(map(json.dumps, items)))
    for golden in (read_golden(spark, str(array)), read_golden(spark, str(lines), json_lines=True)):
        rows = golden.orderBy("position").collect()
        assert [r["id"] for r in rows] == [9, 2, 5]
        assert rows[0]["expected_num"] == 1.0 and rows[2]["expected_str"] == "UK"
        assert not rows[1]["has_expected"]
        assert {r["id"] for r in scoring.first_items(golden, 2).collect()} == {9, 2}
        assert scoring.first_items(golden, None).count() == 3


CHECKS = [
    # preview, results, final text, correct
    ('[{"v": 12.5}]', [], "about 12.505", True),
    ('[{"v": 12.5}]', [], "about 12.52", False),
    ('[{"v": 12.5}]', ["[(12.5,)]"], "no idea", True),
    ('[{"v": 12.5}]', ["1", "2.5"], "no idea", True),  # adjacent results fuse
    ('[{"v": 2.5}]', ["1", "2.5"], "no idea", False),
    ('[{"v": 1234.5}]', [], "1,234.5", False),
    ('[{"v": "Foo"}]', [], "the FOO bar", True),
    ('[{"v": "Foo"}]', ["a f", "o", "o"], "", True),
    ('[{"v": 123.5}]', ["1", "2", "3.", "5 apples"], "no idea", True),
    ('[{"v": 5}]', ["1", "2", "3.", "5 apples"], "no idea", False),
    ('[{"v": ""}]', [], "", True),
    ('[{"v": null}]', [], "has None", True),
    ('[{"v": true}]', [], "1", True),
    ("[]", ["1"], "1", False),
    ("[{}]", ["1"], "1", False),
    ('[{"v": 1}]', ["1"], None, True),
]


@pytest.mark.parametrize("width", [2, 1000])
def test_verification(spark, width):
    golden = golden_of(spark, *[case[0] for case in CHECKS])
    queries = spark.createDataFrame(
        [
            (i, n, n, "q", result, len("".join(case[1][:n])), len("".join(case[1])))
            for i, case in enumerate(CHECKS)
            for n, result in enumerate(case[1], 1)
        ],
        QUERIES,
    )
    runs = spark.createDataFrame(
        [(i, case[2], 1.0, False, None) for i, case in enumerate(CHECKS)], RUNS
    )
    scored = scoring.scored_questions(golden, runs, observation_parts(queries, width), width)
    found = {r["id"]: r["is_correct"] for r in scored.collect()}
    assert found == {i: case[3] for i, case in enumerate(CHECKS)}


@pytest.fixture(scope="module")
def small_run(spark):
    golden = golden_of(spark, '[{"v": 1}]', '[{"v": 2}]', "[{}]", '[{"v": 4}]', '[{"v": 5}]')
    runs = spark.createDataFrame(
        [
            (0, "1", 2.0, False, None),
            (1, "two", 3.0, False, None),
            (2, "any", 1.0, False, None),
            (3, None, 99.0, True, "timeout"),
        ],
        RUNS,
    )
    queries = spark.createDataFrame(
        [
            (0, 1, 4, "SELECT a", "Error: no column", 16, 22),
            (0, 2, 8, "SELECT b", "[(1,)]", 22, 22),
            (2, 1, 3, "SELECT c", "BLOCKED", 7, 7),
            (3, 1, 2, "SELECT d", "Error: late", 11, 11),
        ],
        QUERIES,
    )
    return golden, runs, queries


def scored_of(run):
    golden, runs, queries = run
    return scoring.scored_questions(golden, runs, observation_parts(queries))


def test_run_metrics(spark, small_run):
    calls = spark.createDataFrame(
        [
            (1, 0, (1_000_000, 500_000, 1_500_000), (9, 9, 9)),
            (1, 0, (1_000_000, 500_000, 1_500_000), (9, 9, 9)),  # logged twice, counts once
            (2, 0, None, (10, None, 10)),
            (3, 1, (None, 5, None), (7, 7, 7)),  # the first layout wins whole
            (4, 1, None, None),
        ],
        CALLS,
    )
    row = scoring.run_metrics(
        scored_of(small_run), calls, {"model_name": "m", "temperature": 0.0}
    ).first()
    assert row["batch_size"] == 5
    assert (row["successful_executions"], row["correct_results"]) == (3, 1)
    assert row["execution_accuracy"] == 60.0 and row["result_accuracy"] == 20.0
    assert row["avg_latency_sec"] == 6.0 / 5  # failed questions stay in the denominator
    assert row["total_firewall_blocks_and_retries"] == 2  # none from the failed question
    assert row["total_tokens"] == 1_500_010
    assert row["estimated_cost_usd"] == pytest.approx(0.05 * 1.00001 + 0.08 * 0.500005)
    assert (row["model_name"], row["temperature"]) == ("m", 0.0)


def test_metrics_of_an_empty_batch_are_zero(spark, small_run):
    golden, runs, queries = small_run
    scored = scoring.scored_questions(golden.limit(0), runs, observation_parts(queries))
    row = scoring.run_metrics(scored, spark.createDataFrame([], CALLS)).first()
    assert all(value == 0 for value in row)


def test_empty_first_layout_and_calls_without_id(spark):
    rows = [
        (1, 0, (None, None, None), (10, 5, 15)),
        (None, 0, (1, 1, 2), None),
        (None, 0, (3, 3, 6), None),
        (2, 0, (4, None, 4), (100, 100, 200)),
        (2, 0, (4, None, 4), None),
    ]
    assert tuple(usage.token_totals(spark.createDataFrame(rows, CALLS)).first()) == (18, 9, 27)


def test_planning_a_run_starts_no_job(spark, small_run):
    golden, runs, _ = small_run
    events = spark.createDataFrame([(0, 1, "tool_start", "sql_db_query", "q")], EVENTS)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    logged = LoggedRun(golden, runs, events, spark.createDataFrame([], CALLS))
    logged.scored(), logged.metrics(), logged.report()
    assert list(tracker.getJobIdsForGroup("planning")) == []


def test_tokens_without_calls(spark):
    assert tuple(usage.token_totals(spark.createDataFrame([], CALLS)).first()) == (0, 0, 0)


REPORT = """
=======================
Q0: question 0
--- Query 1 ---
SQL: SELECT a
DB Result: Error: no column
--- Query 2 ---
SQL: SELECT b
DB Result: [(1,)]
Final Output: 1

=======================
Q1: question 1
 MODEL HALLUCINATED! (No DB queries executed)
Final Output: two

=======================
Q2: question 2
--- Query 1 ---
SQL: SELECT c
DB Result: BLOCKED
Final Output: any
CRITICAL FAIL | list index out of range
CRITICAL FAIL | timeout
CRITICAL FAIL | no run logged"""


def test_report(spark, small_run, tmp_path):
    lines = scoring.report_lines(*small_run)
    write_report(lines, str(tmp_path / "report"))
    files = sorted((tmp_path / "report").glob("part-*"))
    assert "".join(f.read_text() for f in files) == REPORT + "\n"


def test_questions_without_queries(spark, small_run):
    golden, runs, queries = small_run
    assert {r["id"] for r in tool_log.without_queries(golden, runs, queries).collect()} == {1}


def test_a_logged_run_end_to_end(spark, small_run, tmp_path):
    golden, runs, queries = small_run
    events = spark.createDataFrame(
        [
            row
            for q in queries.collect()
            for row in (
                (q["id"], 10 * q["query_no"], "tool_start", "sql_db_query", q["query"]),
                (q["id"], 10 * q["query_no"] + 1, "tool_end", None, q["result"]),
            )
        ],
        EVENTS,
    )
    lake = Lake(spark)
    calls = spark.createDataFrame([(1, 0, (1, 2, 3), None), (2, 4, (10, 20, 30), None)], CALLS)
    logged = LoggedRun(golden, runs, events, calls)
    first_two = replace(logged, batch_size=2)
    evaluate(lake, logged, str(tmp_path / "all"), {"model_name": "m"})
    evaluate(lake, first_two, str(tmp_path / "two"), {"model_name": "m"})
    rows = lake.table(RUNS_TABLE).orderBy("batch_size").collect()
    assert len({r["run_id"] for r in rows}) == 2 and all(r["started_at"] for r in rows)
    assert [r["batch_size"] for r in rows] == [2, 5]
    assert [r["execution_accuracy"] for r in rows] == [100.0, 60.0]
    assert [r["total_tokens"] for r in rows] == [3, 33]  # of the batch's questions only
    text = "".join(f.read_text() for f in sorted((tmp_path / "all").glob("part-*")))
    assert text == REPORT + "\n"
    short = "".join(f.read_text() for f in sorted((tmp_path / "two").glob("part-*")))
    assert "Q1" in short and "Q2" not in short
