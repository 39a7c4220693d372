"""Splitting a question's results into parts must not change any answer."""

import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.operators.observation import (
    asked_of_parts,
    mentions_across,
    numbers_across,
    observation_parts,
)
from basketry.operators.ordered_log import sliced, with_positions, with_previous
from basketry.operators.tool_log import query_log

EVENTS = "id bigint, seq bigint, kind string, tool string, payload string"


def as_log(spark, questions):
    rows = []
    for i, results in enumerate(questions):
        for n, result in enumerate(results):
            rows.append((i, 2 * n, "tool_start", "sql_db_query", "q"))
            rows.append((i, 2 * n + 1, "tool_end", None, result))
    random.Random(1).shuffle(rows)
    return query_log(spark.createDataFrame(rows, EVENTS).repartition(3), 5)


def random_questions(seed, alphabet, count=400):
    rng = random.Random(seed)
    return [
        ["".join(rng.choices(alphabet, k=rng.randint(0, 4))) for _ in range(rng.randint(0, 9))]
        for _ in range(count)
    ]


@pytest.mark.parametrize("width", [1, 2, 3, 100])
@pytest.mark.parametrize("alphabet", ["12.", "1.-", "1.-a", "7", "1..", "12345.a\n"])
def test_numbers_of_the_whole_text(spark, width, alphabet):
    questions = random_questions(alphabet, alphabet)
    parts = observation_parts(as_log(spark, questions), width)
    found = {i: [] for i in range(len(questions))}
    for row in numbers_across(parts.withColumn("expected_num", F.lit(1.0))).collect():
        found[row["id"]] += row["values"]
    for i, results in enumerate(questions):
        expected = [float(x) for x in re.findall(r"-?\d+\.?\d*", "".join(results))]
        assert sorted(found[i]) == sorted(expected), (width, results)


@pytest.mark.parametrize("width", [1, 2, 3, 100])
def test_mentions_in_the_whole_text(spark, width):
    questions = random_questions(5, "abA")
    rng = random.Random(6)
    wanted = ["".join(rng.choices("abB", k=rng.randint(0, 4))) for _ in questions]
    parts = observation_parts(as_log(spark, questions), width)
    expected = spark.createDataFrame(list(enumerate(wanted)), "id bigint, expected_str string")
    hits = {}
    for row in mentions_across(asked_of_parts(parts, expected), width).collect():
        hits[row["id"]] = hits.get(row["id"], False) or row["mentioned"]
    for i, results in enumerate(questions):
        text = "".join(results)
        assert hits.get(i, False) == (bool(text) and wanted[i].lower() in text.lower()), results


def test_parts_hold_the_text_in_order(spark):
    questions = [["a", "", "Error b", "c", "dddd"], [""], [], ["é"]]
    parts = observation_parts(as_log(spark, questions), 5).orderBy("id", "part").collect()
    assert [r["observation"] for r in parts] == ["aErro", "r bcd", "ddd", "é"]
    assert [r["retries"] for r in parts] == [1, 0, 0, 0]
    assert [r["is_whole"] for r in parts] == [False] * 3 + [True]


def test_numbers_of_many_digits(spark):
    questions = [["0" * 3000 + "7.5"], ["9" * 3000], ["3." + "1" * 3000], ["1" + "0" * 2000 + " 4"]]
    parts = observation_parts(as_log(spark, questions), 1000)
    found = {i: [] for i in range(4)}
    for row in numbers_across(parts.withColumn("expected_num", F.lit(1.0))).collect():
        found[row["id"]] += row["values"]
    assert found[0] == [7.5] and found[1] == [float("inf")]
    assert found[2] == [pytest.approx(3.1111111111)] and sorted(found[3]) == [4.0, float("inf")]


@pytest.mark.parametrize("width", [1, 2, 7, 1000])
def test_previous_and_position_do_not_depend_on_slices(spark, width):
    rng = random.Random(width)
    rows = [(k, s, f"{k}/{s}") for k in (1, 2, 3) for s in rng.sample(range(60), 25)]
    log = spark.createDataFrame(rows, "k bigint, s bigint, v string")
    cut = sliced(log.repartition(4), "k", "s", width)
    counters = {"n": "true", "even": "s % 2 = 0"}
    before = {(r["k"], r["s"]): r["previous"] for r in with_previous(cut, "k", "s", ["v"]).collect()}
    counted = {(r["k"], r["s"]): r for r in with_positions(cut, "k", "s", counters).collect()}
    assert len(before) == len(counted) == len(rows)
    for key in (1, 2, 3):
        steps = sorted((s, v) for k, s, v in rows if k == key)
        evens = [s for s, _ in steps if s % 2 == 0]
        for n, (s, _) in enumerate(steps):
            row = counted[key, s]
            assert (row["n"], row["n_total"]) == (n + 1, 25)
            assert (row["even"], row["even_total"]) == (sum(e <= s for e in evens), len(evens))
            previous = before[key, s]
            assert (previous and previous["v"]) == (steps[n - 1][1] if n else None)


@pytest.mark.parametrize("row", [(None, 1, "x"), (1, None, "x")])
def test_log_rows_without_a_place_are_errors(spark, row):
    log = spark.createDataFrame([(1, 1, "a"), row], "k bigint, s bigint, v string")
    with pytest.raises(Exception, match="lacks k or s"):
        sliced(log, "k", "s").collect()
