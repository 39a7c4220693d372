"""Scoring a logged run: tool events, answers and golden questions -> metrics and report."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from basketry.operators import scoring
from basketry.operators.observation import PART_WIDTH, observation_parts
from basketry.operators.tool_log import executed_queries, numbered
from basketry.operators.usage import calls_of
from basketry.sources.tables import Lake, write_report

RUNS_TABLE = "eval_runs"
QUERY_LOG_TABLE = "eval_query_log"


@dataclass(frozen=True)
class LoggedRun:
    """The logs of one run.  Results are plans: nothing runs before they are asked for."""

    golden: DataFrame
    runs: DataFrame
    events: DataFrame
    calls: DataFrame
    batch_size: int | None = None
    part_width: int = PART_WIDTH
    query_log: DataFrame | None = None

    def questions(self) -> DataFrame:
        return scoring.first_items(self.golden, self.batch_size)

    def queries(self) -> DataFrame:
        """The numbered query log, from the events unless it is given."""
        return self.query_log if self.query_log is not None else numbered(executed_queries(self.events))

    def scored(self) -> DataFrame:
        """One row per question."""
        parts = observation_parts(self.queries(), self.part_width)
        return scoring.scored_questions(self.questions(), self.runs, parts, self.part_width)

    def metrics(self, labels: dict[str, object] | None = None) -> DataFrame:
        """One row for the run, with the calls of its questions."""
        calls = self.calls
        if self.batch_size is not None:
            calls = calls_of(calls, self.questions())
        return scoring.run_metrics(self.scored(), calls, labels)

    def report(self) -> DataFrame:
        """The report, line by line."""
        return scoring.report_lines(self.questions(), self.runs, self.queries())


def evaluate(
    lake: Lake, logged: LoggedRun, report_path: str, labels: dict[str, object] | None = None
) -> str:
    """Append the metrics to the table of runs and write the report as text.

    The query log is written once, into the lake, for both; the next evaluation
    replaces it.  Returns the run's id, which its row of metrics carries.
    """
    run = {"run_id": uuid.uuid4().hex, "started_at": datetime.now(timezone.utc)}
    lake.replace(QUERY_LOG_TABLE, logged.queries())
    logged = replace(logged, query_log=lake.table(QUERY_LOG_TABLE))
    lake.append(RUNS_TABLE, logged.metrics({**(labels or {}), **run}))
    write_report(logged.report(), report_path)
    return run["run_id"]
