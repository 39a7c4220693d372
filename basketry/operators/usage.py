"""Token usage and cost of the model calls behind a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Default prices in USD per million tokens.
USD_PER_MILLION_PROMPT = 0.05
USD_PER_MILLION_COMPLETION = 0.08

TOKENS = ("prompt_tokens", "completion_tokens", "total_tokens")


def call_tokens(calls: DataFrame) -> DataFrame:
    """Tokens per call, each call id once; calls without an id each count.

    A call reports usage in one of two layouts.  The first, when it has any field,
    counts whole; fields it lacks are 0 and are not looked up in the second.
    """
    current, older = F.col("usage_metadata"), F.col("token_usage")
    fields = ("input_tokens", "output_tokens", "total_tokens")
    reported = F.coalesce(*[current[name] for name in fields]).isNotNull()

    def pick(name: str, older_name: str) -> Column:
        return F.coalesce(
            F.when(reported, current[name]).otherwise(older[older_name]), F.lit(0)
        ).cast("bigint")

    layouts = {
        "prompt_tokens": pick("input_tokens", "prompt_tokens"),
        "completion_tokens": pick("output_tokens", "completion_tokens"),
        "total_tokens": pick("total_tokens", "total_tokens"),
    }
    # A call logged twice carries the same numbers; max combines before the shuffle.
    rows = calls.select("call_id", *[value.alias(name) for name, value in layouts.items()])
    known = rows.where("call_id IS NOT NULL").groupBy("call_id")
    return known.agg(*[F.max(name).alias(name) for name in TOKENS]).unionByName(
        rows.where("call_id IS NULL")
    )


def calls_of(calls: DataFrame, questions: DataFrame) -> DataFrame:
    """The calls made for the given questions."""
    return calls.join(questions.select("id").distinct(), "id", "left_semi")


def token_totals(calls: DataFrame) -> DataFrame:
    """One row: tokens of the whole run."""
    return call_tokens(calls).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in TOKENS]
    )


def with_cost(
    totals: DataFrame,
    usd_per_million_prompt: float = USD_PER_MILLION_PROMPT,
    usd_per_million_completion: float = USD_PER_MILLION_COMPLETION,
) -> DataFrame:
    """Add the estimated price of the tokens."""
    million = F.lit(1_000_000.0)
    return totals.withColumn(
        "estimated_cost_usd",
        F.col("prompt_tokens") / million * F.lit(usd_per_million_prompt)
        + F.col("completion_tokens") / million * F.lit(usd_per_million_completion),
    )
