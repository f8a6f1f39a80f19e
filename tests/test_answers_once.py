"""Answers are stripped and checked once for each row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from attestry.functions import responses
from attestry.functions.text import strip


def test_the_seal_is_checked_once(spark):
    """A filter on the outcome is not pushed below the check, which would repeat it there."""
    raw = spark.createDataFrame([("{}",), ("{} more",), (None,)], "raw string")
    parsed = responses.parse_responses(raw).where(F.col("status") == "success")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$[1]") == 1
    assert [r["status"] for r in parsed.collect()] == ["success"]


@pytest.mark.parametrize(
    "raw",
    ["{}", "{}\u00a0", "\u3000{}", "`{}`", "``` {} ```", "```json\n{}\n```", "{", "`", "", " ", "```", "[1]\n", "\t}", None],
)
def test_clean_ends_are_not_walked_but_come_out_alike(evaluate, raw):
    found = evaluate([(raw,)], "raw string", responses._strip_answer("raw"))
    assert found == evaluate([(raw,)], "raw string", strip("raw"))
