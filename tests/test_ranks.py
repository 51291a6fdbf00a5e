"""Exact ranks against sorting, with a key holding most rows."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tracklens.functions.ranks import (
    MEDIAN, MIDDLES, around_percent, at_fraction, interpolated, order_statistics,
)

RANKS = {**MIDDLES, "q25": at_fraction(1, 4), "q75": at_fraction(3, 4), **around_percent(95)}


def expected(values):
    values, n = sorted(values), len(values)
    return {"n": n, "mid_low": values[(n - 1) // 2], "mid_high": values[n // 2],
            "q25": values[n // 4], "q75": values[3 * n // 4],
            "low95": values[(n - 1) * 95 // 100], "high95": values[-(-(n - 1) * 95 // 100)]}


def test_hot_key_ties_and_signs(spark):
    random.seed(1)
    groups = {
        "hot": [random.randrange(-10**15, 10**15) for _ in range(3000)],
        "ties": [5] * 400 + [7] * 401, "one": [-3], "two": [2**58, -(2**58)],
        "near": [2**40 + i for i in range(50)], None: [1, 2, 3, 4],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("hot", None)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "label string, v bigint").repartition(5)
    got = {row.label: row.asDict() for row in order_statistics(df, ["label"], "v", RANKS).collect()}
    assert set(got) == set(groups)
    for label, values in groups.items():
        assert got[label] == {"label": label, **expected(values)}


def test_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(v,) for v in (10, 30, 20)], "v bigint")
    assert order_statistics(df, [], "v", RANKS).first().asDict() == expected([10, 20, 30])
    assert order_statistics(df.filter("v > 99"), [], "v", RANKS).count() == 0


def test_median_and_percentile_text(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 4, 8)], "v bigint")
    row = order_statistics(df, [], "v", {**MIDDLES, **around_percent(75)}).selectExpr(
        f"{MEDIAN} AS m", f"{interpolated(75)} AS p").first()
    assert (row.m, row.p) == (3.0, 5.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**59), 2**59), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    row = order_statistics(df, [], "v", RANKS).first().asDict()
    assert row == expected(values)
    assert (row["mid_low"] + row["mid_high"]) / 2 == pytest.approx(statistics.median(values))
