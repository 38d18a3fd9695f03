"""The distributed search against a plain sort."""

from dataclasses import replace

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tableward.config import DEFAULTS
from tableward.operators import quantiles as Q

SEARCH = replace(DEFAULTS, quantile_inline_rows=0)
PROBS = (0.0, 0.25, 0.5, 0.9, 1.0)


def brute(xs):
    return [float(np.quantile(np.array(xs, dtype=float), p)) for p in PROBS]


@pytest.mark.parametrize("cfg", [DEFAULTS, SEARCH])
@pytest.mark.parametrize(
    "xs",
    [
        [5.0],
        [1.0, 2.0, 4.0, 7.0, 11.0],
        [7.0] * 4000 + list(range(2000)),  # one value holds most of the rows
        [float(i * 7919 % 10007) for i in range(10007)],
        [1e300, -1e300, 0.0, 1e-300] * 5,
    ],
)
def test_matches_sort(spark, cfg, xs):
    df = spark.createDataFrame([(float(x), None) for x in xs], "v double, nothing double")
    got = Q.quantile_values(df, ["v", "nothing"], PROBS, cfg)
    assert got["v"] == pytest.approx(brute(xs), rel=1e-12)
    assert got["nothing"] == [None] * len(PROBS)


def test_groups(spark):
    rows = [("hot", float(i % 977)) for i in range(6000)] + [(f"g{i % 3}", float(i)) for i in range(900)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r["g"]: r["value"] for r in Q.quantiles(df, ["v"], (0.5,), ["g"]).collect()}
    got = {r["g"]: r["value"] for r in Q.quantiles(df, ["v"], (0.5,), ["g"], SEARCH).collect()}
    assert want[None] == 1.0
    assert want == got
    assert got["hot"] == float(np.median([i % 977 for i in range(6000)]))


def test_wrong_bracket_is_widened(spark, monkeypatch):
    real = Q._bounds

    def off(suffix, p, margin):
        lo, hi = real(suffix, p, margin)
        return (lo, hi) if margin == Q._MARGINS[-1] else (f"{lo} + 1e6D", f"{hi} + 1e6D")

    monkeypatch.setattr(Q, "_bounds", off)
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS v", "'g' AS g")
    assert Q.quantile_values(df, ["v"], (0.5,), SEARCH) == {"v": [500.0]}
    assert Q.quantiles(df, ["v"], (0.5,), ["g"], SEARCH).first()["value"] == 500.0


def test_many_values_inside_brackets(spark, monkeypatch):
    """Too many for a window: the ranged way inside the column search."""
    xs = [float(i * 7919 % 10007) for i in range(10007)] + [3.0] * 5000
    df = spark.createDataFrame([(x, -x) for x in xs], "v double, w double")
    got = Q.quantile_values(df, ["v", "w"], PROBS, replace(SEARCH, quantile_inline_rows=5))
    assert got["v"] == pytest.approx(brute(xs)) and got["w"] == pytest.approx(brute([-x for x in xs]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_any_list(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    assert Q.quantile_values(df, ["v"], PROBS)["v"] == pytest.approx(brute(xs))
