"""Regression line with a resampled band, against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from mercato.operators import regression as R
from mercato.operators import resampling as RS

SCHEMA = "id string, x double, y double, replicate string, weight int, _x string"


def frame(spark, rows):
    """Rows of (id, x, y) with columns whose names are used inside."""
    return spark.createDataFrame([(*r, "other", 7, "other") for r in rows], SCHEMA)


def weight(key, replicate, seed=0):
    digest = hashlib.md5(f"{seed}/{key or ''}/{replicate // 8}".encode()).hexdigest()
    draw = int(digest[replicate % 8 * 4:replicate % 8 * 4 + 4], 16)
    below, k = 0.0, 0
    while True:
        below += math.exp(-1) / math.factorial(k)
        if draw < math.floor(65536 * below) or k == 8:
            return k
        k += 1


def plain_lines(rows, replicates, seed=0):
    out = {}
    kept = [(i, x, y) for i, x, y in rows if x is not None and y is not None and not math.isnan(x) and not math.isnan(y)]
    for r in range(replicates):
        drawn = [(x, y) for i, x, y in kept for _ in range(weight(i, r, seed))]
        if drawn:
            xs, ys = np.array(drawn).T
            spread = ((xs - xs.mean()) ** 2).sum()
            slope = ((xs - xs.mean()) * (ys - ys.mean())).sum() / spread if len(set(xs)) > 1 else 0.0
            out[r] = (len(drawn), slope, ys.mean() - slope * xs.mean())
    return out


def data(n=120, seed=3):
    rnd = random.Random(seed)
    rows = [(f"k{rnd.randint(0, n // 2)}", rnd.uniform(-2, 5), rnd.gauss(0, 1)) for _ in range(n)]
    rows = [(i, x, 3 - 0.4 * x + e * (1 + abs(x))) for i, x, e in rows]
    return rows + rows[:5] + [(None, 1.0, 2.0), ("", 0.5, 2.5), ("n", None, 1.0), ("n", 1.0, None), ("n", float("nan"), 1.0), ("n", 1.0, float("nan"))]


@pytest.mark.parametrize("seed", [0, 11])
def test_lines_against_plain_python(spark, seed):
    rows = data()
    got = {r["replicate"]: (r["n"], r["slope"], r["level"]) for r in RS.replicate_lines(frame(spark, rows).repartition(5), "y", "x", ["id"], 21, seed).collect()}
    want = plain_lines(rows, 21, seed)
    assert got.keys() == want.keys() and all(got[r][0] == want[r][0] and got[r][1:] == pytest.approx(want[r][1:], rel=1e-9) for r in want)


def test_band_against_plain_python(spark):
    rows = data()
    got = RS.regression_line_resampled(frame(spark, rows), "y", "x", ["id"], points=7, level=0.9, replicates=50).orderBy("point").collect()
    lines = plain_lines(rows, 50).values()
    plain = R.regression_line(frame(spark, rows), "y", "x", points=7).orderBy("point").collect()
    for r, p in zip(got, plain):
        at = [level + slope * r["x"] for _, slope, level in lines]
        assert (r["point"], r["x"], r["fitted"]) == pytest.approx((p["point"], p["x"], p["fitted"]))
        assert (r["ci_low"], r["ci_high"]) == pytest.approx(tuple(np.quantile(at, [0.05, 0.95])), rel=1e-9)
    assert len(got) == 7


def test_small_and_level_data(spark):
    level = [(f"k{i}", 2.0, float(i % 3)) for i in range(9)]
    got = RS.regression_line_resampled(frame(spark, level), "y", "x", ["id"], points=2, replicates=16).collect()
    assert all(r["x"] == 2.0 and r["ci_low"] <= r["ci_high"] for r in got) and len(got) == 2
    # a unit that a replicate does not draw leaves it without rows
    one = frame(spark, [("only", 1.0, 2.0)])
    lines = RS.replicate_lines(one, "y", "x", ["id"], 40).collect()
    assert {r["replicate"]: r["n"] for r in lines} == {k: weight("only", k) for k in range(40) if weight("only", k)} and 0 < len(lines) < 40
    assert all((r["slope"], r["level"]) == (0.0, 2.0) for r in lines)
    assert RS.replicate_lines(one.limit(0), "y", "x", ["id"], 8).count() == 0
    with pytest.raises(ValueError):
        RS.regression_line_resampled(one.limit(0), "y", "x", ["id"])
    for bad in ({"replicates": 1}, {"points": 0}, {"level": 1.0}):
        with pytest.raises(ValueError):
            RS.regression_line_resampled(one, "y", "x", ["id"], **bad)


def test_draws_are_poisson_and_far_offsets_do_no_harm(spark):
    cuts = RS.poisson_cuts()
    shares = np.diff([0, *cuts, 65536]) / 65536
    assert shares @ np.arange(len(shares)) == pytest.approx(1, abs=2e-4) and shares @ (np.arange(len(shares)) - 1.0) ** 2 == pytest.approx(1, abs=1e-3)
    rows = [(i, x, y) for i, x, y in data() if x is not None and y is not None]
    near = RS.regression_line_resampled(frame(spark, rows), "y", "x", ["id"], points=3, replicates=24).orderBy("point").collect()
    far = RS.regression_line_resampled(frame(spark, [(i, x + 1e7, y - 1e6) for i, x, y in rows]), "y", "x", ["id"], points=3, replicates=24).orderBy("point").collect()
    assert all((b["ci_low"] + 1e6, b["ci_high"] + 1e6) == pytest.approx((a["ci_low"], a["ci_high"]), abs=1e-5) for a, b in zip(near, far))


def test_band_is_near_the_analytic_one_where_that_holds(spark):
    rnd = random.Random(8)
    rows = [(str(k), x, 1 + 2 * x + rnd.gauss(0, 1)) for k, x in enumerate(rnd.uniform(0, 1) for _ in range(3000))]
    df = frame(spark, rows)
    own = RS.regression_line_resampled(df, "y", "x", ["id"], points=5, replicates=400).orderBy("point").collect()
    known = R.regression_line(df, "y", "x", points=5).orderBy("point").collect()
    assert all(0.8 < (a["ci_high"] - a["ci_low"]) / (b["ci_high"] - b["ci_low"]) < 1.25 and a["ci_low"] < a["fitted"] < a["ci_high"] for a, b in zip(own, known))


def test_hot_units_stay_in_their_tasks(spark):
    """Rows are dealt evenly and reduced to a row a replicate before the exchange by replicate, whatever share a unit has."""
    df = frame(spark, [("hot" if k % 3 else str(k), float(k), float(k % 7)) for k in range(300)])
    plan = RS.replicate_lines(df, "y", "x", ["id"], 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(replicate") == 1 and plan.count("Exchange") == 2 and "RoundRobinPartitioning" in plan and "partial_sum" in plan
