import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.functions.exprs import haversine_km
from mercato.operators import stats as ST

SETTINGS = dict(max_examples=10, deadline=None, derandomize=True,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

coords = st.tuples(st.floats(-180, 180), st.floats(-90, 90))


@settings(**SETTINGS)
@given(pts=st.lists(st.tuples(coords, coords), min_size=1, max_size=30))
def test_haversine_symmetric_zero_and_bounded(spark, pts):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pts]
    df = spark.createDataFrame(rows, "lon1 double, lat1 double, lon2 double, lat2 double")
    out = df.select(
        haversine_km("lon1", "lat1", "lon2", "lat2").alias("ab"),
        haversine_km("lon2", "lat2", "lon1", "lat1").alias("ba"),
        haversine_km("lon1", "lat1", "lon1", "lat1").alias("aa"),
    ).collect()
    for r in out:
        assert math.isclose(r["ab"], r["ba"], rel_tol=1e-12, abs_tol=1e-9)
        assert r["aa"] == 0.0
        assert 0.0 <= r["ab"] <= math.pi * 6371 + 1e-6


@settings(**SETTINGS)
@given(
    vals=st.lists(st.one_of(st.none(), st.floats(-10, 110, allow_nan=False)), min_size=1, max_size=200),
    bins=st.integers(1, 25),
)
def test_histogram_counts_sum_to_rows_in_range(spark, vals, bins):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = ST.histogram(df, "v", bins, 0.0, 100.0).collect()
    assert len(rows) == bins
    present = np.array([v for v in vals if v is not None], dtype=float)
    assert sum(r["count"] for r in rows) == int(((present >= 0) & (present <= 100)).sum())
    want, _ = np.histogram(present, bins=bins, range=(0, 100))
    assert [r["count"] for r in sorted(rows)] == want.tolist()
