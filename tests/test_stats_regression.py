import math

import numpy as np
import pytest

from mercato.functions.distributions import f_sf, t_quantile, t_two_sided_p
from mercato.operators import orders as O
from mercato.operators import regression as R
from mercato.operators import stats as ST
from mercato.plans.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(10, 3, 400), np.full(150, 4.0), rng.integers(0, 20, 250).astype(float)])
    g = np.arange(len(x)) % 3
    df = spark.createDataFrame([(float(v), int(k)) for v, k in zip(x, g)] + [(None, 0)], "v double, g int")
    return df, x, g


@pytest.mark.parametrize("rpb", [2_000_000, 5, 37])
def test_exact_quantiles_match_numpy(values, rpb):
    df, x, _ = values
    q = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0, 0.3333], rows_per_bucket=rpb)
    for p, v in q.items():
        assert v == pytest.approx(float(np.percentile(x, p * 100)), rel=1e-12, abs=1e-12)


def test_describe(values):
    df, x, _ = values
    r = ST.describe_column(df, "v").first()
    assert r["count"] == len(x)
    assert r["mean"] == pytest.approx(x.mean())
    assert r["std"] == pytest.approx(x.std(ddof=1))
    assert (r["min"], r["max"]) == (x.min(), x.max())
    assert r["p50"] == pytest.approx(np.median(x))


def test_histogram_matches_numpy_including_edges(spark):
    vals = [0.0, 4.0, 8.0, 79.999, 80.0, 80.1, -1.0, 3.9999999, 40.0, 12.0, 12.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = {r["bin"]: r["count"] for r in ST.histogram(df, "v", 20, 0.0, 80.0).collect()}
    want, edges = np.histogram(vals, bins=20, range=(0, 80))
    assert [got[i] for i in range(20)] == want.tolist()
    rows = sorted(ST.histogram(df, "v", 20, 0.0, 80.0).collect())
    assert [r["bin_lo"] for r in rows] == edges[:-1].tolist()
    # default range = data range, 10 bins
    got = sorted((r["bin"], r["count"]) for r in ST.histogram(df, "v").collect())
    assert [c for _, c in got] == np.histogram(vals, bins=10)[0].tolist()


def test_histogram_by_has_all_bins(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 49.9), (2, 50.0), (2, 60.0), (None, 1.0)], "k int, v double")
    rows = ST.histogram_by(df, "v", "k", 10, 0.0, 50.0).collect()
    assert len(rows) == 20
    assert sum(r["count"] for r in rows) == 3


def test_round_column_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (2.4,)], "v double")
    assert [r["v"] for r in ST.round_column(df, "v").collect()] == [0.0, 2.0, 2.0, -0.0, 2.0]


def test_correlation_matrix_and_constant_column(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    b = a * 0.5 + rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in zip(a, b)], "a double, b double, c double")
    m = {(r["x"], r["y"]): r["corr"] for r in ST.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9
    assert m[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1], rel=1e-12)
    assert m[("a", "b")] == m[("b", "a")]
    assert m[("a", "a")] == pytest.approx(1.0)
    assert m[("a", "c")] is None
    # missing values leave only their own pairs
    holes = df.selectExpr("if(a > 1, null, a) as a", "if(b > 1, double('nan'), b) as b", "a + b as c")
    m = {(r["x"], r["y"]): r["corr"] for r in ST.correlation_matrix(holes, ["a", "b", "c"]).collect()}
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        v = {"a": np.where(a > 1, np.nan, a), "b": np.where(b > 1, np.nan, b), "c": a + b}
        ok = ~np.isnan(v[x]) & ~np.isnan(v[y])
        assert m[(x, y)] == pytest.approx(np.corrcoef(v[x][ok], v[y][ok])[0, 1], rel=1e-12)


def test_zscore_population_std_and_propagation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 3.0)], "a double, b double")
    z = ST.zscore(df, ["a", "b"]).collect()
    a = np.array([1.0, 2.0, 3.0])
    assert [r["a"] for r in z] == pytest.approx(((a - a.mean()) / a.std()).tolist())
    assert all(r["b"] is None for r in z)  # one missing value: the whole column is missing
    z2 = ST.zscore(df, ["b"], nan_policy="omit").collect()
    assert [r["b"] for r in z2][0] == pytest.approx(-1.0)


def test_kde_matches_direct_sum(values):
    df, x, g = values
    rows = ST.kde_curve(df, "v", "g", grid_points=50).collect()
    assert len(rows) == 150
    for grp in range(3):
        xs = x[g == grp]
        bw = xs.std(ddof=1) * len(xs) ** -0.2
        grid = np.linspace(xs.min() - 3 * bw, xs.max() + 3 * bw, 50)
        dens = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / bw) ** 2).sum(axis=1) / (len(xs) * bw * math.sqrt(2 * math.pi))
        got = sorted((r["point"], r["x"], r["density"]) for r in rows if r["g"] == grp)
        assert [p[1] for p in got] == pytest.approx(grid.tolist(), rel=1e-12)
        assert [p[2] for p in got] == pytest.approx(dens.tolist(), rel=1e-9)


def test_distribution_known_values():
    assert t_two_sided_p(2.228138851986274, 10) == pytest.approx(0.05, rel=1e-12)
    assert t_quantile(0.975, 10) == pytest.approx(2.228138851986274, rel=1e-13)
    assert t_quantile(0.975, 1) == pytest.approx(12.706204736174707, rel=1e-12)
    assert t_quantile(0.025, 30) == pytest.approx(-2.0422724563012373, rel=1e-12)
    assert f_sf(4.964602743730711, 1, 10) == pytest.approx(0.05, rel=1e-12)
    assert t_two_sided_p(1.959963984540054, 1e9) == pytest.approx(0.05, rel=1e-9)


def _numpy_ols(X, y):
    X1 = np.column_stack([np.ones(len(y)), X])
    pinv = np.linalg.pinv(X1)
    beta = pinv @ y
    rank = np.linalg.matrix_rank(X1)
    r = y - X1 @ beta
    s2 = r @ r / (len(y) - rank)
    return beta, np.sqrt(np.diag(s2 * pinv @ pinv.T)), rank, r


def test_ols_full_rank_and_collinear_match_numpy(spark):
    rng = np.random.default_rng(11)
    n = 500
    x1 = rng.normal(50, 10, n)
    x2 = rng.normal(size=n)
    y = 3.0 + 0.2 * x1 - 1.5 * x2 + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b), float(b), float(c)) for a, b, c in zip(x1, x2, y)],
                               "x1 double, x2 double, x3 double, y double")
    for xs, X in ((["x1", "x2"], np.column_stack([x1, x2])), (["x1", "x2", "x3"], np.column_stack([x1, x2, x2]))):
        m = R.fit(df, "y", xs)
        beta, bse, rank, r = _numpy_ols(X, y)
        assert m.rank == rank
        assert m.params == pytest.approx(beta, rel=1e-8, abs=1e-10)
        assert m.bse == pytest.approx(bse, rel=1e-8)
        assert m.ssr == pytest.approx(r @ r, rel=1e-9)
        scored = R.ols_error(R.ols_score(df, m)).first()
        assert scored["mse"] == pytest.approx((r * r).mean(), rel=1e-9)
    tab = {r["variable"]: r for r in R.ols_fit(df, "y", ["x1", "x2"]).collect()}
    assert set(tab) == {"Intercept", "x1", "x2"}
    assert tab["x1"]["p_value"] < 1e-10
    sig = R.ols_significant(R.ols_fit(df, "y", ["x1", "x2"])).collect()
    assert [r["variable"] for r in sig] == ["Intercept", "x1", "x2"]


def test_ols_on_fixture(sf01):
    data = O.order_training(sf01)
    pdf = data.toPandas()
    m = R.fit(data, "review_score", ["wait_time"])
    beta, bse, _, _ = _numpy_ols(pdf[["wait_time"]].to_numpy(float), pdf.review_score.to_numpy(float))
    assert m.params == pytest.approx(beta, rel=1e-10)
    assert m.bse == pytest.approx(bse, rel=1e-9)
    # correlation of review score and wait time on reviewed delivered orders (FIXTURES.md)
    reviewed = O.order_wait_time(sf01).join(O.order_review_score(sf01), "order_id")
    c = {(r["x"], r["y"]): r["corr"] for r in ST.correlation_matrix(reviewed, ["review_score", "wait_time"]).collect()}
    assert round(c[("review_score", "wait_time")], 4) == -0.9235
    z = ST.zscore(data)
    m4 = R.fit(z, "review_score", ST.ZSCORE_COLUMNS)
    assert m4.rank == 7 and m4.df_model == 6  # number_of_products == number_of_sellers
    # the one-pass fit on z-scores gives the same model as z-scoring first
    m4b = R.fit(data, "review_score", ST.ZSCORE_COLUMNS, standardize=ST.ZSCORE_COLUMNS)
    assert m4b.rank == 7
    assert m4b.params == pytest.approx(m4.params, rel=1e-9, abs=1e-12)
    assert m4b.bse == pytest.approx(m4.bse, rel=1e-9)
    e1 = R.ols_error(R.ols_score(z, m4)).first()
    e2 = R.ols_error(R.ols_score(data, m4b)).first()
    assert e2["mse"] == pytest.approx(e1["mse"], rel=1e-9)
    summ = R.ols_summary(z, m4, order_by=["order_id", "review_score"]).first()
    assert summ["df_resid"] == m4.n - 7
    zp = z.orderBy("order_id", "review_score").toPandas()
    X = np.column_stack([np.ones(len(zp))] + [zp[c].to_numpy(float) for c in ST.ZSCORE_COLUMNS])
    e = zp.review_score.to_numpy(float) - X @ m4.params
    assert summ["durbin_watson"] == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e * e), rel=1e-9)
    assert summ["r2"] == pytest.approx(1 - e @ e / np.sum((zp.review_score - zp.review_score.mean()) ** 2), rel=1e-9)
    line = R.regression_line(z, "review_score", "delay_vs_expected").collect()
    assert len(line) == 100 and all(r["ci_low"] < r["fitted"] < r["ci_high"] for r in line)


def test_normality_statistics_behave():
    from mercato.functions.distributions import kurtosis_z, omnibus, skewness_z

    rng = np.random.default_rng(5)
    zs, zk = [], []
    for _ in range(400):
        x = rng.normal(size=300)
        c = x - x.mean()
        m2, m3, m4 = (c**2).mean(), (c**3).mean(), (c**4).mean()
        zs.append(skewness_z(m3 / m2**1.5, len(x)))
        zk.append(kurtosis_z(m4 / m2**2, len(x)))
    # under normal data both statistics are close to standard normal
    assert abs(np.mean(zs)) < 0.15 and abs(np.std(zs) - 1) < 0.12
    assert abs(np.mean(zk)) < 0.15 and abs(np.std(zk) - 1) < 0.15
    e = rng.exponential(size=2000)
    c = e - e.mean()
    k2, p = omnibus((c**3).mean() / (c**2).mean() ** 1.5, (c**4).mean() / (c**2).mean() ** 2, len(e))
    assert k2 > 100 and p < 1e-20


def test_data_range_skips_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert sorted((r["bin_lo"], r["count"]) for r in ST.histogram(df, "v", 2).collect()) == [(1.0, 1), (1.5, 1)]


def test_perfect_and_saturated_fits_have_a_summary(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(30)], "x double, y double")
    r = R.ols_summary(df, R.fit(df, "y", ["x"])).first()
    assert r["r2"] == pytest.approx(1.0) and r["n"] == 30
    two = df.where("x < 2")
    m = R.fit(two, "y", ["x"])
    assert m.df_resid == 0 and math.isnan(m.adj_r2) and math.isnan(m.fvalue)
    assert R.ols_summary(two, m).first()["df_resid"] == 0


def test_error_from_the_fit_equals_error_of_the_scores(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in rng.normal(size=(300, 2))], "x double, y double")
    m = R.fit(df, "y", ["x"])
    a, b = R.model_error(df, m).first(), R.ols_error(R.ols_score(df, m)).first()
    assert a["mse"] == pytest.approx(b["mse"], rel=1e-12) and a["residual_mean"] == pytest.approx(0, abs=1e-12)


def _exact_density(v, grid, bw):
    return np.exp(-0.5 * ((grid[:, None] - v[None]) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))


def test_binned_density_is_exact_within_its_bound(spark):
    rng = np.random.default_rng(8)
    # all values distinct; heavy tails and a far outlier, so some points are beyond every kernel
    groups = {"wide": rng.standard_cauchy(4000), "flat": rng.uniform(0, 1e6, 3000), "far": np.append(rng.normal(size=2000), 4000.0), "two": np.array([1.0, 2.0])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("one", 1.0), ("same", 3.0), ("same", 3.0), (None, 1.0), ("flat", None), ("flat", float("nan"))]
    got = ST.kde_curve(spark.createDataFrame(rows, "g string, v double"), "v", "g", grid_points=120).collect()
    assert {r["g"] for r in got} == set(groups) and len(got) == 120 * len(groups)
    for g, v in groups.items():
        own = sorted((r["point"], r["x"], r["density"]) for r in got if r["g"] == g)
        bw = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 120)
        assert [x for _, x, _ in own] == pytest.approx(list(grid), rel=1e-9, abs=1e-9)
        want = _exact_density(v, np.array([x for _, x, _ in own]), bw)
        bound = 1.1e-15 / (bw * math.sqrt(2 * math.pi)) + 1e-12 * want  # truncation; rounding
        assert (np.abs(np.array([d for *_, d in own]) - want) <= bound).all()


def test_bins_do_not_grow_with_the_values(spark):
    values = spark.range(60_000).selectExpr("'g' as g", "cast(pmod(id * 7919, 60013) as double) as v")
    sd, n = 17320.0, 60_000
    params = spark.createDataFrame([("g", n, 0.0, sd * n ** -0.2)], "g string, n long, lo double, bw double")
    bins = ST.kde_bins(values, params, "g")
    assert bins.count() <= 60_013 / (sd * n ** -0.2 / ST.KDE_BINS) + 2
    plan = bins._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_correlations_with_missing_values_match_pandas(spark):
    import pandas as pd

    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)) * [1, 1e-3, 1e4, 1] + [1e6, 0, -5, 0.1]
    x[:, 1] += 1e-9 * x[:, 0]
    x[:, 3] = 0.1
    pdf = pd.DataFrame(x, columns=list("abcd")).mask(rng.random((500, 4)) < 0.2)
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(pdf.to_numpy())]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)

    def want(a, b):
        both = pdf[[a, b]].dropna().to_numpy().astype(np.longdouble)
        z = both[:, [0, -1]] - both[:, [0, -1]].mean(0)
        return float((z[:, 0] @ z[:, 1]) / np.sqrt((z[:, 0] @ z[:, 0]) * (z[:, 1] @ z[:, 1])))

    for r in ST.correlation_matrix(df, list("abcd")).collect():
        if "d" in (r["x"], r["y"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want(r["x"], r["y"]), abs=1e-12)
    none = ST.correlation_matrix(df.where("false"), ["a", "b"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)


def test_an_ill_conditioned_design_is_solved_as_by_a_local_qr(spark):
    """Powers of numbers in a narrow range: the normal equations have a condition number beyond 1e13."""
    t = np.linspace(3, 4, 400)
    X = np.column_stack([t ** k for k in range(1, 6)])
    y = 1 + X @ [0.5, -1, 2, -0.25, 0.125] + 1e-3 * np.sin(37 * t)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(X, y)], "x1 double, x2 double, x3 double, x4 double, x5 double, y double").repartition(9)
    m = R.fit(df, "y", ["x1", "x2", "x3", "x4", "x5"])
    X1 = np.column_stack([np.ones(len(t)), X])
    z = (X - X.mean(0)) / X.std(0)
    assert np.linalg.cond(z) ** 2 > 1e13  # what a fit from covariances would have to solve with
    Q, r = np.linalg.qr(X1)
    beta = np.linalg.solve(r, Q.T @ y)
    assert m.rank == 6
    assert m.params == pytest.approx(beta, rel=1e-5)
    residual = y - X1 @ beta
    assert m.ssr == pytest.approx(residual @ residual, rel=1e-9)
    inv = np.linalg.inv(r)
    assert m.bse == pytest.approx(np.sqrt(np.diag(inv @ inv.T) * m.ssr / m.df_resid), rel=1e-5)


def test_a_large_mean_does_not_spoil_the_fit(spark):
    rng = np.random.default_rng(9)
    x = 1e9 + rng.normal(size=1000)
    y = 2.0 * (x - 1e9) + rng.normal(size=1000) * 0.1
    m = R.fit(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(11), "y", ["x"])
    z = x - 1e9
    b = ((z - z.mean()) @ y) / ((z - z.mean()) @ (z - z.mean()))
    assert m.params[1] == pytest.approx(b, rel=1e-9)


def test_states_merge_in_any_order():
    from mercato.plans.blocks import Moments, Range, Triangle

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) + [5, 0, -3]
    x[rng.random(x.shape) < 0.1] = np.nan
    cuts = np.split(x, [0, 7, 8, 120, 299])
    for kind in (Moments, Triangle, Range):
        whole = kind.of(x)
        for parts in (cuts, cuts[::-1]):
            got = kind.of(parts[0])
            for p in parts[1:]:
                got = got.merged(kind.of(p))
            if kind is Triangle:
                assert got.n == whole.n and got.means == pytest.approx(whole.means) and got.centred == pytest.approx(whole.centred, abs=1e-9)
            else:
                for a, b in zip(vars(got).values(), vars(whole).values()):
                    assert np.asarray(a) == pytest.approx(np.asarray(b))
