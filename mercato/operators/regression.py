"""Ordinary least squares with an intercept, fitted from one aggregation pass.

The data never leaves the executors: one pass returns the triangular factor
of the design and ``y`` (a tree of QR factorisations, ``blocks.Triangle``), and
a (k+1)x(k+1) problem is solved on the driver.  No normal equations are formed,
so regressors that are nearly multiples of each other are told apart down to
``RCOND`` and not only to its root.  Scoring is a plain projection with the
coefficients as literals.

Rank-deficient designs (for example two identical regressors) get the
minimum-norm solution of the pseudo-inverse and rank-based degrees of
freedom, as a pseudo-inverse least-squares fit reports them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.distributions import chi2_sf_2df, f_sf, omnibus, t_quantile, t_two_sided_p
from mercato.plans.blocks import Moments, Range, Triangle, block_states
from mercato.plans.ranking import ranked_prefix_sums

INTERCEPT = "Intercept"
#: Directions of the scaled design that are shorter than this share of the longest count as none.
RCOND = 1e-11


@dataclass
class OlsModel:
    y: str
    xs: list[str]
    n: int
    params: np.ndarray
    cov_params: np.ndarray
    rank: int
    ssr: float
    centered_tss: float
    x_means: np.ndarray = field(repr=False)
    alpha: float = 0.05
    # regressors enter as (x - shift) / scale; identity unless fitted on z-scores
    x_shift: np.ndarray | None = field(default=None, repr=False)
    x_scale: np.ndarray | None = field(default=None, repr=False)
    # raw range of each regressor over the fitted rows
    x_min: np.ndarray | None = field(default=None, repr=False)
    x_max: np.ndarray | None = field(default=None, repr=False)
    residual_mean: float = 0.0

    @property
    def names(self) -> list[str]:
        return [INTERCEPT] + list(self.xs)

    @property
    def df_model(self) -> int:
        return self.rank - 1

    @property
    def df_resid(self) -> int:
        return self.n - self.rank

    @property
    def bse(self) -> np.ndarray:
        return np.sqrt(np.clip(np.diag(self.cov_params), 0.0, None))

    @property
    def tvalues(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.params / self.bse

    @property
    def pvalues(self) -> np.ndarray:
        return np.array([t_two_sided_p(float(t), self.df_resid) for t in self.tvalues])

    def conf_int(self) -> tuple[np.ndarray, np.ndarray]:
        q = t_quantile(1.0 - self.alpha / 2.0, self.df_resid)
        return self.params - q * self.bse, self.params + q * self.bse

    @property
    def r2(self) -> float:
        return 1.0 - self.ssr / self.centered_tss if self.centered_tss > 0 else float("nan")

    @property
    def adj_r2(self) -> float:
        return 1.0 - (self.n - 1) / self.df_resid * (1.0 - self.r2) if self.df_resid > 0 else float("nan")

    @property
    def fvalue(self) -> float:
        if self.df_model <= 0 or self.df_resid <= 0:
            return float("nan")
        if self.ssr <= 0:  # a perfect fit; nothing to fit at all if there is no spread either
            return float("inf") if self.centered_tss > 0 else float("nan")
        return ((self.centered_tss - self.ssr) / self.df_model) / (self.ssr / self.df_resid)

    @property
    def llf(self) -> float:
        n = self.n
        if self.ssr <= 0:
            return float("inf")
        return -n / 2.0 * math.log(2.0 * math.pi) - n / 2.0 * math.log(self.ssr / n) - n / 2.0

    def regressor(self, j: int) -> Column:
        x = F.col(self.xs[j]).cast("double")
        if self.x_shift is None or (self.x_shift[j] == 0.0 and self.x_scale[j] == 1.0):
            return x
        return (x - F.lit(float(self.x_shift[j]))) / F.lit(float(self.x_scale[j]))

    def prediction(self) -> Column:
        """``Intercept + sum(coef * x)`` as a column expression."""
        out = F.lit(float(self.params[0]))
        for j, b in enumerate(self.params[1:]):
            out = out + F.lit(float(b)) * self.regressor(j)
        return out


def _clean(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = None
    for c in cols:
        x = F.col(c).cast("double")
        ok = x.isNotNull() & ~F.isnan(x)
        cond = ok if cond is None else cond & ok
    return df.where(cond)


def fit(
    df: DataFrame,
    y: str,
    xs: list[str],
    rcond: float = RCOND,
    alpha: float = 0.05,
    standardize: list[str] | None = None,
    with_range: bool = False,
) -> OlsModel:
    """Fit ``y ~ 1 + xs`` on the rows where ``y`` and every ``x`` are present.

    ``standardize`` names regressors that enter as z-scores (population std,
    statistics over all rows, as ``stats.zscore`` computes them).  Z-scoring
    is affine, so the factor of the z-scores follows from the raw one and the
    fit still takes one pass.  A standardised column that has missing
    values (its z-scores would all be missing) or no spread cannot be fitted.
    ``with_range`` also takes the range of each regressor in the same pass.
    """
    k = len(xs)
    cols = list(xs) + [y]
    std = [x for x in xs if x in set(standardize or [])]
    design, own = list(range(k + 1)), [xs.index(x) for x in std]
    kinds = [(Triangle, design)] + ([(Moments, own)] if std else []) + ([(Range, design)] if with_range else [])
    states = block_states(df, cols, kinds)
    factor = states[0]
    n = factor.n
    if n == 0:
        raise ValueError("no complete rows to fit")
    means, C = factor.means, factor.centred
    shift, scale_x = np.zeros(k), np.ones(k)
    for i, x in enumerate(std):
        m = states[1]
        sd = math.sqrt(max(m.square[i, i], 0.0) / m.n[i, i]) if m.n[i, i] else 0.0
        if m.n[i, i] < m.rows or not sd:
            raise ValueError(f"z-scores of {x} are all missing (missing values or no spread)")
        shift[own[i]], scale_x[own[i]] = m.mean[i, i], sd
    # the factor of (x - shift) / scale from that of x: columns by their scale
    mux, muy = (means[:k] - shift) / scale_x, means[k]
    Cx, cy, rest = C[:k, :k] / scale_x, C[:k, k], C[k, k]

    # Rank from the centred, scaled design (well conditioned): [1, (x - mean) / sd].
    norm = np.sqrt((Cx * Cx).sum(0))
    scale = np.where(norm > 0, norm, 1.0)
    U, S, Vt = np.linalg.svd(Cx / scale) if k else (np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    rank = 1 + int(np.sum(S > rcond * max(1.0, float(S.max(initial=0.0)))))

    if rank == k + 1:
        # unique solution: solve in the scaled basis, map back
        half = (Vt.T / S) / scale[:, None]
        b = half @ (U.T @ cy)
        a = muy - mux @ b
        inner = half @ half.T
        XtX_inv = np.empty((k + 1, k + 1))
        XtX_inv[0, 0] = 1.0 / n + mux @ inner @ mux
        XtX_inv[0, 1:] = XtX_inv[1:, 0] = -(inner @ mux)
        XtX_inv[1:, 1:] = inner
        beta = np.concatenate([[a], b])
    else:
        # minimum-norm solution in the original basis, with as many directions as the rank
        A = np.zeros((k + 1, k + 1))
        A[0, 0], A[0, 1:], A[1:, 1:] = math.sqrt(n), math.sqrt(n) * mux, Cx
        U, S, Vt = np.linalg.svd(A)
        half = Vt[:rank].T / S[:rank]
        beta = half @ (U[:, :rank].T @ np.concatenate([[math.sqrt(n) * muy], cy]))
        XtX_inv = half @ half.T
        a, b = beta[0], beta[1:]

    resid_mean = float(muy - a - mux @ b)
    ssr = float(rest * rest + np.sum((cy - Cx @ b) ** 2) + n * resid_mean * resid_mean)
    centered_tss = float(cy @ cy + rest * rest)
    if ssr <= (1e-13 * math.sqrt(n)) ** 2 * centered_tss:
        ssr = 0.0  # nothing but rounding is left
    df_resid = n - rank
    sigma2 = ssr / df_resid if df_resid > 0 else float("nan")
    x_min, x_max = (states[-1].lo[:k], states[-1].hi[:k]) if with_range else (None, None)
    return OlsModel(y, list(xs), n, beta, sigma2 * XtX_inv, rank, ssr, centered_tss, mux, alpha,
                    shift if std else None, scale_x if std else None, x_min, x_max, resid_mean)


def _rows_df(df: DataFrame, rows: list[tuple], schema: T.StructType) -> DataFrame:
    clean = [tuple(None if isinstance(v, float) and not math.isfinite(v) else v for v in r) for r in rows]
    return df.sparkSession.createDataFrame(clean, schema)


COEF_SCHEMA = T.StructType(
    [T.StructField("variable", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("coef", "std_err", "t_value", "p_value", "ci_low", "ci_high")]
)


def coefficient_table(df: DataFrame, model: OlsModel) -> DataFrame:
    """``variable, coef, std_err, t_value, p_value, ci_low, ci_high``."""
    lo, hi = model.conf_int()
    rows = [
        (name, float(c), float(s), float(t), float(p), float(l), float(h))
        for name, c, s, t, p, l, h in zip(
            model.names, model.params, model.bse, model.tvalues, model.pvalues, lo, hi
        )
    ]
    return _rows_df(df, rows, COEF_SCHEMA)


def ols_fit(df: DataFrame, y: str, xs: list[str], rcond: float = RCOND) -> DataFrame:
    """Fit and return the coefficient table."""
    return coefficient_table(df, fit(df, y, xs, rcond))


def ols_coefficients(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """``variable, coef, std_err, t_value``: the estimates without the tail probabilities."""
    return ols_fit(df, y, xs).select("variable", "coef", "std_err", "t_value")


def ols_significant(coefs: DataFrame, level: float = 0.05) -> DataFrame:
    """Coefficients with ``p_value < level``, largest coefficient first."""
    return coefs.where(F.col("p_value") < level).select("variable", "p_value", "coef").orderBy(F.desc("coef"))


def ols_importance(coefs: DataFrame) -> DataFrame:
    """``variable, importance``: absolute coefficient (meaningful on standardised regressors)."""
    return coefs.select("variable", F.abs("coef").alias("importance"))


def ols_score(df: DataFrame, model: OlsModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``y``, ``predicted`` and ``residual`` for the rows the model can score."""
    keep = [c for c in (keep or []) if c != model.y]
    data = _clean(df, [model.y] + model.xs)
    pred = model.prediction()
    return data.select(
        *keep,
        F.col(model.y).cast("double").alias(model.y),
        pred.alias("predicted"),
        (F.col(model.y).cast("double") - pred).alias("residual"),
    )


def ols_error(scored: DataFrame) -> DataFrame:
    """``residual_mean, mse, rmse`` (MSE is the plain mean of squared residuals)."""
    r = F.col("residual")
    return scored.agg(F.avg(r).alias("residual_mean"), F.avg(r * r).alias("mse")).withColumn(
        "rmse", F.sqrt("mse")
    )


def model_error(df: DataFrame, model: OlsModel) -> DataFrame:
    """``ols_error`` of a model over the rows it was fitted on, from the fit's own moments: no further pass."""
    mse = model.ssr / model.n
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("residual_mean", "mse", "rmse")])
    return _rows_df(df, [(float(model.residual_mean), float(mse), math.sqrt(mse))], schema)


SUMMARY_COLUMNS = [
    ("n", T.LongType()), ("df_model", T.LongType()), ("df_resid", T.LongType()), ("r2", T.DoubleType()),
    ("adj_r2", T.DoubleType()), ("f_stat", T.DoubleType()), ("prob_f", T.DoubleType()),
    ("log_likelihood", T.DoubleType()), ("aic", T.DoubleType()), ("bic", T.DoubleType()),
    ("skew", T.DoubleType()), ("kurtosis", T.DoubleType()), ("jarque_bera", T.DoubleType()),
    ("prob_jb", T.DoubleType()), ("omnibus", T.DoubleType()), ("prob_omnibus", T.DoubleType()),
    ("durbin_watson", T.DoubleType()),
]


def durbin_watson(scored: DataFrame, order_by: list[str]) -> float | None:
    """sum((e_t - e_(t-1))^2) / sum(e_t^2) with rows ordered by ``order_by``.

    Rows are ranked without a single-task window (``ranked_prefix_sums``),
    which also hands each row the residual of the one before.  Rows tied on
    ``order_by`` should have equal residuals for a defined answer.
    """
    ranked, _ = ranked_prefix_sums(scored.select(*order_by, "residual"), order_by, [], lag_cols=["residual"])
    d = F.col("residual") - F.col("previous_residual")
    row = ranked.agg(F.sum(d * d).alias("num"), F.sum(F.col("residual") * F.col("residual")).alias("den")).first()
    if row["den"] is None or row["den"] == 0:
        return None
    return float(row["num"] or 0.0) / float(row["den"])


def ols_summary(df: DataFrame, model: OlsModel, order_by: list[str] | None = None) -> DataFrame:
    """One row of model statistics; residual shape from one pass over the scored rows.

    ``durbin_watson`` needs a row order and is computed only when ``order_by`` is given.
    """
    r = F.col("residual")
    m = ols_score(df, model).agg(
        F.avg(r).alias("m1"), F.avg(r * r).alias("r2"), F.avg(r * r * r).alias("r3"), F.avg(r * r * r * r).alias("r4")
    ).first()
    m1 = m["m1"]
    c2 = m["r2"] - m1 * m1
    c3 = m["r3"] - 3 * m1 * m["r2"] + 2 * m1**3
    c4 = m["r4"] - 4 * m1 * m["r3"] + 6 * m1 * m1 * m["r2"] - 3 * m1**4
    skew = c3 / c2**1.5 if c2 > 0 else float("nan")
    kurt = c4 / (c2 * c2) if c2 > 0 else float("nan")
    jb = model.n / 6.0 * (skew * skew + (kurt - 3.0) ** 2 / 4.0)
    k_params = model.df_model + 1
    llf = model.llf
    row = (
        model.n, model.df_model, model.df_resid, model.r2, model.adj_r2, model.fvalue,
        f_sf(model.fvalue, model.df_model, model.df_resid), llf, -2.0 * llf + 2.0 * k_params,
        -2.0 * llf + math.log(model.n) * k_params, skew, kurt, jb, chi2_sf_2df(jb),
        *omnibus(skew, kurt, model.n),
        durbin_watson(ols_score(df, model, keep=order_by), order_by) if order_by else None,
    )
    schema = T.StructType([T.StructField(n, t) for n, t in SUMMARY_COLUMNS])
    return _rows_df(df, [tuple(float(v) if isinstance(v, (float, np.floating)) else v for v in row)], schema)


def regression_line(df: DataFrame, y: str, x: str, points: int = 100, level: float = 0.95) -> DataFrame:
    """Fitted line of ``y`` on ``x`` over the data range of ``x`` with a
    confidence band for the mean: ``point, x, fitted, ci_low, ci_high``."""
    model = fit(df, y, [x], alpha=1.0 - level, with_range=True)  # one pass: moments and the range of x
    lo, hi = float(model.x_min[0]), float(model.x_max[0])
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    a, b = (float(v) for v in model.params)
    V = model.cov_params
    q = t_quantile(1.0 - (1.0 - level) / 2.0, model.df_resid)
    i = F.col("id")
    gx = F.when(i == points - 1, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))
    se = F.sqrt(F.lit(float(V[0, 0])) + F.lit(2.0 * float(V[0, 1])) * F.col("x") + F.lit(float(V[1, 1])) * F.col("x") * F.col("x"))
    return (
        df.sparkSession.range(points)
        .select(i.cast("int").alias("point"), gx.alias("x"))
        .withColumn("fitted", F.lit(a) + F.lit(b) * F.col("x"))
        .withColumn("ci_low", F.col("fitted") - F.lit(q) * se)
        .withColumn("ci_high", F.col("fitted") + F.lit(q) * se)
    )
