"""A regression line with a resampled confidence band, all replicates in one pass.

Each replicate gives every unit of resampling (the rows that share a key, say
all rows of an order) a weight drawn from a Poisson distribution with mean 1,
the limit of drawing units with replacement.  The draw is a hash of key,
replicate and seed: it needs no generator state, is the same wherever and
however often a task runs, and rows of one unit need not meet.  A replicate's
line follows from five weighted sums, which partial aggregation forms in the
tasks that read the rows; what is shuffled is one row for each task and
replicate, and neither it nor the band grows with the data.  Before that the
three columns read are dealt evenly, as the draws are the dear part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.regression import fit

REPLICATES = 1000
#: A draw is a hexadecimal piece of so many digits of a hash, and a hash has so many pieces.
DIGITS, PIECES = 4, 8


def poisson_cuts(mean: float = 1.0, digits: int = DIGITS) -> list[int]:
    """The integers c1 < c2 < ... below 16^digits such that a uniform one reaches k of them with the Poisson probability of k.

    What a draw of that many digits can't tell from certainty is left out.
    """
    space, cuts, below, term = 16**digits, [], 0.0, math.exp(-mean)
    k = 0
    while True:
        below += term
        cut = math.floor(space * below)
        if cut >= space or (cuts and cut == cuts[-1]):
            return cuts
        cuts.append(cut)
        k += 1
        term *= mean / k


def weighted(df: DataFrame, key: list[str], replicates: int, seed: int) -> DataFrame:
    """``df`` with a row for each replicate that draws the row (``replicate``), and how often (``weight``, at least 1)."""
    name = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    hashed = (df.withColumn("_name", name)
              .withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // PIECES))))
              .withColumn("_hash", F.md5(F.concat_ws("/", "_name", F.col("_group").cast("string")).cast("binary"))))
    drawn = hashed.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))).withColumn("replicate", F.col("_group") * PIECES + F.col("_piece"))
    draw = F.substring("_hash", F.col("_piece") * DIGITS + 1, F.lit(DIGITS))
    # pieces of equal length in lower case sort as their numbers do
    reached = [(draw >= F.lit(f"{c:0{DIGITS}x}")).cast("int") for c in poisson_cuts()]
    weight = sum(reached[1:], reached[0])
    return drawn.where(F.col("replicate") < replicates).withColumn("weight", weight).where(F.col("weight") > 0).drop("_name", "_group", "_hash", "_piece")


def replicate_lines(df: DataFrame, y: str, x: str, key: list[str], replicates: int = REPLICATES, seed: int = 0, centre: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """``replicate, n, slope, level``: the line of each replicate, ``y = level + slope * (x - centre[0])``.

    Rows in which either is null or NaN are not drawn.  A replicate in which x
    does not vary gets the level line through the mean of y; one that draws
    no row has no line and no row here.
    """
    dx, dy = F.col(x).cast("double") - F.lit(centre[0]), F.col(y).cast("double") - F.lit(centre[1])
    rows = df.select(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(key)], dx.alias("_x"), dy.alias("_y"))
    rows = rows.where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    # each row is worth hundreds here: a few input files must not mean a few tasks
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    w = F.col("weight")
    sums = (weighted(rows, [f"_key{k}" for k in range(len(key))], replicates, seed).groupBy("replicate")
            .agg(F.sum(w).alias("n"), F.sum(w * F.col("_x")).alias("sx"), F.sum(w * F.col("_y")).alias("sy"),
                 F.sum(w * F.col("_x") * F.col("_x")).alias("sxx"), F.sum(w * F.col("_x") * F.col("_y")).alias("sxy"), F.min("_x").alias("low"), F.max("_x").alias("high")))
    spread: Column = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    slope = F.when(F.col("low") < F.col("high"), (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / spread).otherwise(F.lit(0.0))
    lines = sums.withColumn("slope", slope)
    return lines.select("replicate", "n", "slope", (F.col("sy") / F.col("n") - F.col("slope") * F.col("sx") / F.col("n") + F.lit(centre[1])).alias("level"))


def regression_line_resampled(
    df: DataFrame, y: str, x: str, key: list[str], points: int = 100, level: float = 0.95, replicates: int = REPLICATES, seed: int = 0,
) -> DataFrame:
    """Fitted line of ``y`` on ``x`` over the data range of ``x`` with a percentile band: ``point, x, fitted, ci_low, ci_high``.

    Rows with equal ``key`` are drawn together; a null key is a key of its own
    (the empty text).  The band's ends are the percentiles of the replicates'
    lines at each point, linearly between two of them.  ``df`` is read twice:
    for the fit and the range of ``x``, and for all replicates.  Unlike the band
    of ``regression_line`` it assumes neither equal variances nor independent
    rows inside a unit.
    """
    if replicates < 2 or points < 1 or not 0 < level < 1 or not key:
        raise ValueError("at least 2 replicates, 1 point, a level between 0 and 1 and a key are needed")
    model = fit(df, y, [x], with_range=True)
    lo, hi = float(model.x_min[0]), float(model.x_max[0])
    a, b = (float(v) for v in model.params)
    middle = (lo + hi) / 2
    lines = replicate_lines(df, y, x, key, replicates, seed, (middle, a + b * middle))
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    at = F.col("point")
    gx = F.when(at == points - 1, F.lit(hi if points > 1 else lo)).otherwise(at.cast("double") * F.lit(step) + F.lit(lo))
    drawn = (lines.select("slope", "level", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")).withColumn("x", gx)
             .withColumn("line", F.col("level") + F.col("slope") * (F.col("x") - F.lit(middle))))
    tails = [(1.0 - level) / 2.0, 1.0 - (1.0 - level) / 2.0]
    band = drawn.groupBy("point", "x").agg(*[F.percentile("line", F.lit(q)).alias(c) for q, c in zip(tails, ("ci_low", "ci_high"))])
    return band.select("point", "x", (F.lit(a) + F.lit(b) * F.col("x")).alias("fitted"), "ci_low", "ci_high")
