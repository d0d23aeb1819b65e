"""Output convention shared by the Spark queries and their DuckDB oracles.

Doubles summed in a different order differ in the last bits.  Both sides
therefore snap every finite double to a binary grid whose step follows its
magnitude: 26 significant bits (1.5e-8 relative), but no finer than
``2**LEAST`` (1.5e-11), below which what is left of a cancelled sum is noise.
The step is a power of two, so the same operations give the same bits in both
engines.  Null, NaN and the infinities stay what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, LEAST = 26, -36


def snap(c: Column) -> Column:
    x = c.cast("double")
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.abs(x))) - BITS, F.lit(LEAST)).cast("double"))
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))) & (x != 0)
    return F.when(finite, F.rint(x / step) * step + F.lit(0.0)).when(x == 0, F.lit(0.0)).otherwise(x)


def snap_sql(c: str) -> str:
    x = f"cast({c} as double)"
    step = f"pow(2.0::double, greatest(floor(log2(abs({x}))) - {BITS}, {LEAST})::double)"
    return f"case when {x} = 0 then 0.0::double when isfinite({x}) then round_even({x} / {step}, 0) * {step} + 0.0::double else {x} end"


def canonical(df: DataFrame) -> DataFrame:
    return df.select(*[
        snap(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def canonical_sql(core: str, doubles: list[str]) -> str:
    """Wrap a DuckDB query so that the listed double columns get the same snapping."""
    if not doubles:
        return core
    repl = ", ".join(f"{snap_sql(c)} as {c}" for c in doubles)
    return f"select * replace ({repl}) from ({core}) canon_t"
