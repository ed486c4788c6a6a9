"""Small numeric helpers shared by operators and the query registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Half-way offset of ``stable_round``: just above 1/2, so exact decimal ties (which averages of
# short decimals hit often) all round up and no ratio of small integers sits on the jump.
ROUND_OFFSET = 0.5000271828


def stable_round(x: Column, digits: int = 6) -> Column:
    """Round to ``digits`` decimals with a plain IEEE expression, floor(x·10^d + h)/10^d.

    Two engines that sum in different orders differ in the last ulp; ``round()`` then flips at
    exact ties like 0.1576375. Moving the jump off the ties makes both engines agree.
    """
    scale = float(10 ** digits)
    return F.floor(x * F.lit(scale) + F.lit(ROUND_OFFSET)) / F.lit(scale)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column with ``stable_round`` for engine-independent comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(stable_round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def clamp(x: Column, lo: float | Column, hi: float | Column) -> Column:
    lo = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.least(F.greatest(x, lo), hi)
