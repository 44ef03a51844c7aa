"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_of(c)
    return F.when(~F.isnan(c.cast("double")), c)


def try_double(c) -> Column:
    """Unparsable -> NULL; NaN -> NULL (NaN is a value in Spark, not missing)."""
    return nan_to_null(col_of(c).try_cast("double"))


def np_round(c, digits: int) -> Column:
    """numpy-style round (scale, half to even) as ``rint(x * 10^d) / 10^d``."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def clip(c, lower, upper) -> Column:
    """pandas clip: missing (NULL or NaN) stays NULL (least/greatest alone would skip nulls)."""
    c = nan_to_null(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(upper)), F.lit(lower)))


def stable6(c) -> Column:
    """Round to 1e-6 with the same arithmetic on both engines (oracle compare)."""
    return np_round(c, 6)
