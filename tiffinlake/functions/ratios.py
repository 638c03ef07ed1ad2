from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as a double, 0 where the denominator is 0 or null."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    quotient = F.try_divide(num.cast("double"), den.cast("double"))
    return F.when(den > 0, F.coalesce(quotient, F.lit(0.0))).otherwise(0.0)
