"""Order-independent money sums.

Double sums depend on the order rows arrive in, so two runs (or Spark and a
SQL oracle) can disagree in the last bits and, after rounding to cents, in the
printed value. Summing in DECIMAL is associative; twelve decimal places keep
what a double amount times a rate of a few digits holds, later digits are
rounded. Values that do not fit DECIMAL(30,12) (NaN, infinities, |x| >= 1e18)
are summed as doubles on the side and added back, so NaN still propagates as
it would in a double sum.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(30,12)"


def exact_sum(c, scale: int | None = None) -> Column:
    """sum(c) as DOUBLE, independent of the order; rounded HALF_UP to ``scale`` if given."""
    x = F.col(c) if isinstance(c, str) else c
    dec = x.try_cast(MONEY_DECIMAL)
    return total_of(F.sum(dec), F.sum(F.when(dec.isNull() & x.isNotNull(), x)), scale)


def total_of(total: Column, overflow: Column, scale: int | None = None) -> Column:
    """DOUBLE total of a DECIMAL sum and a double sum of the values that did not fit it."""
    rounded = total if scale is None else F.round(total, scale)
    both = F.coalesce(total.cast("double"), F.lit(0.0)) + overflow
    both = both if scale is None else F.when(F.isnan(both) | F.abs(both).isin(float("inf")), both).otherwise(F.round(both, scale))
    return F.when(overflow.isNull(), rounded.cast("double")).otherwise(both)
