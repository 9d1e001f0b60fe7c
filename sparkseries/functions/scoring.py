"""Forecast error measures as aggregate expressions.

Each takes the actual and the predicted column and gives one aggregate column, to be used in
any groupBy. Ratios with a data-dependent divisor never fail on zero actuals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: floor of |y| in MAPE, the spacing of doubles at 1.
MAPE_FLOOR = 2.220446049250313e-16


def paired(y: Column, yhat: Column, value: Column) -> Column:
    """`value` where both sides are present, so every measure uses the same rows."""
    return F.when(y.isNotNull() & yhat.isNotNull(), value)


def mse(y: Column, yhat: Column) -> Column:
    return F.avg((y - yhat) * (y - yhat))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(mse(y, yhat))


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def floored_percentage(y: Column, yhat: Column) -> Column:
    """Row-wise |e| over |y|, with a floor for |y|."""
    return F.abs(y - yhat) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))


def mape(y: Column, yhat: Column) -> Column:
    """Mean absolute percentage error as a fraction."""
    return F.avg(floored_percentage(y, yhat))


def smape(y: Column, yhat: Column, percent: bool = False) -> Column:
    """Symmetric error against the mean magnitude of both sides; 0 where both are 0."""
    ratio = F.try_divide(F.abs(y - yhat), (F.abs(y) + F.abs(yhat)) / 2)
    both_zero = (y == 0) & (yhat == 0)
    return F.avg(F.when(both_zero, 0.0).otherwise(ratio)) * (100.0 if percent else 1.0)


def wape(y: Column, yhat: Column) -> Column:
    return F.try_divide(
        F.sum(F.abs(y - yhat)), F.sum(paired(y, yhat, F.abs(y)))
    )


def absolute_percentage(y: Column, yhat: Column) -> Column:
    """Row-wise |e/y|; null where the actual is 0. MdAPE is its median."""
    return F.abs(F.try_divide(y - yhat, y))


def coverage(y: Column, lower: Column, upper: Column) -> Column:
    """Share of actuals inside the interval."""
    return F.avg(((y >= lower) & (y <= upper)).cast("double"))


def r2(y: Column, yhat: Column) -> Column:
    """1 - SSE/SST; null where the actuals do not vary."""
    n = F.count(paired(y, yhat, y))
    return 1 - F.try_divide(F.sum((y - yhat) * (y - yhat)), F.var_pop(paired(y, yhat, y)) * n)


def mean_error(y: Column, yhat: Column) -> Column:
    return F.avg(y - yhat)


def max_error(y: Column, yhat: Column) -> Column:
    return F.max(F.abs(y - yhat))
