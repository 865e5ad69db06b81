"""Means and deviations, optionally in fixed point.

Adding doubles in a different order gives different last bits, so a plain mean
changes with partitioning and task retries. With ``digits`` set, values are
summed as whole units of ``10**-digits``: the result no longer depends on the
order in which a cluster happens to merge its partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def units(value: str | Column, digits: int) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column * F.lit(10**digits)).cast("bigint")


def _over(aggregate: Column, window: WindowSpec | None) -> Column:
    return aggregate if window is None else aggregate.over(window)


def mean(value: str | Column, digits: int | None = None, over: WindowSpec | None = None) -> Column:
    if digits is None:
        return _over(F.avg(value), over)
    total = _over(F.sum(units(value, digits)), over)
    return total / _over(F.count(value), over) / F.lit(10**digits)


def sample_stddev(
    value: str | Column, digits: int | None = None, over: WindowSpec | None = None
) -> Column:
    if digits is None:
        return _over(F.stddev_samp(value), over)
    unit = units(value, digits)
    n = _over(F.count(value), over)
    total = _over(F.sum(unit), over)
    squares = _over(F.sum(unit * unit), over)
    return F.when(
        n > 1,
        F.sqrt((n * squares - total * total).cast("double") / (n * (n - 1))) / F.lit(10**digits),
    )


def running(
    name: str, digits: int | None, window: WindowSpec, squares: bool = False
) -> dict[str, Column]:
    """Running count and sums of a column, the first stage of trailing statistics.

    A sliding frame of k rows is added up again for every row. In fixed point the
    frame is the difference of two running sums instead, which is exact and costs
    the same for a day as for a week. Doubles would lose digits in that difference,
    so without ``digits`` there is no first stage.
    """
    if digits is None:
        return {}
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    unit = units(name, digits)
    out = {
        f"_n_{name}": F.count(name).over(so_far),
        f"_s_{name}": F.coalesce(F.sum(unit).over(so_far), F.lit(0)),
    }
    if squares:
        out[f"_q_{name}"] = F.coalesce(F.sum(unit * unit).over(so_far), F.lit(0))
    return out


def _frame(part: str, rows: int, window: WindowSpec) -> Column:
    """Value of a running column over the current and the ``rows`` rows before it."""
    return F.col(part) - F.lag(part, rows + 1, 0).over(window)


def trailing_mean(name: str, digits: int | None, rows: int, window: WindowSpec) -> Column:
    """Mean of the current and the ``rows`` rows before it; needs ``running`` columns."""
    if digits is None:
        return F.avg(name).over(window.rowsBetween(-rows, 0))
    n = F.nullif(_frame(f"_n_{name}", rows, window), F.lit(0))
    return _frame(f"_s_{name}", rows, window) / n / F.lit(10**digits)


def trailing_stddev(name: str, digits: int | None, rows: int, window: WindowSpec) -> Column:
    """Sample deviation over the same frame; ``running`` must have kept squares."""
    if digits is None:
        return F.stddev_samp(name).over(window.rowsBetween(-rows, 0))
    n = _frame(f"_n_{name}", rows, window)
    total = _frame(f"_s_{name}", rows, window)
    squares = _frame(f"_q_{name}", rows, window)
    return F.when(
        n > 1,
        F.sqrt((n * squares - total * total).cast("double") / (n * (n - 1))) / F.lit(10**digits),
    )
