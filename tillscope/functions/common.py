"""Column helpers shared by the plans.

Numeric rules
-------------
* Money is summed as exact decimal and cast to double once, at the output.
* Averages are ``double(sum) / count``.
* Rounded ratios use exact integer arithmetic, half away from zero
  (:func:`round_ratio`), so the result does not depend on how an engine
  rounds an intermediate double or decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPLETED = "Completed"

# ISO weekday names, 1 = Monday .. 7 = Sunday.
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

_EXACT = "decimal(38,0)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def completed(orders: DataFrame, status_col: str = "order_status") -> DataFrame:
    """Orders whose status is 'Completed' (pushed into the parquet scan)."""
    return orders.where(F.col(status_col) == F.lit(COMPLETED))


def money(c) -> Column:
    """Exact decimal money → double, at the output edge only."""
    return col(c).cast("double")


def cents(c) -> Column:
    """Exact decimal money (scale ≤ 2) → integer cents as decimal(38,0)."""
    return (col(c) * F.lit(100)).cast(_EXACT)


def exact_int(c) -> Column:
    return col(c).cast(_EXACT)


def _idiv(a: Column, b: Column) -> Column:
    """Integer quotient of two non-negative integer-valued decimals, exact."""
    return ((a - a % b) / b).cast(_EXACT)


def round_ratio(num, den, digits: int = 2) -> Column:
    """round(num / den, digits), half away from zero, as double; NULL when den is 0 or NULL.

    ``num`` and ``den`` must be integer valued (cents, counts).  The value is
    ``sign · floor((2·|num·10^d| + |den|) / (2·|den|)) / 10^d`` in exact decimal(38,0).
    """
    n = exact_int(num) * F.lit(10 ** digits).cast(_EXACT)
    d = exact_int(den)
    q = _idiv(F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    sign = F.signum(n) * F.signum(d)
    safe = F.when(d != 0, q)
    return (safe.cast("double") * sign / F.lit(float(10 ** digits))).cast("double")


def avg_money(total, count) -> Column:
    """AVG of money as double: double(exact sum) / count."""
    return col(total).cast("double") / col(count)


def round_avg_money(total, count) -> Column:
    """ROUND(AVG(money), 2) computed exactly from the decimal sum and the count."""
    return round_ratio(cents(total), count, 0) / F.lit(100.0)


def month_start(d) -> Column:
    """First day of the month of a date (a DATE, not a timestamp)."""
    return F.trunc(col(d), "MM")


def year_month_label(year, month) -> Column:
    """'YYYY-MM' from integer year and month."""
    return F.format_string("%d-%02d", col(year), col(month))


def weekday_name(dow) -> Column:
    """ISO weekday number → English name (NULL outside 1..7)."""
    expr = None
    for i, name in enumerate(WEEKDAY_NAMES, start=1):
        expr = (F.when(col(dow) == i, F.lit(name)) if expr is None else expr.when(col(dow) == i, F.lit(name)))
    return expr


def months_between_starts(later, earlier) -> Column:
    """Whole months from one month start to another: 12·Δyear + Δmonth."""
    return ((F.year(col(later)) - F.year(col(earlier))) * 12
            + (F.month(col(later)) - F.month(col(earlier)))).cast("int")
