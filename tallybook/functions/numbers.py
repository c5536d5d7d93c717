"""Money and change expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(c: Column) -> Column:
    """Sum of ten decimal places, so the result does not depend on the order of addition.

    No value is cut to cents first; reports round what they show, once.
    """
    return F.sum(c.cast("decimal(38,10)")).cast("double")


def round2(c: Column) -> Column:
    return F.round(c, 2)


def pct_change_sql(new: str, old: str) -> str:
    """Change against ``|old|`` in percent; NULL where ``old`` is zero or NULL."""
    return f"try_divide({new} - {old}, abs({old})) * 100D"
