"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a title keeps in lower case.
STOP_WORDS = ["and", "or", "but", "the", "a", "an", "in", "on", "at", "to"]


def title_case(c: Column) -> Column:
    """Title case word by word; stop words stay lower, also at the start."""

    def word(w: Column) -> Column:
        low = F.lower(w)
        capital = F.concat(F.upper(F.substring(w, 1, 1)), F.substring(low, 2, 2**31 - 1))
        return F.when(low.isin(STOP_WORDS), low).otherwise(capital)

    return F.array_join(F.transform(F.split(c, " "), word), " ")


def format_size(c: Column) -> Column:
    """Bytes as ``B``, ``KB``, ``MB`` or ``GB``, at most two decimals."""

    def scaled(power: int, unit: str) -> Column:
        rounded = F.round(c / F.lit(float(1024**power)), 2).cast("decimal(24,2)").cast("string")
        return F.concat(F.regexp_replace(rounded, r"\.?0+$", ""), F.lit(unit))

    return (
        F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B")))
        .when(c < 1024**2, scaled(1, " KB"))
        .when(c < 1024**3, scaled(2, " MB"))
        .otherwise(scaled(3, " GB"))
    )


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; NULL (not ``''``) where nothing matches."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def first_of(array: Column) -> Column:
    """First element; NULL for an empty or NULL array."""
    return F.get(array, F.lit(0))


def category_path(*parts: Column) -> Column:
    """``a - b - c``; missing lower levels are left out, a missing top gives NULL."""
    top, *rest = parts
    return F.concat(
        top, *[F.coalesce(F.concat(F.lit(" - "), p), F.lit("")) for p in rest]
    )
