"""Date parsing (P1, P2) and the policy year (P3) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried, in order, by the mixed parser (Python's
# "%d-%b-%y" first, then ISO, then month-first numeric forms as pandas reads
# "03-04-14" month first, then day-first ones for a first number above 12).
MIXED_FORMATS = ("d-MMM-yy", "d-MMM-yyyy", "yyyy-M-d", "yyyy/M/d", "M-d-yy", "M/d/yy",
                 "M-d-yyyy", "M/d/yyyy", "d-M-yy", "d/M/yy", "d-M-yyyy", "d/M/yyyy", "d MMM yyyy", "yyyyMMdd")
# A time of day after a date, which the date ignores.
TIME_OF_DAY = r"[T ]+\d{1,2}:\d{2}.*$"

# Python's %y maps 69-99 to 19xx and 00-68 to 20xx; Spark's "yy" maps all to 20xx.
TWO_DIGIT_PIVOT = 2069


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _fix_two_digit_year(d: Column) -> Column:
    return F.when(F.year(d) >= TWO_DIGIT_PIVOT, F.add_months(d, -1200)).otherwise(d)


def parse_policy_date(col, fmt: str = "d-MMM-yy") -> Column:
    """Strict parse; bad or missing -> NULL (never an error)."""
    d = F.try_to_date(_c(col), fmt)
    if "yyyy" not in fmt and "yy" in fmt:
        d = _fix_two_digit_year(d)
    return d


def parse_mixed_date(col, formats=MIXED_FORMATS) -> Column:
    """Each value by the first of ``formats`` that parses it; a time of day is cut off."""
    day = F.trim(F.regexp_replace(_c(col), TIME_OF_DAY, ""))
    return F.coalesce(*[parse_policy_date(day, f) for f in formats])


def format_policy_date(col) -> Column:
    """Render a date the way the reference's CSV holds it (``08-AUG-13``)."""
    return F.upper(F.date_format(_c(col), "dd-MMM-yy"))


def policy_year(col="INSR_BEGIN") -> Column:
    """Year of the start date."""
    return F.year(_c(col))
