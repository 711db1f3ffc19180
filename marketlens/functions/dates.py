"""Date column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _col

# Year, month and day parted by '-', '/' or '.', by the Chinese signs, or
# compact; then optionally a time of day with fraction and zone. The whole shape
# is rewritten first, so no row pays for a failed parse.
_DATE_SHAPE = (
    r"(?U)^\s*([0-9]{4})(?:([-/.])([0-9]{1,2})\2([0-9]{1,2})|年([0-9]{1,2})月([0-9]{1,2})日?|([0-9]{2})([0-9]{2}))"
    r"(?:(?:[Tt]|\s+)(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]+)?)?\s*(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})?)?\s*$"
)


# Days that need no more than their separators changed.
_PLAIN_DAY = r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}\z"


def parse_date(c: Column | str) -> Column:
    """Text in one of the accepted date shapes to DATE; everything else is NULL."""
    text = _col(c)
    plain = F.regexp_replace(text, _DATE_SHAPE, "$1-$3$5$7-$4$6$8")
    other = F.regexp_extract(plain, "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", 0)
    return F.when(text.rlike(_PLAIN_DAY), F.replace(text, F.lit("/"), F.lit("-"))).otherwise(other).try_cast("date")


def between_dates(c: Column | str, date_from: str | None, date_to: str | None) -> Column:
    """Inclusive range test; an open end is not tested."""
    x, test = _col(c), F.lit(True)
    if date_from:
        test = test & (x >= F.lit(date_from).cast("date"))
    if date_to:
        test = test & (x <= F.lit(date_to).cast("date"))
    return test


def year_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")
