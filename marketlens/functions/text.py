"""String column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _col
from .once import with_value

_PLAIN_CELL = r"\A[\p{L}\p{N}.#:/_￥¥-]*\z"
_BLANKS = " \t\r\n\u3000\u00a0"


def strip(c: Column | str) -> Column:
    """Trim blanks of every common kind on both ends."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def region_head(c: Column | str) -> Column:
    """First segment of a 'province > city > county' path, trimmed."""
    return strip(F.substring_index(_col(c), ">", 1))


def normalize_text(c: Column | str) -> Column:
    """One-line cell text: no quotes or control characters, single blanks, full-width commas."""
    def clean(x: Column) -> Column:
        y = F.regexp_replace(x, "[\"']", "")
        y = F.regexp_replace(y, r"[\n\r\t]|\\n|\\r", " ")
        y = F.regexp_replace(y, r"[\x00-\x1F\x7F-\x{9F}]", "")
        y = F.regexp_replace(y, r"(?U)\s+", " ")
        y = F.replace(strip(y), F.lit(","), F.lit("，"))
        # Short clean values, the bulk of table cells, skip the four rewrites.
        return F.when(x.rlike(_PLAIN_CELL), x).otherwise(y)

    return with_value(_col(c), clean)


def contains_any(pattern: str, *cols: Column | str) -> Column:
    """True where any of the columns matches the regular expression; NULL counts as no match."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(_col(c).rlike(pattern), F.lit(False))
    return hit
