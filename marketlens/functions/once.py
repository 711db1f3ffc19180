"""Evaluate costly column expressions exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Select ``keep`` and the given columns as the output of a one-row generator.

    A filter on a projected column is rewritten into the column's expression,
    so parsing or text functions would run again for the filter. Filters on
    generated columns are not.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it.

    Conditions that name a costly expression in their test and their branches
    run it again for each; a lambda's argument is bound to its result.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
