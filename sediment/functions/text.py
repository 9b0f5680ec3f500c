"""String helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: blank means only Unicode space separators, so a no-break space is blank and a tab
# or a line end is not.
BLANK = r"\A\p{Zs}*\z"


def missing_sql(text: list[str], other: list[str]) -> str:
    """SQL condition: a text column is null, empty or blank, or another column is null."""
    blank = [f"{name} IS NULL OR {name} RLIKE r'{BLANK}'" for name in text]
    return " OR ".join(blank + [f"{name} IS NULL" for name in other])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def empty_to_null(column: Column) -> Column:
    return F.when(column != "", column)
