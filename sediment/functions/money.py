"""Money and typed-value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.schemas import TOTAL


def signed_amount(amount: Column, indicator: Column) -> Column:
    """Debits count up, credits count down, anything else has no sign and so no amount."""
    return F.when(indicator == "DR", amount).when(indicator == "CR", -amount)


def strict(raw: Column, kind: T.DataType, label: str) -> Column:
    """Parse text as ``kind``; raise instead of losing or inventing anything.

    Dates must be ``yyyy-MM-dd``. Decimals must fit without rounding: Spark's own cast would
    turn 1.23456 into 1.2346 silently. Works the same with ANSI mode on or off.
    """
    if isinstance(kind, T.StringType):
        return raw
    if isinstance(kind, T.DateType):
        parsed = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw.try_cast("date"))
        bad = parsed.isNull()
    elif isinstance(kind, T.DecimalType):
        parsed = raw.try_cast(kind)
        exact = raw.try_cast(T.DecimalType(38, 18))
        bad = parsed.isNull() | exact.isNull() | (parsed != exact)
    else:
        parsed = raw.try_cast(kind)
        bad = parsed.isNull()
    message = F.concat(F.lit(f"{label}: not a valid {kind.simpleString()}: '"), raw, F.lit("'"))
    return F.when(raw.isNotNull() & bad, F.raise_error(message).cast(kind)).otherwise(parsed)


def as_total(column: Column) -> Column:
    """The type of stored sums: wide enough that no number of rows can overflow it."""
    return column.cast(TOTAL)
