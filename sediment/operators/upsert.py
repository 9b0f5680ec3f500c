"""Latest-record upsert of the account dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.functions.dates import file_date
from sediment.schemas import SILVER_ACCOUNTS


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` per ``key``.

    An aggregate rather than a window, so each map task keeps one row per key before the shuffle.
    """
    rest = [c for c in rows.columns if c not in (key, order)]
    return (
        rows.groupBy(key)
        .agg(F.max(F.struct(order, *rest)).alias("latest"))
        .select(key, "latest.*")
        .select(*rows.columns)
    )


def retained(stored: DataFrame, accepted_deltas: DataFrame) -> DataFrame:
    """Stored accounts without a new record."""
    return stored.join(accepted_deltas.select("account_id").distinct(), "account_id", "left_anti")


def upsert_accounts(promoted_deltas: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Merge promoted deltas into the stored accounts: the latest day's record wins.

    A stored record's day is the day of the file it came from, so filling in an older day
    later does not bring back an older balance.
    """
    columns = SILVER_ACCOUNTS.fieldNames()
    rows = promoted_deltas.select(*columns, "date")
    if stored is not None:
        older = stored.select(*columns, file_date(F.col("_source_file")).alias("date"))
        rows = rows.unionByName(older)
    return latest_per_key(rows, "account_id", "date").select(*columns)
