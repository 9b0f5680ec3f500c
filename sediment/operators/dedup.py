"""Duplicate removal inside a day and across days, for many days in one pass.

Days are not looped over. A loop is only needed because a day depends on the ids promoted
before it, and that has a closed form: the first day on which an id is promotable.

Only narrow columns are grouped by transaction id, and the grouping pre-aggregates before it
shuffles. A single id that holds a large share of all rows therefore collapses to one row per
map task and day before it crosses the network. The full rows are joined back on their position
in the source file, which is unique per row and so spreads evenly whatever the ids look like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.operators.lookup import resolve_accounts
from sediment.operators.rules import REASON, accepted

ROW_KEY = ["date", "_row_ordinal"]


def first_in_batch(candidates: DataFrame) -> DataFrame:
    """The earliest row of each id in each day's file: one row per (date, transaction_id)."""
    earliest = F.min(
        F.struct(
            "_row_ordinal",
            "account_id",
            (F.col("transaction_date") == F.col("date")).alias("on_date"),
        )
    )
    return (
        candidates.groupBy("date", "transaction_id")
        .agg(earliest.alias("first"))
        .select("date", "transaction_id", "first.*")
    )


def stored_flag(firsts: DataFrame, stored_ids: DataFrame) -> DataFrame:
    """Flag ids already promoted on another day (``_stored``).

    Grouping the stored ids by the join key shares the join's shuffle and keeps the join from
    multiplying rows if an id is stored twice. They grow with the lake and are never broadcast; the
    window over ids that follows needs its rows where this join has them.
    """
    distinct_ids = existing_ids(stored_ids).withColumn("_stored", F.lit(True)).hint("merge")
    return firsts.join(distinct_ids, "transaction_id", "left").withColumn(
        "_stored", F.coalesce("_stored", F.lit(False))
    )


def existing_ids(promoted: DataFrame) -> DataFrame:
    return promoted.select("transaction_id").distinct()


def verdicts(
    checked: DataFrame,
    known: DataFrame,
    stored_ids: DataFrame | None = None,
) -> DataFrame:
    """Outcome of the earliest row per (date, id): reason (null if promoted) and account flag."""
    firsts = first_in_batch(accepted(checked))
    if stored_ids is None:
        firsts = firsts.withColumn("_stored", F.lit(False))
    else:
        firsts = stored_flag(firsts, stored_ids)
    # At most one row per day and id reaches this window, so no id can overload a task.
    promotable = F.when(F.col("on_date") & ~F.col("_stored"), F.col("date"))
    firsts = firsts.withColumn(
        "_first_day", F.min(promotable).over(Window.partitionBy("transaction_id"))
    )
    earlier = F.coalesce(F.col("_first_day") < F.col("date"), F.lit(False))
    reason = F.when(F.col("_stored") | earlier, F.lit("DUPLICATE_TRANSACTION_ID")).when(
        ~F.col("on_date"), F.lit("INVALID_TRANSACTION_DATE")
    )
    return resolve_accounts(
        firsts.select(*ROW_KEY, "account_id", reason.alias("_verdict")), known
    ).select(*ROW_KEY, "_verdict", "_is_resolvable", F.lit(True).alias("_first"))


def tag_transactions(
    checked: DataFrame,
    known: DataFrame,
    stored_ids: DataFrame | None = None,
) -> DataFrame:
    """Give every checked row its final reason; null means promoted.

    Raw rows are scanned twice, once for the verdicts and once for this join; rows that broke a
    row-level rule keep that reason and find no verdict.
    """
    outcome = verdicts(checked, known, stored_ids)
    repeat = F.when(F.col("_first").isNull(), F.lit("DUPLICATE_TRANSACTION_ID"))
    return (
        checked.join(outcome, ROW_KEY, "left")
        .withColumn(REASON, F.coalesce(REASON, repeat, F.col("_verdict")))
        .drop("_first", "_verdict", "_code_known")
    )


def promoted_transactions(
    checked: DataFrame,
    known: DataFrame,
    stored_ids: DataFrame | None = None,
) -> DataFrame:
    """The rows ``tag_transactions`` promotes, and nothing else: no rejected row is shuffled."""
    outcome = verdicts(checked, known, stored_ids).where("_verdict IS NULL")
    return accepted(checked).join(outcome, ROW_KEY).drop("_first", "_verdict", "_code_known")
