"""Marts computed from resolvable silver transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.functions.aggregates import (
    count_where,
    mean_where,
    sum_where,
    sum_where_or_zero,
)
from sediment.functions.dates import week_end, week_start
from sediment.functions.money import as_total
from sediment.schemas import DAILY_CODES, GOLD_DAILY, GOLD_WEEKLY


def resolvable(silver: DataFrame) -> DataFrame:
    return silver.where("_is_resolvable")


def period_bounds(silver: DataFrame) -> DataFrame:
    """First and last day with a resolvable transaction."""
    return resolvable(silver).agg(
        F.min("transaction_date").alias("_source_period_start"),
        F.max("transaction_date").alias("_source_period_end"),
    )


def daily_rows(silver: DataFrame) -> DataFrame:
    """One row per day. A hot day is pre-aggregated by every map task before the shuffle."""
    amount = F.col("_signed_amount")
    per_code = []
    for name, code in DAILY_CODES.items():
        matches = F.col("transaction_code") == code
        per_code.append(count_where(matches).alias(f"{name}_count"))
        per_code.append(sum_where_or_zero(matches, amount).alias(f"{name}_amount"))
    return (
        resolvable(silver)
        .groupBy("transaction_date")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            as_total(F.sum(amount)).alias("total_signed_amount"),
            count_where(F.col("channel") == "ONLINE").alias("online_transactions"),
            count_where(F.col("channel") == "IN_STORE").alias("instore_transactions"),
            *per_code,
        )
    )


def finish_daily(days: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """The mart from its days: the period they span and the run they are published by."""
    # The bounds come from the grouped days (one row per calendar day), not from a second pass
    # over the transactions or a cross join.
    all_days = Window.partitionBy()
    return (
        days.withColumn("_source_period_start", F.min("transaction_date").over(all_days))
        .withColumn("_source_period_end", F.max("transaction_date").over(all_days))
        .withColumn("_computed_at", F.current_timestamp() if at is None else at)
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .select(*GOLD_DAILY.fieldNames())
    )


def daily_summary(silver: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    return finish_daily(daily_rows(silver), run_id, at)


def weekly_rows(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per account and ISO week."""
    kind, amount = F.col("transaction_type"), F.col("_signed_amount")
    return (
        resolvable(silver)
        .select("account_id", "transaction_date", "transaction_code", "_signed_amount")
        .join(codes.select("transaction_code", "transaction_type"), "transaction_code")
        .groupBy("account_id", week_start(F.col("transaction_date")).alias("week_start_date"))
        .agg(
            count_where(kind == "PURCHASE").alias("total_purchases"),
            mean_where(kind == "PURCHASE", amount).alias("avg_purchase_amount"),
            sum_where(kind == "PAYMENT", amount).alias("total_payments"),
            sum_where(kind == "FEE", amount).alias("total_fees"),
            sum_where(kind == "INTEREST", amount).alias("total_interest"),
        )
        .withColumn("week_end_date", week_end(F.col("week_start_date")))
    )


def finish_weekly(
    weeks: DataFrame, accounts: DataFrame, run_id: str, at: Column | None = None
) -> DataFrame:
    """The mart from its weeks, with the account's latest balance on every row.

    Accounts grow with the data, and their files are small for their number: they are never broadcast.
    """
    balances = accounts.select("account_id", F.col("current_balance").alias("closing_balance"))
    return (
        weeks.join(balances.hint("merge"), "account_id")
        .withColumn("_computed_at", F.current_timestamp() if at is None else at)
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .select(*GOLD_WEEKLY.fieldNames())
    )


def weekly_account_summary(
    silver: DataFrame,
    codes: DataFrame,
    accounts: DataFrame,
    run_id: str,
    at: Column | None = None,
) -> DataFrame:
    return finish_weekly(weekly_rows(silver, codes), accounts, run_id, at)


def replaced(before: DataFrame, fresh: DataFrame, key: str, changed: list) -> DataFrame:
    """``before`` without the days or weeks in ``changed``, and ``fresh`` in their place."""
    kept = before.where(~F.col(key).isin(changed)) if changed else before
    return kept.select(*fresh.columns).unionByName(fresh)
