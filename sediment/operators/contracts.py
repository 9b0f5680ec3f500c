"""Data contracts. Each returns the violations; an empty frame means the contract holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.aggregates import count_where, sum_where
from sediment.functions.dates import file_date, week_start
from sediment.functions.text import any_of
from sediment.operators.compare import count_by, differing_groups, row_digest, row_surplus, side_by_side
from sediment.operators.lookup import resolve_accounts
from sediment.plans.gold import resolvable
from sediment.schemas import REASONS, RUN_STATUSES

TOLERANCE = 0.001


class ContractViolation(RuntimeError):
    """A contract that must hold before publishing does not."""


def require_empty(violations: DataFrame, message: str) -> None:
    """Raise with the number of violations and a few examples if there is any."""
    number = violations.count()
    if number:
        examples = [row.asDict() for row in violations.limit(5).collect()]
        raise ContractViolation(f"{message}: {number} violations, among them {examples}")


# --- conservation and completeness -------------------------------------------------------


def outcome_counts(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per day in each layer and the gap between them."""
    counts = side_by_side("date", bronze=bronze, silver=silver, quarantine=quarantine)
    return counts.withColumn("gap", F.col("bronze") - F.col("silver") - F.col("quarantine"))


def outcome_counts_of(bronze: DataFrame, tagged: DataFrame) -> DataFrame:
    """``outcome_counts`` of rows that carry their reason: both layers are counted in one pass."""
    silver = F.sum(F.col("_rejection_reason").isNull().cast("long")).alias("silver")
    quarantine = F.sum(F.col("_rejection_reason").isNotNull().cast("long")).alias("quarantine")
    raw = bronze.groupBy("date").agg(F.count("*").alias("bronze"))
    both = raw.join(tagged.groupBy("date").agg(silver, quarantine), "date", "full").fillna(0)
    return both.withColumn("gap", F.col("bronze") - F.col("silver") - F.col("quarantine"))


def conservation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Days on which bronze rows are not exactly the silver plus the quarantine rows."""
    return outcome_counts(bronze, silver, quarantine).where(F.col("gap") != 0)


def same_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys with a different number of rows in the two frames."""
    return side_by_side(key, left=left, right=right).where(F.col("left") != F.col("right"))


def changed_rows(before: DataFrame, after: DataFrame, audit: list[str]) -> DataFrame:
    """Rows that differ between two runs, audit columns aside."""
    return row_surplus(before, after, [c for c in before.columns if c not in audit])


def changed_groups(before: DataFrame, after: DataFrame, audit: list[str], key: str) -> DataFrame:
    """Values of ``key`` whose rows differ between two runs, audit columns aside."""
    return differing_groups(before, after, key, [c for c in before.columns if c not in audit])


def missing_rows(subset: DataFrame, whole: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``subset`` that ``whole`` does not hold as often. Nulls compare equal.

    Both sides are counted per distinct row first, so a large group of copies stays cheap.
    """
    return row_surplus(subset, whole, columns).where(F.col("surplus") > 0)


def untraceable(rejects: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """Rejects without a raw row at their day and position that has the same values.

    Positions are unique and spread evenly, so one join does and nothing is grouped. Of a raw row only
    its position and a digest of 128 bits are sent, to the task its position is dealt to: the files of many
    rows can be small enough for Spark to broadcast them unless told not to.
    """
    there = raw.select("date", "_row_ordinal", F.struct(*row_digest(columns)).alias("_raw"))
    joined = rejects.join(there.hint("merge"), ["date", "_row_ordinal"], "left")
    own = F.struct(*row_digest([F.col(c).cast(raw.schema[c].dataType) for c in columns]))
    return joined.where(F.col("_raw").isNull() | (own != F.col("_raw"))).drop("_raw")


# --- uniqueness, domains, references -----------------------------------------------------


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row."""
    return count_by(df, "rows", *keys).where(F.col("rows") > 1)


def unknown_reasons(quarantine: DataFrame) -> DataFrame:
    reasons = count_by(quarantine, "rows", "_rejection_reason")
    known = F.coalesce(F.col("_rejection_reason").isin(REASONS), F.lit(False))
    return reasons.where(~known)


def orphan_codes(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Promoted codes missing from the code table. Grouped first: few codes, many rows."""
    used = count_by(silver, "rows", "transaction_code")
    return used.join(codes.select("transaction_code"), "transaction_code", "left_anti")


def wrong_signs(silver: DataFrame) -> DataFrame:
    """Rows whose signed amount is missing, zero or against the debit/credit indicator."""
    signed, indicator = F.col("_signed_amount"), F.col("debit_credit_indicator")
    right = ((indicator == "DR") & (signed == F.col("amount"))) | (
        (indicator == "CR") & (signed == -F.col("amount"))
    )
    return silver.where(~F.coalesce(right & (signed != 0), F.lit(False)))


def wrong_flags(silver: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose account flag is not what the accounts known on their day say."""
    fresh = resolve_accounts(
        silver.select("transaction_id", "account_id", "date", F.col("_is_resolvable").alias("stored")),
        known,
    )
    return fresh.where(F.col("stored") != F.col("_is_resolvable"))


def misplaced_rows(silver: DataFrame) -> DataFrame:
    """Rows stored under another day than their own."""
    return silver.where(~(F.col("transaction_date").eqNullSafe(F.col("date"))))


def misfiled_rows(bronze: DataFrame) -> DataFrame:
    """Raw rows stored under another day than their file's."""
    return bronze.where(~(file_date(F.col("_source_file")).eqNullSafe(F.col("date"))))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])


def missing_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(any_of([F.col(c).isNull() for c in columns]))


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Columns that are missing, surplus or of another type; nullability is not compared."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return sorted(
        name for name in have.keys() | want.keys() if have.get(name) != want.get(name)
    )


# --- marts -------------------------------------------------------------------------------


def daily_comparison(daily: DataFrame, silver: DataFrame) -> DataFrame:
    """Stored daily totals next to totals recomputed from silver."""
    fresh = (
        resolvable(silver)
        .groupBy("transaction_date")
        .agg(
            F.sum("_signed_amount").alias("silver_amount"),
            F.count(F.lit(1)).alias("silver_rows"),
        )
    )
    stored = daily.select(
        "transaction_date",
        F.col("total_signed_amount").alias("gold_amount"),
        F.col("total_transactions").alias("gold_rows"),
    )
    return stored.join(fresh, "transaction_date", "full")


def daily_differences(daily: DataFrame, silver: DataFrame) -> DataFrame:
    gap = F.abs(F.col("gold_amount") - F.col("silver_amount"))
    return daily_comparison(daily, silver).where(
        F.coalesce(gap > TOLERANCE, F.lit(True)) | ~(F.col("gold_rows").eqNullSafe(F.col("silver_rows")))
    )


def weekly_comparison(weekly: DataFrame, silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Stored weekly purchase counts and payments next to values recomputed from silver."""
    kind = F.col("transaction_type")
    fresh = (
        resolvable(silver)
        .join(codes.select("transaction_code", "transaction_type"), "transaction_code")
        .groupBy("account_id", week_start(F.col("transaction_date")).alias("week_start_date"))
        .agg(
            count_where(kind == "PURCHASE").alias("silver_purchases"),
            sum_where(kind == "PAYMENT", F.col("_signed_amount")).alias("silver_payments"),
        )
    )
    stored = weekly.select(
        "account_id",
        "week_start_date",
        F.col("total_purchases").alias("gold_purchases"),
        F.col("total_payments").alias("gold_payments"),
    )
    return stored.join(fresh, ["account_id", "week_start_date"], "full")


def weekly_differences(weekly: DataFrame, silver: DataFrame, codes: DataFrame) -> DataFrame:
    compared = weekly_comparison(weekly, silver, codes)
    return compared.where(
        ~(F.col("gold_purchases").eqNullSafe(F.col("silver_purchases")))
        | ~(F.col("gold_payments").eqNullSafe(F.col("silver_payments")))
    )


def overstated_days(daily: DataFrame, silver: DataFrame) -> DataFrame:
    """Days reporting more transactions than silver holds resolvable ones."""
    return daily_comparison(daily, silver).where(
        F.col("gold_rows") > F.coalesce(F.col("silver_rows"), F.lit(0))
    )


def unbacked_accounts(weekly: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts in the weekly mart that the account dimension does not hold. It grows: never broadcast."""
    held = accounts.select("account_id").hint("merge")
    return weekly.select("account_id").distinct().join(held, "account_id", "left_anti")


def mixed_runs(gold: DataFrame) -> DataFrame:
    """A mart must come from one run: run ids present, if more than one."""
    runs = gold.select("_pipeline_run_id", "_computed_at").distinct()
    return runs.agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > 1)


# --- run log -----------------------------------------------------------------------------


def orphan_runs(silver: DataFrame, run_log: DataFrame) -> DataFrame:
    """Run ids in silver without a SUCCESS row in the log."""
    succeeded = run_log.where(F.col("status") == "SUCCESS").select(
        F.col("run_id").alias("_pipeline_run_id")
    )
    return (
        silver.select("_pipeline_run_id").distinct().join(succeeded, "_pipeline_run_id", "left_anti")
    )


def invalid_log_rows(run_log: DataFrame) -> DataFrame:
    required = ["run_id", "model_name", "started_at", "completed_at"]
    return run_log.where(
        any_of([F.col(c).isNull() for c in required])
        | ~F.coalesce(F.col("status").isin(RUN_STATUSES), F.lit(False))
    )
