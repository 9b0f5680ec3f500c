"""Promotion to the silver layer and routing to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.operators.rules import accepted, rejected
from sediment.schemas import (
    QUARANTINE_ACCOUNTS,
    QUARANTINE_TRANSACTIONS,
    SILVER_ACCOUNTS,
    SILVER_CODES,
    SILVER_TRANSACTIONS,
)


def promote_codes(bronze: DataFrame, run_id: str) -> DataFrame:
    return (
        bronze.withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .select(*SILVER_CODES.fieldNames())
    )


def promote_transactions(tagged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    return (
        accepted(tagged)
        .withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .withColumn("_promoted_at", F.current_timestamp() if at is None else at)
        .select(*SILVER_TRANSACTIONS.fieldNames())
    )


def promote_accounts(tagged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Accepted deltas in silver shape, still one row per delta; keeps ``date`` for the upsert."""
    return (
        accepted(tagged)
        .withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .withColumn("_record_valid_from", F.current_timestamp() if at is None else at)
        .select(*SILVER_ACCOUNTS.fieldNames(), "date")
    )


def _quarantine(tagged: DataFrame, names: list[str], run_id: str, at: Column | None) -> DataFrame:
    return (
        rejected(tagged)
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .withColumn("_rejected_at", F.current_timestamp() if at is None else at)
        .select(*names)
    )


def quarantine_transactions(tagged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    return _quarantine(tagged, QUARANTINE_TRANSACTIONS.fieldNames(), run_id, at)


def quarantine_accounts(tagged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    return _quarantine(tagged, QUARANTINE_ACCOUNTS.fieldNames(), run_id, at)
