"""Every data contract, run over a stored lake."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.operators import contracts
from sediment.operators.lookup import known_accounts
from sediment.operators.rules import accepted, check_accounts
from sediment.plans import gold
from sediment.schemas import ACCOUNT_SOURCE, TRANSACTION_SOURCE
from sediment.sources import csvfiles
from sediment.sources.control import Control
from sediment.sources.lake import DAILY, SNAPSHOTS, Lake, empty

_AUDIT = {
    "bronze_transactions": ["_source_file", "_ingested_at", "_pipeline_run_id"],
    "bronze_accounts": ["_source_file", "_ingested_at", "_pipeline_run_id"],
    "silver_transactions": ["_source_file", "_bronze_ingested_at", "_pipeline_run_id"],
    "silver_quarantine": ["_source_file", "_pipeline_run_id", "_rejected_at"],
    "silver_accounts_quarantine": ["_source_file", "_pipeline_run_id", "_rejected_at"],
}
GOLD_AUDIT = ["_computed_at", "_pipeline_run_id"]
DIFFERENCES = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("surplus", T.LongType())])


def violations(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Contract name to the frame of its violations. Nothing runs until a frame is used."""
    lake = Lake(spark, root)
    control = Control(lake)
    days = sorted(control.done("silver_transactions"))
    tables = {name: lake.days(name, days) for name in DAILY}
    tables |= {name: lake.snapshot(name, control.latest_run(name)) for name in SNAPSHOTS}
    log = control.log()

    raw, raw_accounts = tables["bronze_transactions"], tables["bronze_accounts"]
    silver, rejects = tables["silver_transactions"], tables["silver_quarantine"]
    accounts, account_rejects = tables["silver_accounts"], tables["silver_accounts_quarantine"]
    codes = tables["silver_transaction_codes"]
    daily, weekly = tables["gold_daily_summary"], tables["gold_weekly_account_summary"]

    deltas = accepted(check_accounts(raw_accounts))
    found = {
        "conservation_transactions": contracts.conservation(raw, silver, rejects),
        "conservation_accounts": contracts.conservation(raw_accounts, deltas, account_rejects),
        "unique_codes": contracts.duplicate_keys(codes, "transaction_code"),
        "unique_accounts": contracts.duplicate_keys(accounts, "account_id"),
        "unique_transactions": contracts.duplicate_keys(silver, "transaction_id"),
        "unique_days": contracts.duplicate_keys(daily, "transaction_date"),
        "unique_account_weeks": contracts.duplicate_keys(weekly, "account_id", "week_start_date"),
        "reason_domain": contracts.unknown_reasons(rejects),
        "reason_domain_accounts": contracts.unknown_reasons(account_rejects),
        "codes_known": contracts.orphan_codes(silver, codes),
        "signs": contracts.wrong_signs(silver),
        "rows_on_their_day": contracts.misplaced_rows(silver),
        "raw_rows_on_their_day": contracts.misfiled_rows(raw),
        "rejects_traceable": contracts.untraceable(
            rejects, raw, [*TRANSACTION_SOURCE.names, "_source_file"]
        ),
        "account_rejects_traceable": contracts.untraceable(
            account_rejects, raw_accounts, [*ACCOUNT_SOURCE.names, "_source_file"]
        ),
        "daily_mart_matches": contracts.daily_differences(daily, silver),
        "weekly_mart_matches": contracts.weekly_differences(weekly, silver, codes),
        "daily_mart_not_overstated": contracts.overstated_days(daily, silver),
        "weekly_accounts_known": contracts.unbacked_accounts(weekly, accounts),
        "daily_mart_one_run": contracts.mixed_runs(daily),
        "weekly_mart_one_run": contracts.mixed_runs(weekly),
        "runs_logged": contracts.orphan_runs(silver, log),
        "log_valid": contracts.invalid_log_rows(log),
    }
    for name, columns in _AUDIT.items():
        found[f"audit_columns_{name}"] = contracts.missing_audit(tables[name], columns)
    return found


def schema_problems(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Stored columns, as the files hold them, that are not as specified."""
    problems = {}
    lake = Lake(spark, root)
    control = Control(lake)
    for name, (path, schema) in (DAILY | SNAPSHOTS).items():
        if name in DAILY:
            written = control.done(name, with_rows=True)
            location = lake.folder(name)
        else:
            written = control.latest_run(name)
            location = f"{lake.root}/{path}/run_id={written}"
        if not written:
            continue
        wrong = contracts.schema_differences(spark.read.parquet(location), schema)
        if wrong:
            problems[name] = wrong
    return problems


def flag_violations(spark: SparkSession, root: str) -> DataFrame:
    """Account flags that do not follow from the accounts known on each row's day.

    Only meaningful for a lake loaded in date order: a flag is set once, with what was known then.
    """
    lake = Lake(spark, root)
    days = sorted(Control(lake).done("silver_transactions"))
    known = known_accounts(accepted(check_accounts(lake.days("bronze_accounts", days))))
    return contracts.wrong_flags(lake.days("silver_transactions", days), known)


def incomplete_files(spark: SparkSession, source_dir: str, root: str) -> DataFrame:
    """Source files whose number of rows is not that of the raw layer."""
    lake = Lake(spark, root)
    parts = []
    for entity in ("transactions", "accounts"):
        name = f"bronze_{entity}"
        days = sorted(Control(lake).done(name, with_rows=True))
        files = csvfiles.daily_files(spark, source_dir, entity, days[0], days[-1])
        paths = [files[d] for d in days if d in files]
        # Counted from the lines, so that a fault of the CSV reader shows.
        stored = lake.days(name, days).groupBy("_source_file").agg(F.count("*").alias("right"))
        counted = csvfiles.count_records(spark, paths).withColumnRenamed("records", "left")
        both = counted.join(stored, "_source_file", "full").fillna(0, ["left", "right"])
        parts.append(both.where(F.col("left") != F.col("right")))
    return parts[0].unionByName(parts[1])


def rerun_differences(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the stored marts that a fresh computation does not reproduce, and vice versa.

    Days and weeks are compared by fingerprints first, in one aggregation each that runs at once; rows
    are compared only of those that differ, at most one value per calendar day or week.
    """
    lake = Lake(spark, root)
    control = Control(lake)
    days: list[date] = sorted(control.done("silver_transactions"))
    silver = lake.days("silver_transactions", days)
    codes = lake.snapshot(
        "silver_transaction_codes", control.latest_run("silver_transaction_codes")
    )
    accounts = lake.snapshot("silver_accounts", control.latest_run("silver_accounts"))
    daily = gold.daily_summary(silver, "audit")
    weekly = gold.weekly_account_summary(silver, codes, accounts, "audit")
    fresh = {"gold_daily_summary": (daily, "transaction_date"), "gold_weekly_account_summary": (weekly, "week_start_date")}
    parts = []
    for name, (df, key) in fresh.items():
        stored = lake.snapshot(name, control.latest_run(name))
        found = [row[0] for row in contracts.changed_groups(stored, df, GOLD_AUDIT, key).collect()]
        if found:
            wrong = F.coalesce(F.col(key).isin(found), F.lit(None in found))
            changed = contracts.changed_rows(stored.where(wrong), df.where(wrong), GOLD_AUDIT)
            parts.append(changed.select(F.lit(name).alias("table_name"), "surplus"))
    nothing = empty(spark, DIFFERENCES)
    return reduce(DataFrame.unionByName, parts, nothing)
