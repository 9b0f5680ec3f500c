"""The lake's operators as queries over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property, reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions.aggregates import count_where, duplicate_count
from sediment.operators import contracts
from sediment.operators.compare import count_by, row_surplus
from sediment.operators.dedup import existing_ids, first_in_batch, promoted_transactions, tag_transactions
from sediment.operators.lookup import known_accounts
from sediment.operators.membership import groups_that_may_hold, sketches
from sediment.operators.rules import (
    REASON,
    TRANSACTION_RULES,
    accepted,
    check_accounts,
    check_transactions,
    first_broken,
    with_code,
)
from sediment.operators.upsert import retained, upsert_accounts
from sediment.plans import gold, silver
from sediment.schemas import ACCOUNT_SOURCE, CODE_SOURCE, REASONS, TRANSACTION_SOURCE
from sediment.sources import testtables as given
from sediment.sources.control import current_runs, days_done, latest_mark

Query = Callable[[SparkSession, str], DataFrame]

# The day on which the two-step queries split the month into "stored" and "new".
SPLIT = date(2024, 1, 16)
AUDIT = ["_source_file", "_pipeline_run_id"]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register a query. Money leaves as text, so any client compares every decimal of it."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = f(spark, sf_dir)
        money = [n for n, t in result.dtypes if t.startswith("decimal")]
        return result.withColumns({n: F.col(n).cast("string") for n in money})

    REGISTRY[f.__name__] = run
    return run


def _planted() -> Column:
    """The rows in which the checks are given faults, so that they have something to find."""
    return F.coalesce(F.col("transaction_id").endswith("7"), F.lit(False))


class Stages:
    """The lake's tables derived from the given ones; nothing runs until a query is used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        return given.bronze_transactions(self.spark, self.sf_dir)

    @cached_property
    def codes(self) -> DataFrame:
        return given.reference_codes(self.spark)

    @cached_property
    def checked(self) -> DataFrame:
        return check_transactions(self.bronze, self.codes)

    @cached_property
    def bronze_accounts(self) -> DataFrame:
        return given.bronze_accounts(self.spark, self.sf_dir)

    @cached_property
    def deltas(self) -> DataFrame:
        return check_accounts(self.bronze_accounts)

    @cached_property
    def promoted_deltas(self) -> DataFrame:
        return silver.promote_accounts(self.deltas, given.RUN_ID)

    @cached_property
    def accounts(self) -> DataFrame:
        return upsert_accounts(self.promoted_deltas)

    @cached_property
    def known(self) -> DataFrame:
        return known_accounts(accepted(self.deltas))

    @cached_property
    def tagged(self) -> DataFrame:
        return tag_transactions(self.checked, self.known)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.promote_transactions(promoted_transactions(self.checked, self.known), given.RUN_ID)

    @cached_property
    def quarantine(self) -> DataFrame:
        return silver.quarantine_transactions(self.tagged, given.RUN_ID)

    @cached_property
    def quarantine_accounts(self) -> DataFrame:
        return silver.quarantine_accounts(self.deltas, given.RUN_ID)

    @cached_property
    def tagged_in_two_steps(self) -> DataFrame:
        """The later days processed as new days on top of the earlier ones."""
        day, tx_day = F.col("date"), F.lit(SPLIT)
        deltas = self.promoted_deltas
        known = known_accounts(
            deltas.where(day >= tx_day), upsert_accounts(deltas.where(day < tx_day))
        )
        earlier = self.tagged_before
        return tag_transactions(
            self.checked.where(day >= tx_day), known, accepted(earlier).select("transaction_id")
        )

    @cached_property
    def tagged_before(self) -> DataFrame:
        return tag_transactions(self.checked.where(F.col("date") < F.lit(SPLIT)), self.known)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily_summary(self.silver, given.RUN_ID)

    @cached_property
    def weekly(self) -> DataFrame:
        return gold.weekly_account_summary(self.silver, self.codes, self.accounts, given.RUN_ID)

    @cached_property
    def run_log(self) -> DataFrame:
        """A log with one run per day that has transactions; every tenth day's run failed."""
        return (
            self.bronze.groupBy("date")
            .agg(F.max("_row_ordinal.line").alias("last_line"))
            .select(
                (F.lit(1704067200) + F.col("last_line") * 100 + F.dayofmonth("date")).alias(
                    "completed_second"
                ),
                F.concat(F.lit("run-"), F.col("date").cast("string")).alias("run_id"),
                F.lit("silver_transactions").alias("model_name"),
                F.when(F.dayofmonth("date") % 10 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
                F.col("date").alias("process_date"),
            )
        )


def _position(df: DataFrame) -> list:
    return [F.col("_row_ordinal.block").alias("row_block"), F.col("_row_ordinal.line").alias("row_line")]


def _without_clock(df: DataFrame) -> DataFrame:
    clocks = ["_ingested_at", "_bronze_ingested_at", "_promoted_at", "_rejected_at"]
    return df.drop(*clocks, "_record_valid_from", "_computed_at", "_row_ordinal")


# --- raw layer ---------------------------------------------------------------------------


@query
def bronze_transactions(spark, sf_dir):
    return Stages(spark, sf_dir).bronze.select(*TRANSACTION_SOURCE.names, *AUDIT, "date")


@query
def bronze_accounts(spark, sf_dir):
    return Stages(spark, sf_dir).bronze_accounts.select(*ACCOUNT_SOURCE.names, *AUDIT, "date")


@query
def bronze_codes(spark, sf_dir):
    return given.bronze_codes(spark, sf_dir).select(*CODE_SOURCE.names, *AUDIT)


@query
def silver_codes(spark, sf_dir):
    return _without_clock(silver.promote_codes(given.bronze_codes(spark, sf_dir), "run-0002"))


@query
def bronze_counts_by_partition(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    parts = [("transactions", stages.bronze), ("accounts", stages.bronze_accounts)]
    counts = [count_by(df, "row_count", "date").withColumn("entity", F.lit(n)) for n, df in parts]
    return reduce(DataFrame.unionByName, counts).orderBy("entity", "date")


@query
def source_completeness(spark, sf_dir):
    """Rows per source file, and whether every row sits under its file's day."""
    bronze = Stages(spark, sf_dir).bronze
    misfiled = contracts.misfiled_rows(bronze).select("_source_file", F.lit(1).alias("bad"))
    rows = bronze.select("_source_file", F.lit(0).alias("bad")).unionByName(misfiled)
    return rows.groupBy("_source_file").agg(
        count_where(F.col("bad") == 0).alias("row_count"),
        count_where(F.col("bad") == 1).alias("misfiled"),
    )


# --- validation ladder -------------------------------------------------------------------


def _ladder(spark, sf_dir, rules: int) -> DataFrame:
    stages = Stages(spark, sf_dir)
    rows = with_code(stages.bronze, stages.codes)
    reason = first_broken(TRANSACTION_RULES[:rules]).alias("reason")
    return rows.select("date", *_position(rows), reason, "debit_credit_indicator", "_signed_amount")


@query
def tx_required_fields(spark, sf_dir):
    return _ladder(spark, sf_dir, 1).drop("debit_credit_indicator", "_signed_amount")


@query
def tx_amount_check(spark, sf_dir):
    return _ladder(spark, sf_dir, 2).drop("debit_credit_indicator", "_signed_amount")


@query
def tx_code_check(spark, sf_dir):
    return _ladder(spark, sf_dir, 3).drop("_signed_amount")


@query
def tx_channel_check(spark, sf_dir):
    return _ladder(spark, sf_dir, 4).drop("_signed_amount")


@query
def tx_sign_check(spark, sf_dir):
    return _ladder(spark, sf_dir, 5)


@query
def batch_dedup(spark, sf_dir):
    firsts = first_in_batch(accepted(Stages(spark, sf_dir).checked))
    return firsts.select("date", "transaction_id", "account_id", *_position(firsts), "on_date")


@query
def cross_partition_dups(spark, sf_dir):
    """Ids that pass the row rules on more than one day."""
    checked = accepted(Stages(spark, sf_dir).checked)
    return (
        first_in_batch(checked)
        .groupBy("transaction_id")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
        )
        .where(F.col("days") > 1)
    )


@query
def tx_outcome(spark, sf_dir):
    tagged = Stages(spark, sf_dir).tagged
    return tagged.select(
        "date", *_position(tagged), "transaction_id", REASON,
        (F.col(REASON).isNull() & F.col("_is_resolvable")).alias("_is_resolvable"),
    )


@query
def tx_outcome_on_stored(spark, sf_dir):
    """The same outcomes for the later days, with the earlier days already stored."""
    tagged = Stages(spark, sf_dir).tagged_in_two_steps
    return tagged.select(
        "date", *_position(tagged), "transaction_id", REASON,
        (F.col(REASON).isNull() & F.col("_is_resolvable")).alias("_is_resolvable"),
    )


@query
def silver_transactions(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).silver)


@query
def quarantine_transactions(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).quarantine)


@query
def stored_ids(spark, sf_dir):
    """Ids promoted on any other day than the split day."""
    others = Stages(spark, sf_dir).silver.where(F.col("date") != F.lit(SPLIT))
    return existing_ids(others)


@query
def stored_ids_found(spark, sf_dir):
    """Ids offered from the split day on that an earlier day has promoted, looked up through sketches.

    Groups of stored ids that cannot hold any of them are left out before the exact join.
    """
    stages = Stages(spark, sf_dir)
    bucket = F.pmod(F.hash("transaction_id"), F.lit(64)).alias("bucket")
    stored = accepted(stages.tagged_before).select("date", "transaction_id", bucket)
    offered = existing_ids(accepted(stages.checked.where(F.col("date") >= F.lit(SPLIT)))).select("transaction_id", bucket)
    near = groups_that_may_hold(
        sketches(stored, "date", "bucket", "transaction_id"), offered, "date", "bucket", "transaction_id"
    )
    read = stored.join(near, ["date", "bucket"], "left_semi")
    return read.join(offered.select("transaction_id"), "transaction_id", "left_semi").select("date", "transaction_id")


@query
def reject_reason_counts(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    parts = [("transactions", stages.tagged), ("accounts", stages.deltas)]
    rows = reduce(
        DataFrame.unionByName,
        [df.where(F.col(REASON).isNotNull()).select(F.lit(n).alias("entity"), REASON) for n, df in parts],
    )
    return count_by(rows, "row_count", "entity", REASON).withColumn(
        "in_domain", F.col(REASON).isin(REASONS)
    )


# --- accounts ----------------------------------------------------------------------------


@query
def accounts_tagged(spark, sf_dir):
    return Stages(spark, sf_dir).deltas.select(*ACCOUNT_SOURCE.names, "date", REASON)


@query
def silver_accounts(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).accounts)


@query
def silver_accounts_in_two_steps(spark, sf_dir):
    """Later deltas merged into the accounts stored from earlier ones."""
    deltas = Stages(spark, sf_dir).promoted_deltas
    stored = upsert_accounts(deltas.where(F.col("date") < F.lit(SPLIT)))
    return _without_clock(upsert_accounts(deltas.where(F.col("date") >= F.lit(SPLIT)), stored))


@query
def accounts_retained(spark, sf_dir):
    deltas = Stages(spark, sf_dir).promoted_deltas
    stored = upsert_accounts(deltas.where(F.col("date") < F.lit(SPLIT)))
    return _without_clock(retained(stored, deltas.where(F.col("date") >= F.lit(SPLIT))))


@query
def quarantine_accounts(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).quarantine_accounts)


@query
def account_first_seen(spark, sf_dir):
    return Stages(spark, sf_dir).known


@query
def account_resolution(spark, sf_dir):
    return count_by(Stages(spark, sf_dir).silver, "row_count", "date", "_is_resolvable")


# --- marts -------------------------------------------------------------------------------


@query
def period_bounds(spark, sf_dir):
    return gold.period_bounds(Stages(spark, sf_dir).silver)


@query
def gold_daily_summary(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).daily).orderBy("transaction_date")


@query
def gold_weekly_account_summary(spark, sf_dir):
    return _without_clock(Stages(spark, sf_dir).weekly)


# --- contracts ---------------------------------------------------------------------------


@query
def conservation_by_date(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.outcome_counts_of(stages.bronze, stages.tagged)


@query
def accounts_conservation_by_date(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.outcome_counts(
        stages.bronze_accounts, stages.promoted_deltas, stages.quarantine_accounts
    )


@query
def uniqueness_checks(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    keyed = [
        ("silver_transactions", stages.silver.select(F.col("transaction_id").alias("key"))),
        ("silver_accounts", stages.accounts.select(F.col("account_id").alias("key"))),
        (
            "gold_daily_summary",
            stages.daily.select(F.col("transaction_date").cast("string").alias("key")),
        ),
    ]
    rows = reduce(DataFrame.unionByName, [df.withColumn("table_name", F.lit(n)) for n, df in keyed])
    return rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("key").alias("distinct_keys"),
        duplicate_count("key").alias("duplicates"),
    )


@query
def null_audit_checks(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    columns = {
        "bronze": ["_source_file", "_ingested_at", "_pipeline_run_id"],
        "silver": ["_source_file", "_bronze_ingested_at", "_pipeline_run_id", "_signed_amount"],
        "quarantine": ["_source_file", "_pipeline_run_id", "_rejection_reason"],
    }
    tables = {"bronze": stages.bronze, "silver": stages.silver, "quarantine": stages.quarantine}
    counted = [
        contracts.null_counts(tables[layer], names).select(
            F.lit(layer).alias("layer"),
            F.explode(
                F.array(
                    *[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("nulls")) for n in names]
                )
            ).alias("pair"),
        )
        for layer, names in columns.items()
    ]
    return reduce(DataFrame.unionByName, counted).select("layer", "pair.column_name", "pair.nulls")


@query
def code_orphans(spark, sf_dir):
    """Orphan codes among raw rows; among promoted rows there are none."""
    stages = Stages(spark, sf_dir)
    raw = contracts.orphan_codes(stages.bronze, stages.codes).withColumn("layer", F.lit("bronze"))
    promoted = contracts.orphan_codes(stages.silver, stages.codes)
    return raw.unionByName(promoted.withColumn("layer", F.lit("silver"))).withColumnRenamed(
        "rows", "row_count"
    )


@query
def sign_violations(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    signed = F.col("_signed_amount")
    faulty = stages.silver.withColumn("_signed_amount", F.when(_planted(), -signed).otherwise(signed))
    wrong = contracts.wrong_signs(faulty).select("transaction_code", F.lit(1).alias("bad"))
    rows = stages.silver.select("transaction_code", F.lit(0).alias("bad")).unionByName(wrong)
    return rows.groupBy("transaction_code").agg(
        count_where(F.col("bad") == 0).alias("row_count"),
        count_where(F.col("bad") == 1).alias("violations"),
    )


@query
def account_flag_violations(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    flag = F.col("_is_resolvable")
    faulty = stages.silver.withColumn("_is_resolvable", F.when(_planted(), ~flag).otherwise(flag))
    return contracts.wrong_flags(faulty, stages.known).agg(
        F.count(F.lit(1)).alias("violations")
    )


@query
def partition_violations(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    day = F.col("date")
    faulty = stages.silver.withColumn("date", F.when(_planted(), F.date_add(day, 1)).otherwise(day))
    return contracts.misplaced_rows(faulty).agg(F.count(F.lit(1)).alias("violations"))


@query
def quarantine_untraceable(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    columns = [*TRANSACTION_SOURCE.names, "_source_file"]
    name = F.col("merchant_name")
    faulty = stages.quarantine.withColumn("merchant_name", F.when(_planted(), "stray").otherwise(name))
    return contracts.untraceable(faulty, stages.bronze, columns).agg(
        F.count(F.lit(1)).alias("violations")
    )


@query
def daily_reconciliation(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.daily_comparison(stages.daily, stages.silver).select(
        "transaction_date",
        "gold_amount",
        F.col("silver_amount").cast("decimal(18,4)").alias("silver_amount"),
        (F.abs(F.col("gold_amount") - F.col("silver_amount")) > contracts.TOLERANCE).alias("differs"),
    )


@query
def weekly_reconciliation(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.weekly_comparison(stages.weekly, stages.silver, stages.codes).select(
        "account_id",
        "week_start_date",
        "gold_purchases",
        "silver_purchases",
        (F.col("gold_purchases") != F.col("silver_purchases")).alias("differs"),
    )


@query
def weekly_payments_reconciliation(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.weekly_comparison(stages.weekly, stages.silver, stages.codes).select(
        "account_id",
        "week_start_date",
        "gold_payments",
        "silver_payments",
        (~(F.col("gold_payments").eqNullSafe(F.col("silver_payments")))).alias("differs"),
    )


@query
def daily_grain(spark, sf_dir):
    """Rows of the daily mart against the days it must cover."""
    stages = Stages(spark, sf_dir)
    sides = stages.daily.select("transaction_date", F.lit("gold").alias("side")).unionByName(
        gold.resolvable(stages.silver).select("transaction_date", F.lit("silver").alias("side"))
    )
    days = sides.groupBy("transaction_date", "side").count()
    return days.agg(
        F.sum(F.when(F.col("side") == "gold", F.col("count"))).alias("gold_rows"),
        count_where(F.col("side") == "silver").alias("silver_days"),
    ).withColumn("equal", F.col("gold_rows") == F.col("silver_days"))


@query
def gold_exceeds_silver(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    return contracts.daily_comparison(stages.daily, stages.silver).select(
        "transaction_date",
        "gold_rows",
        "silver_rows",
        (F.col("gold_rows") > F.col("silver_rows")).alias("exceeds"),
    )


@query
def weekly_unbacked_accounts(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    fewer = stages.accounts.where(~F.col("account_id").endswith("7"))
    return contracts.unbacked_accounts(stages.weekly, fewer).agg(
        F.count(F.lit(1)).alias("violations")
    )


@query
def gold_rerun_diff(spark, sf_dir):
    """Daily totals from one pass over all days next to totals from two successive runs."""
    stages = Stages(spark, sf_dir)
    steps = [stages.tagged_before, stages.tagged_in_two_steps]
    rerun = reduce(
        DataFrame.unionByName, [silver.promote_transactions(t, "run-0002") for t in steps]
    )
    columns = [c for c in stages.daily.columns if c not in ("_computed_at", "_pipeline_run_id")]
    first = stages.daily.select(*columns)
    second = gold.daily_summary(rerun, "run-0002").select(*columns)
    surplus = row_surplus(first, second, columns).where(F.col("surplus") > 0)
    return second.join(
        surplus.select("transaction_date", F.lit(True).alias("differs")), "transaction_date", "left"
    ).withColumn("differs", F.coalesce("differs", F.lit(False)))


@query
def gold_weekly_rerun(spark, sf_dir):
    """The weekly mart from two successive runs; the second only computes the weeks it touches."""
    stages = Stages(spark, sf_dir)
    before, after = (
        silver.promote_transactions(t, "run-0002")
        for t in (stages.tagged_before, stages.tagged_in_two_steps)
    )
    split_week = F.lit(SPLIT - timedelta(days=SPLIT.weekday()))
    touched = before.where(F.col("transaction_date") >= split_week).unionByName(after)
    old = gold.weekly_rows(before, stages.codes).where(F.col("week_start_date") < split_week)
    weeks = old.unionByName(gold.weekly_rows(touched, stages.codes))
    mart = gold.finish_weekly(weeks, stages.accounts, "run-0002")
    return mart.drop("_computed_at", "_pipeline_run_id")


# --- increments and run log --------------------------------------------------------------


@query
def watermark_next(spark, sf_dir):
    """The mark after the last successful day, and whether the next day's file is there."""
    stages = Stages(spark, sf_dir)
    marks = days_done(stages.run_log, "silver_transactions").select(
        F.col("process_date").alias("last_processed_date")
    )
    next_day = latest_mark(marks).withColumn("next_date", F.date_add("last_processed_date", 1))
    files = stages.bronze.select(F.col("date").alias("next_date"), F.lit(True).alias("found")).distinct()
    return next_day.join(files, "next_date", "left").select(
        "last_processed_date",
        "next_date",
        F.coalesce("found", F.lit(False)).alias("file_present"),
    )


@query
def pending_dates(spark, sf_dir):
    """Days with a file but without a successful run, over the whole date range."""
    stages = Stages(spark, sf_dir)
    span = stages.bronze.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    days = span.select(F.explode(F.sequence("start", "end")).alias("date"))
    done = days_done(stages.run_log, "silver_transactions").withColumnRenamed("process_date", "date")
    return days.join(done, "date", "left_anti")


@query
def run_log_orphans(spark, sf_dir):
    """Run ids of promoted rows that no successful run accounts for."""
    stages = Stages(spark, sf_dir)
    promoted = stages.silver.withColumn(
        "_pipeline_run_id", F.concat(F.lit("run-"), F.col("date").cast("string"))
    )
    return contracts.orphan_runs(promoted, stages.run_log)


@query
def run_log_status_counts(spark, sf_dir):
    return count_by(Stages(spark, sf_dir).run_log, "row_count", "model_name", "status")


@query
def latest_run(spark, sf_dir):
    """The run that succeeded last, which is the one whose tables are current."""
    return current_runs(Stages(spark, sf_dir).run_log, "completed_second")


@query
def unloaded_rows(spark, sf_dir):
    """Raw rows per day that a load would still take in: those of days not done yet."""
    stages = Stages(spark, sf_dir)
    done = days_done(stages.run_log, "silver_transactions").withColumnRenamed("process_date", "date")
    return count_by(stages.bronze.join(done, "date", "left_anti"), "row_count", "date")
