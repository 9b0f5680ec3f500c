"""Plans and skew: what must hold before the data is large."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import frames
from sediment.operators import contracts
from sediment.operators.dedup import promoted_transactions, tag_transactions, verdicts
from sediment.operators.lookup import known_accounts, resolve_accounts
from sediment.operators.rules import accepted, check_accounts, check_transactions, rejected
from sediment.plans import gold, silver
from sediment.plans.loaded import dealt_by_day, with_kind

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of all rows are copies of one id; a third belong to one account."""
    n = 30_000
    line = F.col("id")
    hot = line % 3 == 0
    file_day = F.date_add(F.lit("2024-01-01").cast("date"), (line % 5).cast("int"))
    return spark.range(n).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), line.cast("string"))).alias("transaction_id"),
        F.when(line % 3 == 1, "A-HOT")
        .otherwise(F.concat(F.lit("A"), (line % 500).cast("string")))
        .alias("account_id"),
        file_day.alias("transaction_date"),
        F.lit(10).cast("decimal(18,4)").alias("amount"),
        F.lit("PURCH01").alias("transaction_code"),
        F.lit(None).cast("string").alias("merchant_name"),
        F.lit("ONLINE").alias("channel"),
        F.concat(F.lit("transactions_"), file_day.cast("string"), F.lit(".csv")).alias("_source_file"),
        F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")).alias("_ingested_at"),
        F.lit("r").alias("_pipeline_run_id"),
        F.struct(F.lit(0).cast("long").alias("block"), line.alias("line")).alias("_row_ordinal"),
        file_day.alias("date"),
    )


@pytest.fixture(scope="module")
def known(spark):
    rows = [frames.account(0, "A-HOT", file_day=3)]
    rows += [frames.account(n + 1, f"A{n}") for n in range(250)]
    return known_accounts(accepted(check_accounts(frames.accounts(spark, rows))))


def test_hot_id_keeps_one_row_and_loses_none(spark, lopsided, known):
    tagged = tag_transactions(check_transactions(lopsided, frames.codes(spark)), known)
    good, bad = accepted(tagged), rejected(tagged)
    assert good.where("transaction_id = 'HOT'").count() == 1
    first = good.where("transaction_id = 'HOT'").first()
    assert first["_row_ordinal"]["line"] == 0
    assert bad.count() == 9_999
    assert good.count() == 20_001
    assert good.where("account_id = 'A-HOT' and _is_resolvable").count() == 6_000


def test_hot_id_is_grouped_before_it_is_shuffled(spark, lopsided, known):
    """No shuffle by id may carry more than one row per map task, id and day."""
    text = plan(verdicts(check_transactions(lopsided, frames.codes(spark)), known))
    below_shuffle = text[text.index("Exchange hashpartitioning(date") :]
    assert "partial_min" in below_shuffle
    assert "Window" not in below_shuffle


def test_full_rows_are_joined_on_their_position(spark, lopsided, known):
    text = plan(tag_transactions(check_transactions(lopsided, frames.codes(spark)), known))
    join = re.search(r"SortMergeJoin \[([^\]]*)\]", text).group(1)
    assert "_row_ordinal" in join and "date" in join and "transaction_id" not in join


def test_raw_rows_are_scanned_twice_and_rejected_rows_are_not_shuffled(spark, lopsided, known, tmp_path):
    lopsided.write.parquet(f"{tmp_path}/raw")
    checked = check_transactions(spark.read.schema(lopsided.schema).parquet(f"{tmp_path}/raw"), frames.codes(spark))
    tagged, promoted = tag_transactions(checked, known), promoted_transactions(checked, known)
    for df in (tagged, promoted):
        assert plan(df).count("FileScan") == 2 and "Union" not in plan(df)
    assert tagged.count() == checked.count() and promoted.count() == accepted(tagged).count()
    both = contracts.outcome_counts_of(checked, tagged)
    assert plan(both).count("FileScan") == 3
    alone = contracts.outcome_counts(checked, accepted(tagged), rejected(tagged))
    assert sorted(both.collect()) == sorted(alone.select(*both.columns).collect())
    assert re.search(r"SortMergeJoin \[date[^\]]*\], \[[^\]]*\], Inner", plan(promoted))


def test_hot_account_is_split_when_the_dimension_is_large(spark, lopsided, known):
    """Without a broadcast, adaptive execution must split the hot account's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = lopsided.repartition(8).select("account_id", "date", "_row_ordinal")
        flagged = resolve_accounts(rows, known)
        flags = {r["_is_resolvable"] for r in flagged.select("_is_resolvable").collect()}
        result = flagged.groupBy("_is_resolvable").count()
        counts = {r["_is_resolvable"]: r["count"] for r in result.collect()}
        resolved = resolve_accounts(rows, known)
        resolved.collect()
        text = plan(resolved)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert flags == {True, False} and sum(counts.values()) == 30_000
    assert "skew=true" in text


def test_marts_pre_aggregate(spark, lopsided, known):
    tagged = tag_transactions(check_transactions(lopsided, frames.codes(spark)), known)
    promoted = silver.promote_transactions(tagged, "r")
    text = plan(gold.daily_summary(promoted, "r"))
    assert "partial_sum" in text and "partial_count" in text
    accounts = spark.createDataFrame([("A-HOT", 1)], "account_id string, current_balance int")
    weekly = gold.weekly_account_summary(promoted, frames.codes(spark), accounts, "r")
    assert "partial_sum" in plan(weekly)


def test_scans_read_only_what_they_need(spark):
    text = plan(driver.queries()["run_log_status_counts"](spark, DATA))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {"event_id:bigint,ts:timestamp_ntz"} or schemas == {
        "event_id:bigint,ts:timestamp"
    }


def test_stored_days_are_pruned(spark, tmp_path, lopsided):
    from sediment.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    lake.replace_days("bronze_transactions", lopsided)
    day = [frames.day(2)]
    text = plan(lake.days("bronze_transactions", day).select("transaction_id"))
    assert re.search(r"PartitionFilters: \[.*date.*2024-01-02", text)
    assert "ReadSchema: struct<transaction_id:string>" in text
    assert lake.days("bronze_transactions", day).count() == 6_000


def test_stored_ids_are_not_shuffled(spark, tmp_path, lopsided, known):
    """Looking new ids up among all stored ones moves the new ids only."""
    from sediment.sources.lake import Lake

    root = str(tmp_path)
    checked = check_transactions(lopsided, frames.codes(spark))
    tagged = tag_transactions(checked, known)
    Lake(spark, root, id_buckets=6).replace_days(
        "silver_transactions", silver.promote_transactions(tagged, "r")
    )
    lake = Lake(spark, root, id_buckets=99)  # the number of buckets is read back
    days = [frames.day(d) for d in range(1, 5)]
    stored = lake.days("silver_transactions", days).select("transaction_id")
    assert stored.count() == 16_001
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = checked.where(F.col("date") == F.lit(frames.day(5)))
        outcome = verdicts(new, known, stored)
        text = plan(outcome)
        reasons = {r["_verdict"]: r["count"] for r in outcome.groupBy("_verdict").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in text
    scan = text.index("Bucketed: true")
    join = text.rindex("SortMergeJoin [transaction_id", 0, scan)
    stored_side = text[text.index("+- Sort [transaction_id", join) : scan]
    assert "Exchange" not in stored_side
    assert reasons == {None: 4_000, "DUPLICATE_TRANSACTION_ID": 1}


def test_files_of_a_mart_hold_disjoint_ranges(spark, tmp_path):
    """The weekly mart is in order over all its files, each account's weeks side by side."""
    from sediment.schemas import GOLD_WEEKLY
    from sediment.sources.lake import Lake

    keys = {
        "account_id": F.concat(F.lit("A-"), (F.col("id") * 7919 % 500).cast("string")),
        "week_start_date": F.date_add(F.lit(frames.day(1)), (F.col("id") % 8 * 7).cast("int")),
    }
    wide = [keys.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in GOLD_WEEKLY]
    weeks = spark.range(4_000).select(*wide)
    lake, name, setting = Lake(spark, str(tmp_path)), "gold_weekly_account_summary", "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        lake.write_snapshot(name, weeks, "r")
    finally:
        spark.conf.set(setting, before)
    files = sorted((tmp_path / "gold" / "weekly_account_summary" / "run_id=r").glob("*.parquet"))
    parts = [[(r[0], r[1]) for r in spark.read.parquet(str(f)).select(*keys).collect()] for f in files]
    assert len([p for p in parts if p]) > 2 and sum(map(len, parts)) == 4_000
    assert sorted(row for p in parts for row in p) == [row for p in parts for row in p]


def test_extracts_of_different_days_are_written_by_different_tasks(spark):
    rows = spark.range(640).select(F.expr("date_add(DATE '2024-01-01', CAST(id % 32 AS INT))").alias("date"))
    tasks = dealt_by_day(rows).select("date", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == 32 and len({r["task"] for r in tasks}) == 32


def test_rows_of_few_runs_are_not_dealt_by_run(spark):
    class Logged:
        def succeeded(self, model):
            return spark.createDataFrame([("a", "HISTORICAL"), ("b", "INCREMENTAL")], "run_id string, pipeline_type string")

    rows = spark.range(1000).selectExpr("id", "IF(id = 7, 'c', IF(id < 9, 'b', 'a')) AS _pipeline_run_id")
    rows = rows.withColumn("_row_ordinal", F.lit(None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = with_kind(rows, Logged(), "any")
        assert "BroadcastHashJoin" in plan(named) and "SortMergeJoin" not in plan(named)
        kinds = {r["pipeline_type"]: r["count"] for r in named.groupBy("pipeline_type").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kinds == {None: 1, "INCREMENTAL": 8, "HISTORICAL": 991}


def broadcast_columns(df) -> list[str]:
    """What the plan sends to all tasks, one text a broadcast."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*?)\]", df._jdf.queryExecution().explainString(mode))


def test_what_grows_with_the_data_is_not_broadcast_by_contracts(spark, lopsided, known, tmp_path):
    """However small its files are: those of many rows can be, and Spark broadcasts by that size."""
    lopsided.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.schema(lopsided.schema).parquet(f"{tmp_path}/raw")
    columns = ["transaction_id", "account_id", "amount"]
    assert contracts.untraceable(raw, raw, columns).isEmpty()
    assert contracts.untraceable(raw.withColumn("amount", F.lit(11)), raw, columns).count() == 30_000
    accounts = known.select("account_id", F.lit(1).cast("decimal(18,4)").alias("current_balance"))
    held = raw.select("account_id", "transaction_id").join(accounts, "account_id", "left_semi")
    missing = contracts.unbacked_accounts(raw, accounts)
    assert missing.count() == raw.select("account_id").distinct().count() - held.select("account_id").distinct().count() > 0
    weeks = raw.groupBy("account_id").agg(F.min("date").alias("week_start_date"))
    for name in gold.GOLD_WEEKLY.fieldNames():
        if name not in weeks.columns:
            weeks = weeks.withColumn(name, F.lit(1))
    frames_ = [
        contracts.untraceable(raw, raw, columns),
        missing,
        gold.finish_weekly(weeks.drop("closing_balance"), accounts, "r"),
        resolve_accounts(raw.select("account_id", "date"), known),
    ]
    assert [broadcast_columns(df) for df in frames_] == [[]] * 4
