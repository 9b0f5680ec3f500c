"""Queries over a lake that is loaded, file by file, from the given tables.

The tables are written as the daily CSV extracts they stand for, and these are loaded as a lake is over
its life: a load that fails, a historical load of the first half, an increment, a load over the whole
range that goes on where the others ended, and an increment without a new file. What the queries
return is read from the files of the lake.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.plans.audit import flag_violations, incomplete_files, rerun_differences, violations
from sediment.plans.layout import change_layout
from sediment.plans.pipeline import run_historical, run_incremental
from sediment.plans.queries import SPLIT, query
from sediment.schemas import ACCOUNT_SOURCE, TRANSACTION_SOURCE
from sediment.sources import testtables as given
from sediment.sources.control import Control
from sediment.sources.files import matching, move_new, qualified, remove
from sediment.sources.lake import Lake

CLOCKS = ["_ingested_at", "_bronze_ingested_at", "_promoted_at", "_rejected_at", "_record_valid_from", "_computed_at"]
#: Extracts and lake by application and folder of the tables.
_LOADED: dict[tuple[str, str], tuple[str, str]] = {}
_CHANGED: dict[tuple[str, str], str] = {}
#: Buckets a day of the lake whose layout changes, before and after.
BUCKETS = (3, 8)
#: Tasks that write extracts; as many days in a row go to different ones.
WRITERS = 256


def work_folder(spark: SparkSession) -> str:
    """A new folder on the cluster's shared storage; of this machine for a local session only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lake-")
    return qualified(spark, f"{shared.rstrip('/')}/lake-{uuid.uuid4().hex}")


def dealt_by_day(rows: DataFrame) -> DataFrame:
    """A day to a task, by the day's number: hashes of a few days would put several of them into one task."""
    return rows.repartitionById(WRITERS, F.pmod(F.unix_date("date"), F.lit(WRITERS)))


def write_daily(rows: DataFrame, folder: str, entity: str, names: list[str]) -> None:
    """One CSV file per day, its rows in the order of their position.

    A day's extract is one file by its format, so one task writes it, row after row from a sort that can spill.
    """
    spark, parts = rows.sparkSession, f"{folder}/_{entity}"
    in_order = dealt_by_day(rows).sortWithinPartitions("date", "_row_ordinal")
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    in_order.select(*names, "date").write.partitionBy("date").options(**plain).csv(parts)
    for path in matching(spark, f"{parts}/date=*/*.csv"):
        day = path.rsplit("date=", 1)[1].split("/")[0]
        if not move_new(spark, path, f"{folder}/{entity}_{day}.csv"):
            raise FileExistsError(f"{entity} of {day} is in more than one file")
    remove(spark, parts)


def write_extracts(spark: SparkSession, sf_dir: str, folder: str) -> None:
    transactions = given.bronze_transactions(spark, sf_dir)
    write_daily(transactions, folder, "transactions", TRANSACTION_SOURCE.names)
    write_daily(given.bronze_accounts(spark, sf_dir), folder, "accounts", ACCOUNT_SOURCE.names)
    codes = given.reference_codes(spark).coalesce(1)
    codes.write.option("header", True).csv(f"{folder}/_codes")
    (path,) = matching(spark, f"{folder}/_codes/*.csv")
    move_new(spark, path, f"{folder}/transaction_codes.csv")
    remove(spark, f"{folder}/_codes")


def loaded(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The folders of the extracts and of the lake, which is loaded on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        folder = work_folder(spark)
        source, root = f"{folder}/extracts", f"{folder}/lake"
        write_extracts(spark, sf_dir, source)
        days = given.bronze_transactions(spark, sf_dir).agg(F.min("date"), F.max("date"))
        first, last = days.first()
        try:
            run_historical(spark, source, root, first - timedelta(days=1), first)
        except FileNotFoundError:  # there is no extract for the day before
            pass
        else:
            raise AssertionError("a load without its file must fail")
        run_historical(spark, source, root, first, SPLIT - timedelta(days=1))
        run_incremental(spark, source, root)
        run_historical(spark, source, root, first, last)
        if run_incremental(spark, source, root) is not None:
            raise AssertionError("there is no file to load")
        _LOADED[key] = source, root
    return _LOADED[key]


def changed(spark: SparkSession, sf_dir: str) -> str:
    """A lake of the same extracts that gets more buckets a day between its first two loads."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHANGED:
        source, _ = loaded(spark, sf_dir)
        root = f"{work_folder(spark)}/lake"
        first, last = given.bronze_transactions(spark, sf_dir).agg(F.min("date"), F.max("date")).first()
        run_historical(spark, source, root, first, SPLIT - timedelta(days=1), id_buckets=BUCKETS[0])
        change_layout(spark, root, BUCKETS[1])
        run_incremental(spark, source, root)
        run_historical(spark, source, root, first, last)
        _CHANGED[key] = root
    return _CHANGED[key]


def stored(spark: SparkSession, sf_dir: str) -> tuple[Lake, Control, list[date]]:
    lake = Lake(spark, loaded(spark, sf_dir)[1])
    control = Control(lake)
    return lake, control, sorted(control.done("silver_transactions"))


def with_kind(rows: DataFrame, control: Control, model: str) -> DataFrame:
    """``rows`` with the kind of the load that logged the run they were written by, and without clocks.

    All rows share a few run ids, so dealt by them they would meet in as few tasks; the runs, one row a load, go to the rows.
    """
    runs = control.succeeded(model).select(F.col("run_id").alias("_pipeline_run_id"), "pipeline_type").distinct()
    named = rows.join(F.broadcast(runs), "_pipeline_run_id", "left")
    return named.drop("_pipeline_run_id", "_row_ordinal", *CLOCKS)


@query
def lake_bronze_transactions(spark, sf_dir):
    lake, control, days = stored(spark, sf_dir)
    return with_kind(lake.days("bronze_transactions", days), control, "bronze_transactions")


@query
def lake_silver_transactions(spark, sf_dir):
    lake, control, days = stored(spark, sf_dir)
    return with_kind(lake.days("silver_transactions", days), control, "silver_transactions")


@query
def lake_silver_in_new_layout(spark, sf_dir):
    """Silver of a lake that was loaded on after its number of buckets had changed."""
    lake = Lake(spark, changed(spark, sf_dir))
    control = Control(lake)
    days = sorted(control.done("silver_transactions"))
    rows = with_kind(lake.days("silver_transactions", days), control, "silver_transactions")
    return rows.withColumn("id_buckets", F.lit(lake.id_buckets()))


@query
def lake_quarantine(spark, sf_dir):
    lake, control, days = stored(spark, sf_dir)
    return with_kind(lake.days("silver_quarantine", days), control, "silver_quarantine")


@query
def lake_accounts(spark, sf_dir):
    lake, control, _ = stored(spark, sf_dir)
    rows = lake.snapshot("silver_accounts", control.latest_run("silver_accounts"))
    return rows.drop("_pipeline_run_id", "_row_ordinal", *CLOCKS)


@query
def lake_daily_summary(spark, sf_dir):
    lake, control, _ = stored(spark, sf_dir)
    rows = lake.snapshot("gold_daily_summary", control.latest_run("gold_daily_summary"))
    return rows.drop("_pipeline_run_id", *CLOCKS)


@query
def lake_weekly_account_summary(spark, sf_dir):
    lake, control, _ = stored(spark, sf_dir)
    name = "gold_weekly_account_summary"
    return lake.snapshot(name, control.latest_run(name)).drop("_pipeline_run_id", *CLOCKS)


@query
def lake_log(spark, sf_dir):
    """What the loads logged, the failure and the skipped models included."""
    _, control, _ = stored(spark, sf_dir)
    counts = ["records_processed", "records_written", "records_rejected"]
    keys = ["pipeline_type", "model_name", "layer", "status", "process_date", *counts]
    failed = F.count("error_message").alias("errors")
    return control.log().groupBy(*keys).agg(F.count(F.lit(1)).alias("entries"), failed)


@query
def lake_marks(spark, sf_dir):
    """Every high-water mark, in the order in which the loads set them."""
    _, control, _ = stored(spark, sf_dir)
    return control.marks.read().select("last_processed_date")


@query
def lake_violations(spark, sf_dir):
    """Rows that break a contract, by contract."""
    source, root = loaded(spark, sf_dir)
    found = violations(spark, root)
    found |= {
        "account_flags": flag_violations(spark, root),
        "incomplete_files": incomplete_files(spark, source, root),
        "rerun_differences": rerun_differences(spark, root),
    }
    counts = [df.agg(F.count("*").alias("violations")).withColumn("contract", F.lit(n)) for n, df in found.items()]
    return reduce(DataFrame.unionByName, counts)
