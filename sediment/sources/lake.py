"""Where the lake's tables live and how they are read and replaced.

Daily tables are partitioned by ``date`` and replaced a set of days at a time. Whole-table
results (accounts, codes, marts) are written to a new directory per run; the run log says which
run is current, so readers switch over when the log row is appended and never see a half-written
table, and a table can be rebuilt from its own current version.

Silver transactions are also bucketed by transaction id. Every increment has to look its ids up
among all ids ever promoted; with buckets only the new ids are shuffled, and the stored ids are
read bucket by bucket. Beside the data lies a sketch of the ids of every day and bucket, so that
only those files are opened that can hold one of the new ids.

How many buckets there are is a layout of silver. A lake can get another one (``plans.layout``): its
days are written once more under another folder, and the run log says when that becomes the one in
use. Until then, and for readers that began before, the old files stay as they are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment import schemas
from sediment.operators.membership import groups_that_may_hold, sketches
from sediment.sources.commits import CommitLog
from sediment.sources.files import exists, matching, qualified, remove

DAILY = {
    "bronze_transactions": ("bronze/transactions", schemas.BRONZE_TRANSACTIONS),
    "bronze_accounts": ("bronze/accounts", schemas.BRONZE_ACCOUNTS),
    "silver_transactions": ("silver/transactions", schemas.SILVER_TRANSACTIONS),
    "silver_quarantine": (
        "silver/quarantine/entity=transactions",
        schemas.QUARANTINE_TRANSACTIONS,
    ),
    "silver_accounts_quarantine": (
        "silver/quarantine/entity=accounts",
        schemas.QUARANTINE_ACCOUNTS,
    ),
}
SNAPSHOTS = {
    "bronze_transaction_codes": ("bronze/transaction_codes", schemas.BRONZE_CODES),
    "silver_transaction_codes": ("silver/transaction_codes", schemas.SILVER_CODES),
    "silver_accounts": ("silver/accounts", schemas.SILVER_ACCOUNTS),
    "gold_daily_summary": ("gold/daily_summary", schemas.GOLD_DAILY),
    "gold_weekly_account_summary": ("gold/weekly_account_summary", schemas.GOLD_WEEKLY),
}
#: What the rows of a mart are sorted by.
ORDERED = {
    "gold_daily_summary": ["transaction_date"],
    "gold_weekly_account_summary": ["account_id", "week_start_date"],
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    # A limit of zero is known to be empty to the optimizer, which then leaves it out of unions.
    return spark.createDataFrame([], schema).limit(0)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under ``path`` with the given schema; no rows when nothing was written yet."""
    if not exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


SKETCHES = "silver/id_sketches"
#: Beyond so many files of silver that can hold new ids, whole days are read instead of single files.
MOST_FILES = 50_000
BUCKETED = "silver_transactions"
BUCKET_KEY = "transaction_id"
SKETCHED = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("size", T.LongType()),
        T.StructField("bits", T.ArrayType(T.LongType())),
        T.StructField("date", T.DateType()),
    ]
)
LAYOUT = T.StructType([T.StructField("id_buckets", T.IntegerType())])
#: A row with a day says that the day is written in that layout, one without that all of them are.
LAYOUT_LOG = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("id_buckets", T.IntegerType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("process_date", T.DateType()),
    ]
)
LAYOUT_MODEL = "silver_layout"


def _quoted(text: str) -> str:
    """``text`` inside single quotes of SQL."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


class LakeError(RuntimeError):
    """What is stored is not what the log or the catalog says."""


@dataclass(frozen=True)
class Layout:
    """One way silver is cut into files; version 0 is the one it was first written in."""

    version: int
    id_buckets: int

    def suffix(self) -> str:
        return f"_v{self.version}" if self.version else ""


class Lake:
    """Tables under ``root``, which may be relative to the working folder.

    ``id_buckets`` is fixed when silver is first written, and read back from then on;
    ``plans.layout.change_layout`` changes it. Choose it so that a bucket of one day makes a file of a
    reasonable size; a few thousand suit a lake of 100 TB. Unless given it is the session's number of
    shuffle partitions, so that the lookup of new ids has as many tasks as any other shuffle.

    A lake looks at silver as it is laid out in ``layout``, by default the one in use when silver is
    first looked at. It keeps to that one, also if another one comes into use.
    """

    def __init__(
        self, spark: SparkSession, root: str, id_buckets: int | None = None, layout: Layout | None = None
    ) -> None:
        self.spark, self.root = spark, qualified(spark, root).rstrip("/")
        self._id_buckets = id_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._declared = False
        if layout is not None:
            self.layout = layout

    @cached_property
    def layout(self) -> Layout:
        """The layout of silver that is in use."""
        if exists(self.spark, self.layouts.folder):
            runs = CommitLog(self.spark, f"{self.root}/pipeline/log", schemas.RUN_LOG).read()
            used = runs.where(f"model_name = '{LAYOUT_MODEL}' AND status = 'SUCCESS'").select("run_id")
            whole = self.layouts.read().where("process_date IS NULL").join(used.distinct(), "run_id", "left_semi")
            latest = whole.agg(F.max(F.struct("version", "id_buckets")).alias("latest")).first()["latest"]
            if latest is not None:
                return Layout(latest["version"], latest["id_buckets"])
        stored = read_or_empty(self.spark, self._layout_path(), LAYOUT).first()
        return Layout(0, stored["id_buckets"] if stored else self._id_buckets)

    @cached_property
    def layouts(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/pipeline/layouts", LAYOUT_LOG)

    def folder(self, name: str) -> str:
        """Where a daily table lies."""
        path, _ = DAILY[name]
        return f"{self.root}/{path}{self.layout.suffix() if name == BUCKETED else ''}"

    def sketch_folder(self) -> str:
        return f"{self.root}/{SKETCHES}{self.layout.suffix()}"

    def _is_bucketed(self) -> bool:
        """Whether silver has been written at all, in this layout."""
        return self.layout.version > 0 or exists(self.spark, self._layout_path())

    def days(self, name: str, dates: list[date]) -> DataFrame:
        """The given days of a daily table; other partitions are not opened."""
        _, schema = DAILY[name]
        if name == BUCKETED and self._is_bucketed():
            table = self.spark.table(self._bucketed_table())
        else:
            table = read_or_empty(self.spark, self.folder(name), schema)
        return table.where(F.col("date").isin(dates))

    def require_days(self, name: str, dates: set[date]) -> None:
        """Raise unless each of the days, known to have rows, can be seen."""
        found = matching(self.spark, f"{self.folder(name)}/date=*") if dates else []
        seen = {version.rsplit("=", 1)[-1] for version in found}
        if name == BUCKETED and dates:
            listed = self.spark.sql(f"SHOW PARTITIONS {self._bucketed_table()}").collect()  # one per day
            seen &= {row[0].rsplit("=", 1)[-1] for row in listed}
        lost = sorted(str(day) for day in dates if str(day) not in seen)
        if lost:
            raise LakeError(f"{name}: committed days are not to be found: {', '.join(lost)}")

    # --- ids of silver transactions

    def _id_rows(self, dates: list[date]) -> DataFrame:
        """Silver of the days, to look at its ids.

        What is grouped or joined by id is read bucket by bucket, a task each, unless a shuffle has more
        tasks than there are buckets: then files are read as they come and ids are shuffled.
        """
        if self.id_buckets() >= int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            return self.days(BUCKETED, dates)
        rows = read_or_empty(self.spark, self.folder(BUCKETED), DAILY[BUCKETED][1])
        return rows.where(F.col("date").isin(dates))

    def _bucket(self) -> Column:
        """The hash that buckets are made by."""
        return F.pmod(F.hash(BUCKET_KEY), F.lit(self.id_buckets()))

    def sketch_days(self, dates: list[date]) -> None:
        """Write the sketches of the ids stored for the days; those of other days stay."""
        ids = self._id_rows(dates).select("date", BUCKET_KEY, self._bucket().alias("bucket"))
        found = sketches(ids, "date", "bucket", BUCKET_KEY).hint("rebalance", F.col("date"))
        found.select("bucket", "size", "bits", "date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("date").parquet(self.sketch_folder())

    def files_that_may_hold(self, ids: DataFrame, dates: list[date]) -> DataFrame:
        """(``date``, ``bucket``) of silver's files on the days that can hold any of ``ids``."""
        stored = self.spark.read.schema(SKETCHED).parquet(self.sketch_folder())
        wanted = ids.select(BUCKET_KEY, self._bucket().alias("bucket"))
        return groups_that_may_hold(stored.where(F.col("date").isin(dates)), wanted, "date", "bucket", BUCKET_KEY)

    def stored_ids(self, ids: DataFrame, dates: list[date]) -> DataFrame:
        """Ids stored on the days, of all files that can hold any of ``ids``; other files are not opened.

        The names of such files come to the driver, which lists the files of a table anyway. A day
        without sketches, from before there were any, is read whole.
        """
        known = {p.rstrip("/").rsplit("=", 1)[-1] for p in matching(self.spark, f"{self.sketch_folder()}/date=*")}
        sketched = [day for day in dates if str(day) in known]
        whole = [day for day in dates if str(day) not in known]
        if not sketched:
            return self._id_rows(dates).select(BUCKET_KEY)
        found = self.files_that_may_hold(ids, sketched).limit(MOST_FILES + 1).collect()
        days = sorted({row["date"] for row in found} | set(whole))
        table = self._id_rows(days)
        if len(found) <= MOST_FILES:
            path = F.col("_metadata.file_path")
            day, bucket = F.regexp_extract(path, "date=([0-9-]+)", 1), F.regexp_extract(path, "_([0-9]+)\\.c[0-9]+", 1)
            names = [f"{row['date']}/{row['bucket']:05d}" for row in found]
            # Of the file's name alone, so that Spark decides it before it opens a file.
            wanted = F.concat(day, F.lit("/"), bucket).isin(names) | day.isin([str(d) for d in whole])
            table = table.where(wanted)
        return table.select(BUCKET_KEY)

    def _layout_path(self) -> str:
        return f"{self.root}/pipeline/layout"

    def id_buckets(self) -> int:
        return self.layout.id_buckets

    def _table_name(self) -> str:
        return "lake_" + hashlib.sha1(self.root.encode()).hexdigest()[:16] + self.layout.suffix()

    def _bucketed_table(self) -> str:
        """Name of silver transactions in the session catalog, where Spark keeps bucketing."""
        name = self._table_name()
        if not self._declared:
            folder, (_, schema) = self.folder(BUCKETED), DAILY[BUCKETED]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (date) "
                f"CLUSTERED BY ({BUCKET_KEY}) INTO {self.id_buckets()} BUCKETS "
                f"LOCATION '{_quoted(folder)}'"
            )
            detail = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
            location = qualified(self.spark, detail.first()["data_type"]).rstrip("/")
            if location != folder:
                raise LakeError(f"{name} is at {location} in the catalog, not at {folder}")
            if exists(self.spark, folder):
                # The catalog may not know days written by other sessions.
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
            self._declared = True
        return name

    def _replace_bucketed(self, rows: DataFrame) -> None:
        if not self._is_bucketed():
            layout = self.spark.range(1).select(F.lit(self.id_buckets()).alias("id_buckets"))
            layout.write.mode("overwrite").parquet(self._layout_path())
        # A bucket of a day meets in one task and makes one file. Adaptive execution merges small
        # pairs of day and bucket and splits large ones.
        spread = rows.withColumn("_bucket", self._bucket()).hint("rebalance", F.col("date"), F.col("_bucket"))
        spread.drop("_bucket").write.insertInto(self._bucketed_table(), overwrite=True)

    def replace_days(self, name: str, rows: DataFrame) -> None:
        """Write whole days, replacing exactly the partitions present in ``rows``."""
        _, schema = DAILY[name]
        if name == BUCKETED:
            self._replace_bucketed(rows.select(*schema.names))
            return
        (
            rows.select(*schema.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(self.folder(name))
        )

    def row_counts(self, name: str, dates: list[date]) -> dict[date, int]:
        """Rows per day, zero for a day without a partition."""
        counts = self.days(name, dates).groupBy("date").count().collect()
        return {day: 0 for day in dates} | {row["date"]: row["count"] for row in counts}

    def snapshot(self, name: str, run_id: str | None) -> DataFrame:
        """The version of a table a run wrote; empty for no run."""
        path, schema = SNAPSHOTS[name]
        if run_id is None:
            return empty(self.spark, schema)
        return read_or_empty(self.spark, f"{self.root}/{path}/run_id={run_id}", schema)

    def write_snapshot(self, name: str, rows: DataFrame, run_id: str) -> None:
        """A new version. Marts are in order over all their files, so the files hold disjoint ranges."""
        path, schema = SNAPSHOTS[name]
        rows = rows.select(*schema.names)
        if name in ORDERED:
            rows = rows.orderBy(*ORDERED[name])
        rows.write.mode("overwrite").parquet(f"{self.root}/{path}/run_id={run_id}")

    def expire_snapshots(self, name: str, keep: list[str]) -> None:
        """Delete all versions of a table but those of the given runs."""
        path, _ = SNAPSHOTS[name]
        for version in matching(self.spark, f"{self.root}/{path}/run_id=*"):
            if version.rsplit("=", 1)[-1] not in keep:
                remove(self.spark, version)

    def clear_days(self, name: str, dates: list[date]) -> None:
        """Delete what an unfinished load left behind for days that were never committed."""
        for day in dates:
            partition = f"{self.folder(name)}/date={day}"
            if exists(self.spark, partition):
                remove(self.spark, partition)
                if name == BUCKETED:
                    remove(self.spark, f"{self.sketch_folder()}/date={day}")
                    self.spark.sql(
                        f"ALTER TABLE {self._bucketed_table()} "
                        f"DROP IF EXISTS PARTITION (date = DATE '{day}')"
                    )

    def drop_layout(self) -> None:
        """Delete silver as it is laid out here; the table of another layout must be in use."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name()}")
        self._declared = False
        for folder in (self.folder(BUCKETED), self.sketch_folder()):
            remove(self.spark, folder)

    def old_layouts(self) -> list[Layout]:
        """The layouts before the one in use that still have files."""
        used = self.layout.version
        known = {} if not used else {r["version"]: r["id_buckets"] for r in self.layouts.read().distinct().collect()}
        first = read_or_empty(self.spark, self._layout_path(), LAYOUT).first() if used else None
        if first:
            known[0] = first["id_buckets"]
        old = [Layout(v, b) for v, b in sorted(known.items()) if v < used]
        path, _ = DAILY[BUCKETED]
        return [one for one in old if exists(self.spark, f"{self.root}/{path}{one.suffix()}")]

    def staging(self, run_id: str) -> str:
        """Run-scoped folder for intermediate tables, on storage every executor can reach."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        return f"{shared or self.root + '/_staging'}/{run_id}"

    def sweep_staging(self, runs: set[str]) -> None:
        """Remove the intermediate tables that runs which died have left."""
        for folder in matching(self.spark, self.staging("*")):
            if folder.rstrip("/").rsplit("/", 1)[-1] in runs:
                remove(self.spark, folder)
