"""High-water mark and run log.

Both are append-only: the current mark is the latest row, so no crash can lose it, and rows in
the log are never rewritten. A SUCCESS row is the commit point of what it describes. Both are
kept as numbered commits (``sources.commits``), among which a load also announces itself.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.schemas import CONTROL, RUN_LOG, RUN_STATUSES
from sediment.sources.commits import CommitLog
from sediment.sources.lake import Lake


def now() -> datetime:
    return datetime.now(timezone.utc)


def utc_seconds(at: datetime) -> str:
    """Naive UTC text in whole seconds, the form audit timestamps are stored in."""
    return at.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass(frozen=True)
class LogEntry:
    run_id: str
    pipeline_type: str
    model_name: str
    layer: str
    started_at: datetime
    completed_at: datetime
    status: str
    records_processed: int | None = None
    records_written: int | None = None
    records_rejected: int | None = None
    error_message: str | None = None
    process_date: date | None = None

    def __post_init__(self) -> None:
        if self.status not in RUN_STATUSES:
            raise ValueError(f"status '{self.status}' is not one of {RUN_STATUSES}")
        for field in RUN_LOG:
            if not field.nullable and getattr(self, field.name) is None:
                raise ValueError(f"{field.name} must not be null")


def succeeded(log: DataFrame, model: str | None = None) -> DataFrame:
    rows = log.where(F.col("status") == "SUCCESS")
    return rows if model is None else rows.where(F.col("model_name") == model)


def days_done(log: DataFrame, model: str) -> DataFrame:
    """``process_date`` of the days a model has succeeded for, each once."""
    return succeeded(log, model).select("process_date").distinct()


def current_runs(log: DataFrame, order: str = "completed_at") -> DataFrame:
    """Per model the run that succeeded last, which is the one whose version is current."""
    return (
        succeeded(log)
        .groupBy("model_name")
        .agg(F.max_by("run_id", order).alias("run_id"), F.max(order).alias(order))
    )


def latest_mark(rows: DataFrame) -> DataFrame:
    """The control row with the latest processed date; no row before the first run."""
    latest = rows.agg(F.max(F.struct(*rows.columns)).alias("latest"))
    return latest.where(F.col("latest").isNotNull()).select("latest.*")


class Control:
    def __init__(self, lake: Lake) -> None:
        self.lake, self.spark = lake, lake.spark
        folder = f"{lake.root}/pipeline"
        self.marks = CommitLog(lake.spark, f"{folder}/marks", CONTROL, before=f"{folder}/control")
        self.entries = CommitLog(lake.spark, f"{folder}/log", RUN_LOG, before=f"{folder}/run_log")

    # --- high-water mark

    def current(self) -> DataFrame:
        return latest_mark(self.marks.read())

    def watermark(self) -> date | None:
        row = self.current().first()
        return row["last_processed_date"] if row else None

    def advance(self, day: date, run_id: str) -> None:
        mark = self.watermark()
        if mark is not None and day <= mark:
            raise ValueError(f"watermark must move forward: {day} is not after {mark}")
        self.marks.append([(day, utc_seconds(now()), run_id)])

    # --- run log

    def log(self) -> DataFrame:
        return self.entries.read()

    def append(self, entries: list[LogEntry], claimed: int | None = None) -> None:
        """Append log rows in one commit, so they appear together or not at all.

        With the number of a load's claim, only if no other load has begun since.
        """
        if entries:
            self.entries.append([tuple(asdict(entry).values()) for entry in entries], claimed)

    def succeeded(self, model: str) -> DataFrame:
        return succeeded(self.log(), model)

    def done(self, model: str, with_rows: bool = False) -> set[date]:
        """Days a model has succeeded for; at most one entry per calendar day."""
        rows = self.succeeded(model)
        if with_rows:
            rows = rows.where(F.col("records_written") > 0)
        return {r["process_date"] for r in rows.select("process_date").distinct().collect()}

    def runs(self) -> set[str]:
        """All runs that have logged anything."""
        return {r["run_id"] for r in self.log().select("run_id").distinct().collect()}

    def done_since(self, model: str, at: datetime) -> set[date]:
        """Days a model has succeeded for at or after a time."""
        rows = self.succeeded(model).where(F.col("completed_at") >= F.lit(at))
        return {r["process_date"] for r in rows.select("process_date").distinct().collect()}

    def latest_start(self, model: str) -> datetime | None:
        """When the run whose version of a table is current started on it."""
        row = self.succeeded(model).agg(F.max_by("started_at", "completed_at").alias("at")).first()
        return row["at"]

    def latest_run(self, model: str) -> str | None:
        """The run whose version of a table is current."""
        row = current_runs(self.log()).where(F.col("model_name") == model).first()
        return row["run_id"] if row else None

    def recent_runs(self, models: list[str], keep: int) -> dict[str, list[str]]:
        """Per model the ``keep`` latest runs that succeeded, at most ``keep`` rows each."""
        newest = Window.partitionBy("model_name").orderBy(F.desc("completed_at"))
        rows = (
            self.log()
            .where(F.col("model_name").isin(models) & (F.col("status") == "SUCCESS"))
            .groupBy("model_name", "run_id")
            .agg(F.max("completed_at").alias("completed_at"))
            .withColumn("age", F.row_number().over(newest))
            .where(F.col("age") <= keep)
            .collect()
        )
        return {m: [r["run_id"] for r in rows if r["model_name"] == m] for m in models}
