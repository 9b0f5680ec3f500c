"""Historical and incremental loads.

All days of a load are processed together, one Spark plan per table, not day by day. Results
are checked before they are published and become visible when their SUCCESS rows are logged, so
a load that dies anywhere can simply be run again. Two loads of one lake cannot both publish: a
load claims its place in the log before it changes anything, and stops when another has done so since.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sediment.functions.dates import days_between
from sediment.operators import contracts
from sediment.operators.contracts import ContractViolation, require_empty
from sediment.operators.dedup import existing_ids, tag_transactions
from sediment.operators.lookup import known_accounts
from sediment.operators.rules import REASON, accepted, check_accounts, check_transactions
from sediment.operators.upsert import upsert_accounts
from sediment.plans import gold, silver
from sediment.sources import csvfiles
from sediment.sources.control import Control, LogEntry, now, utc_seconds
from sediment.sources.files import remove
from sediment.sources.lake import SNAPSHOTS, Lake

HISTORICAL, INCREMENTAL = "HISTORICAL", "INCREMENTAL"
CODE_MODELS = ["bronze_transaction_codes", "silver_transaction_codes"]
BRONZE_MODELS = ["bronze_transactions", "bronze_accounts"]
ACCOUNT_MODELS = ["silver_accounts", "silver_accounts_quarantine"]
TRANSACTION_MODELS = ["silver_transactions", "silver_quarantine"]
DAY_MODELS = BRONZE_MODELS + ACCOUNT_MODELS + TRANSACTION_MODELS
GOLD_MODELS = ["gold_daily_summary", "gold_weekly_account_summary"]


class Load:
    """One run over a set of days."""

    def __init__(
        self,
        spark: SparkSession,
        source_dir: str,
        root: str,
        kind: str,
        id_buckets: int | None = None,
    ) -> None:
        self.spark, self.source_dir, self.kind = spark, source_dir, kind
        self.lake = Lake(spark, root, id_buckets)
        self.control = Control(self.lake)
        self.run_id = str(uuid.uuid4())
        #: What the load decides is decided on the log as it was here.
        self.since = self.control.entries.latest()
        self.claimed: int | None = None

    # --- one load at a time

    def claim(self) -> None:
        """Announce the load; stops if another one has begun since this one looked at the log.

        Call it before the first change. A load that died leaves a claim, which the next one voids.
        """
        self.claimed = self.control.entries.claim(self.run_id, self.since)

    def hold(self) -> None:
        """Stop, before a table is changed, if another load has begun after this one."""
        if self.claimed is not None:
            self.control.entries.require(self.claimed)

    def commit(self, entries: list[LogEntry]) -> None:
        """Log SUCCESS rows, unless another load has begun: that is decided in the same step."""
        self.control.append(entries, self.claimed)

    # --- logging

    def entry(
        self,
        model: str,
        status: str,
        started: datetime,
        day: date | None = None,
        counts: tuple[int | None, ...] = (None, None, None),
        error: str | None = None,
    ) -> LogEntry:
        layer = model.split("_", 1)[0].upper()
        return LogEntry(
            self.run_id, self.kind, model, layer, started, now(), status, *counts, error, day
        )

    def skipped(self, models: list[str], days: list[date | None]) -> list[LogEntry]:
        at = now()
        return [self.entry(model, "SKIPPED", at, day) for day in days for model in models]

    @contextmanager
    def step(
        self, models: list[str], days: list[date | None], downstream: list[str]
    ) -> Iterator[datetime]:
        """Log FAILED for the step's models and SKIPPED for those after it if it raises."""
        started = now()
        try:
            yield started
        except Exception as error:
            message = str(error)
            failed = [
                self.entry(m, "FAILED", started, d, error=message) for d in days for m in models
            ]
            self.control.append(failed + self.skipped(downstream, days))
            raise

    # --- codes

    def codes(self) -> DataFrame:
        """The current code table, checked to be usable for promotion."""
        name = "silver_transaction_codes"
        with self.step([name], [None], []):
            current = self.lake.snapshot(name, self.control.latest_run(name))
            if current.isEmpty():
                raise ContractViolation("transaction codes are empty: nothing can be promoted")
        return current

    def load_codes(self) -> None:
        """Load the static code table unless an earlier run already did."""
        raw_run = self.control.latest_run("bronze_transaction_codes")
        silver_run = self.control.latest_run("silver_transaction_codes")
        promoted = self.lake.snapshot("silver_transaction_codes", silver_run)
        if raw_run and not promoted.isEmpty():
            self.control.append(self.skipped(CODE_MODELS, [None]))
            return
        name = "bronze_transaction_codes"
        with self.step([name], [None], []) as started:
            if raw_run is None or self.lake.snapshot(name, raw_run).isEmpty():
                raw_run = self.run_id
                rows = csvfiles.read_codes(
                    self.spark, self.source_dir, self.run_id, utc_seconds(started)
                )
                self.hold()
                self.lake.write_snapshot(name, rows, raw_run)
            bronze = self.lake.snapshot(name, raw_run)
            loaded = bronze.count()
            if loaded == 0:
                raise ContractViolation("transaction_codes.csv holds no rows")
            # A version is found under its own run's SUCCESS row.
            if raw_run == self.run_id:
                self.commit([self.entry(name, "SUCCESS", started, counts=(loaded, loaded, None))])
        name = "silver_transaction_codes"
        with self.step([name], [None], ACCOUNT_MODELS + TRANSACTION_MODELS) as started:
            require_empty(
                contracts.duplicate_keys(bronze, "transaction_code"), "codes are not unique"
            )
            self.hold()
            self.lake.write_snapshot(name, silver.promote_codes(bronze, self.run_id), self.run_id)
            written = self.lake.snapshot(name, self.run_id).count()
            if written == 0:
                raise ContractViolation("silver transaction codes are empty after promotion")
            self.commit([self.entry(name, "SUCCESS", started, counts=(loaded, written, None))])

    # --- raw layer

    def load_bronze(self, days: list[date]) -> None:
        """Land the days' files unchanged. Days landed before are left untouched."""
        span = (days[0], days[-1])
        files = {
            "bronze_transactions": self.files("transactions", *span),
            "bronze_accounts": self.files("accounts", *span),
        }
        missing = [d for d in days if d not in files["bronze_transactions"]]
        with self.step(["bronze_transactions"], missing, []):
            if missing:
                raise FileNotFoundError(
                    f"no transactions file for {', '.join(map(str, missing))}"
                )
        readers = {
            "bronze_transactions": csvfiles.read_transactions,
            "bronze_accounts": csvfiles.read_accounts,
        }
        for name, reader in readers.items():
            with self.step([name], days, []) as started:
                landed = self.control.done(name, with_rows=True)
                fresh = [d for d in days if d in files[name] and d not in landed]
                if fresh:
                    paths = [files[name][d] for d in fresh]
                    rows = reader(self.spark, paths, self.run_id, utc_seconds(started))
                    self._land(name, rows, fresh)
                counts = self.lake.row_counts(name, days)
                self.commit(
                    [
                        self.entry(name, "SUCCESS", started, d, (counts[d], counts[d], None))
                        for d in days
                    ]
                )

    def files(self, entity: str, start: date, end: date) -> dict[date, str]:
        return csvfiles.daily_files(self.spark, self.source_dir, entity, start, end)

    def _land(self, name: str, rows: DataFrame, days: list[date]) -> None:
        """Write and read back: every file must yield rows and none may get lost."""
        self.hold()
        read = Observation(f"{name} {self.run_id}")
        self.lake.replace_days(name, rows.observe(read, F.count(F.lit(1)).alias("rows")))
        counts = self.lake.row_counts(name, days)
        blank = [str(d) for d in days if counts[d] == 0]
        if blank:
            raise ContractViolation(f"{name}: no rows for {', '.join(blank)}")
        if sum(counts.values()) != read.get["rows"]:
            raise ContractViolation(f"{name}: {read.get['rows']} rows read, {counts} stored")

    # --- silver layer

    def load_silver(self, days: list[date]) -> None:
        """Promote the days' rows and commit accounts and transactions together."""
        codes = self.codes()
        with self.step(ACCOUNT_MODELS, days, TRANSACTION_MODELS) as started_accounts:
            committed = self.committed_days(set(days))
            stored_accounts = self.lake.snapshot(
                "silver_accounts", self.control.latest_run("silver_accounts")
            )
            deltas = check_accounts(self.lake.days("bronze_accounts", days))
            account_entries = self._accounts(deltas, stored_accounts, days, started_accounts)
        with self.step(TRANSACTION_MODELS, days, ACCOUNT_MODELS) as started:
            bronze = self.lake.days("bronze_transactions", days)
            known = known_accounts(accepted(deltas), stored_accounts)
            checked = check_transactions(bronze, codes)
            stored = None
            if committed:
                stored = self.lake.stored_ids(existing_ids(accepted(checked)), committed)
            tagged = tag_transactions(checked, known, stored)
            try:
                staged = self._stage(tagged)
                counts = self._check_split(bronze, staged)
                self._publish(staged, days, counts)
            finally:
                remove(self.spark, self.lake.staging(self.run_id))
            entries = list(account_entries)
            for day in days:
                raw, good, bad = counts.get(day, (0, 0, 0))
                entries.append(
                    self.entry("silver_transactions", "SUCCESS", started, day, (raw, good, bad))
                )
                entries.append(
                    self.entry("silver_quarantine", "SUCCESS", started, day, (bad, bad, None))
                )
            self.commit(entries)

    def committed_days(self, without: set[date]) -> list[date]:
        """Days whose transactions are promoted, after a check that all with rows can be read."""
        name = "silver_transactions"
        self.lake.require_days(name, self.control.done(name, with_rows=True) - without)
        return sorted(self.control.done(name) - without)

    def _accounts(
        self, deltas: DataFrame, stored: DataFrame, days: list[date], started: datetime
    ) -> list[LogEntry]:
        require_empty(
            contracts.duplicate_keys(accepted(deltas), "date", "account_id"),
            "an account occurs twice in one delta",
        )
        promoted = silver.promote_accounts(deltas, self.run_id)
        self.hold()
        self.lake.write_snapshot("silver_accounts", upsert_accounts(promoted, stored), self.run_id)
        self.lake.clear_days("silver_accounts_quarantine", days)
        self.lake.replace_days(
            "silver_accounts_quarantine", silver.quarantine_accounts(deltas, self.run_id)
        )
        per_day = (
            deltas.groupBy("date")
            .agg(F.count(F.lit(1)).alias("raw"), F.count(REASON).alias("bad"))
            .collect()
        )
        counts = {row["date"]: (row["raw"], row["bad"]) for row in per_day}
        entries = []
        for day in days:
            raw, bad = counts.get(day, (0, 0))
            entries.append(
                self.entry("silver_accounts", "SUCCESS", started, day, (raw, raw - bad, bad))
            )
            entries.append(
                self.entry("silver_accounts_quarantine", "SUCCESS", started, day, (bad, bad, None))
            )
        return entries

    def _stage(self, tagged: DataFrame) -> DataFrame:
        """Write the outcome of every row once; both tables are cut from this one copy."""
        path = f"{self.lake.staging(self.run_id)}/tagged"
        outcome = F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected")
        rows = tagged.withColumn("_outcome", outcome)
        rows.write.mode("overwrite").partitionBy("_outcome").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _check_split(
        self, bronze: DataFrame, staged: DataFrame
    ) -> dict[date, tuple[int, int, int]]:
        """Every raw row must have exactly one outcome. Returns rows per day and layer."""
        good = staged.where(F.col("_outcome") == "accepted")
        bad = staged.where(F.col("_outcome") == "rejected")
        counts = contracts.outcome_counts(bronze, good, bad).collect()
        gaps = [row.asDict() for row in counts if row["gap"] != 0]
        if gaps:
            raise ContractViolation(f"rows lost or multiplied on the way to silver: {gaps}")
        return {r["date"]: (r["bronze"], r["silver"], r["quarantine"]) for r in counts}

    def _publish(self, staged: DataFrame, days: list[date], counts: dict) -> None:
        good = staged.where(F.col("_outcome") == "accepted")
        bad = staged.where(F.col("_outcome") == "rejected")
        parts = {
            "silver_transactions": silver.promote_transactions(good, self.run_id),
            "silver_quarantine": silver.quarantine_transactions(bad, self.run_id),
        }
        for position, (name, rows) in enumerate(parts.items(), start=1):
            if name == "silver_quarantine":
                # Files of even size per day: hot days are split, quiet days share a task.
                rows = rows.hint("rebalance", F.col("date"))
            self.hold()
            self.lake.clear_days(name, days)
            self.lake.replace_days(name, rows)
            stored = self.lake.row_counts(name, days)
            expected = {day: counts.get(day, (0, 0, 0))[position] for day in days}
            if stored != expected:
                raise ContractViolation(f"{name}: expected {expected}, stored {stored}")
        self.lake.sketch_days(days)

    # --- marts

    def load_gold(self) -> None:
        """Publish both marts: days committed since the current version, and the weeks they fall
        in, are computed; all others are taken from that version, whose rows cannot have changed.
        """
        codes = self.codes()
        with self.step(GOLD_MODELS, [None], []) as started:
            results = self.marts(codes, F.lit(started))
            self.hold()
            for name, rows in results.items():
                self.lake.write_snapshot(name, rows, self.run_id)
            stored = {name: self.lake.snapshot(name, self.run_id) for name in results}
            used = stored["gold_daily_summary"].agg(
                F.coalesce(F.sum("total_transactions"), F.lit(0)).alias("rows")
            )
            processed = used.first()["rows"]
            self.commit(
                [
                    self.entry(n, "SUCCESS", started, counts=(processed, df.count(), None))
                    for n, df in stored.items()
                ]
            )

    def marts(self, codes: DataFrame, at: Column) -> dict[str, DataFrame]:
        """The new versions; transactions are read of changed days and of their weeks only."""
        name = "silver_transactions"
        days = self.committed_days(set())
        before = {model: self.control.latest_run(model) for model in GOLD_MODELS}
        since = self.control.latest_start(GOLD_MODELS[0])
        whole = since is None or None in before.values()
        changed = days if whole else sorted(self.control.done_since(name, since))
        weeks = sorted({day - timedelta(days=day.weekday()) for day in changed})
        in_weeks = [day for day in days if day - timedelta(days=day.weekday()) in set(weeks)]
        old_daily, old_weekly = (self.lake.snapshot(m, before[m]) for m in GOLD_MODELS)
        accounts = self.lake.snapshot("silver_accounts", self.control.latest_run("silver_accounts"))
        daily = gold.daily_rows(self.lake.days(name, changed))
        weekly = gold.weekly_rows(self.lake.days(name, in_weeks), codes)
        if not whole:
            daily = gold.replaced(old_daily, daily, "transaction_date", changed)
            weekly = gold.replaced(old_weekly, weekly, "week_start_date", weeks)
        return {
            "gold_daily_summary": gold.finish_daily(daily, self.run_id, at),
            "gold_weekly_account_summary": gold.finish_weekly(weekly, accounts, self.run_id, at),
        }

    def tidy(self, keep: int) -> None:
        """Drop versions of whole tables older than the ``keep`` latest ones, and layouts out of use."""
        self.hold()
        for old in self.lake.old_layouts():
            Lake(self.spark, self.lake.root, layout=old).drop_layout()
        for name, runs in self.control.recent_runs(list(SNAPSHOTS), keep).items():
            self.lake.expire_snapshots(name, runs)
        self.lake.sweep_staging(self.control.runs())


def run_historical(
    spark: SparkSession,
    source_dir: str,
    root: str,
    start: date,
    end: date,
    id_buckets: int | None = None,
    keep: int = 2,
) -> str:
    """Load every day of the closed range that is not loaded yet; returns the run id.

    ``id_buckets`` counts only for the first load into ``root``, see ``Lake``. Of whole tables the
    ``keep`` latest versions stay.
    """
    load = Load(spark, source_dir, root, HISTORICAL, id_buckets)
    load.claim()
    load.load_codes()
    load.codes()
    days = days_between(start, end)
    done = load.control.done("silver_transactions")
    load.control.append(load.skipped(DAY_MODELS, [d for d in days if d in done]))
    pending = [d for d in days if d not in done]
    if pending:
        load.load_bronze(pending)
        load.load_silver(pending)
    load.load_gold()
    mark = load.control.watermark()
    if mark is None or mark < end:
        load.hold()
        load.control.advance(end, load.run_id)
    load.tidy(keep)
    return load.run_id


def run_incremental(
    spark: SparkSession, source_dir: str, root: str, keep: int = 2
) -> str | None:
    """Load the day after the high-water mark; None, and nothing written, if it has no file."""
    load = Load(spark, source_dir, root, INCREMENTAL)
    mark = load.control.watermark()
    if mark is None:
        raise RuntimeError("no high-water mark: run a historical load first")
    day = mark + timedelta(days=1)
    if day not in load.files("transactions", day, day):
        return None
    load.claim()
    load.codes()
    if day in load.control.done("silver_transactions"):
        load.control.append(load.skipped(DAY_MODELS, [day]))
    else:
        load.load_bronze([day])
        load.load_silver([day])
    load.load_gold()
    load.hold()
    load.control.advance(day, load.run_id)
    load.tidy(keep)
    return load.run_id
