"""Another number of id buckets for a lake that is in use.

A bucket of a day is one file, so the number that suited a lake when it was small makes files too
large, or lookups of new ids too coarse, once its days have grown. The stored days are written once
more into a folder of their own, some days at a time, while the lake is read from the old one. What is
written so far is kept as numbered commits, so a run that dies is gone on with by the next. The lake
switches with one row in the run log, in the step that makes sure no load has begun in between.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators.compare import row_digest
from sediment.operators.contracts import ContractViolation
from sediment.plans.pipeline import Load
from sediment.sources.lake import BUCKETED, LAYOUT_MODEL, Lake, Layout

MAINTENANCE = "MAINTENANCE"


def target_layout(lake: Lake, id_buckets: int) -> tuple[Layout, set[date]]:
    """The layout to write, with the days it has already: one a run has left unfinished, or a new one."""
    rows = lake.layouts.read().where(F.col("version") > lake.layout.version)
    begun = {}
    for row in rows.select("version", "id_buckets", "process_date").distinct().collect():  # one per day
        begun.setdefault((row["version"], row["id_buckets"]), set()).add(row["process_date"])
    newest = max(begun, default=(lake.layout.version, None))
    if newest[1] == id_buckets:
        return Layout(*newest), begun[newest] - {None}
    return Layout(newest[0] + 1, id_buckets), set()


def fingerprints(rows: DataFrame) -> DataFrame:
    """Per day the number of rows and two sums of row hashes, which no order or cut of files changes."""
    first, second = (F.sum(h.cast("decimal(20,0)")) for h in row_digest(rows.drop("date").columns))
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), first.alias("first"), second.alias("second"))


def copy_days(source: Lake, target: Lake, days: list[date]) -> int:
    """Write days of silver in the target's layout, and read them back; returns the number of rows."""
    target.clear_days(BUCKETED, days)
    target.replace_days(BUCKETED, source.days(BUCKETED, days))
    # One row per day comes to the driver.
    before, after = (
        {row["date"]: tuple(row)[1:] for row in fingerprints(lake.days(BUCKETED, days)).collect()}
        for lake in (source, target)
    )
    wrong = sorted(str(day) for day in before.keys() | after.keys() if before.get(day) != after.get(day))
    if wrong:
        raise ContractViolation(f"rows were lost or changed in the new layout on {', '.join(wrong)}")
    target.sketch_days(days)
    return sum(rows for rows, *_ in after.values())


def change_layout(spark: SparkSession, root: str, id_buckets: int, days_at_once: int = 16) -> str | None:
    """Give silver ``id_buckets`` buckets a day; None, and nothing written, if it has so many.

    Days are copied ``days_at_once`` at a time. A load that starts meanwhile stops this one, whose
    finished days stay for the next try. The next load deletes the files of the old layout, so a
    reader that began before the switch has until then.
    """
    if id_buckets < 1 or days_at_once < 1:
        raise ValueError("numbers of buckets and of days must be positive")
    if Lake(spark, root).id_buckets() == id_buckets:
        return None
    load = Load(spark, "", root, MAINTENANCE)
    load.claim()
    with load.step([LAYOUT_MODEL], [None], []) as started:
        layout, written = target_layout(load.lake, id_buckets)
        target = Lake(spark, root, layout=layout)
        days = load.committed_days(set())
        with_rows = load.control.done(BUCKETED, with_rows=True)
        rest = [day for day in days if day not in written]
        for at in range(0, len(rest), days_at_once):
            some = rest[at : at + days_at_once]
            load.hold()
            copy_days(load.lake, target, some)
            load.lake.layouts.append([(layout.version, id_buckets, load.run_id, day) for day in some])
        load.hold()
        target.require_days(BUCKETED, with_rows)
        rows = sum(target.row_counts(BUCKETED, sorted(with_rows)).values())
        load.hold()
        load.lake.layouts.append([(layout.version, id_buckets, load.run_id, None)])
        load.commit([load.entry(LAYOUT_MODEL, "SUCCESS", started, counts=(rows, rows, None))])
    return load.run_id
