"""Another number of id buckets: same rows, old files readable meanwhile, dead runs gone on with."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import extracts
from sediment.operators.compare import row_surplus
from sediment.plans import audit, layout
from sediment.plans.layout import change_layout, target_layout
from sediment.plans.pipeline import run_historical, run_incremental
from sediment.sources.commits import ConcurrentLoad
from sediment.sources.control import Control
from sediment.sources.lake import BUCKETED, Lake, Layout

FIRST, THIRD = date(2024, 1, 1), date(2024, 1, 3)
DAYS = [date(2024, 1, n) for n in range(1, 6)]


@pytest.fixture
def place(spark, tmp_path):
    source, root = str(extracts.write_week(tmp_path / "extracts")), str(tmp_path / "lake")
    run_historical(spark, source, root, FIRST, THIRD, id_buckets=8)
    return source, root


def silver(lake):
    return lake.days(BUCKETED, DAYS)


def same(left, right):
    return left.count() == right.count() > 0 and row_surplus(left, right, left.columns).isEmpty()


def bucket_numbers(root, folder):
    names = Path(root, "silver", folder).glob("date=*/*.parquet")
    return {int(p.name.split("_")[-1].split(".")[0]) for p in names}


def test_a_lake_goes_on_with_other_buckets(spark, place):
    source, root = place
    old = Lake(spark, root)
    rows = silver(old).collect()
    run = change_layout(spark, root, 64, days_at_once=2)
    new = Lake(spark, root)
    assert (old.layout, new.layout) == (Layout(0, 8), Layout(1, 64))
    # Who looked at the old files before still can.
    assert same(silver(old), silver(new)) and sorted(map(str, silver(old).collect())) == sorted(map(str, rows))
    assert max(bucket_numbers(root, "transactions_v1")) > 8 > max(bucket_numbers(root, "transactions"))
    logged = Control(new).log().where(F.col("run_id") == run).select("model_name", "status", "records_written")
    assert [tuple(r) for r in logged.collect()] == [("silver_layout", "SUCCESS", len(rows))]
    assert change_layout(spark, root, 64) is None

    # An id that is stored in the new layout only is found by its sketches.
    extracts.write_transactions(Path(source), "2024-01-04", [silver_line(rows[0]), *extracts.transaction_lines("2024-01-04")])
    run_incremental(spark, source, root)
    assert not Path(root, "silver", "transactions").exists() and not Path(root, "silver", "id_sketches").exists()
    lake = Lake(spark, root)
    assert lake.days(BUCKETED, DAYS).where(F.col("transaction_id") == rows[0]["transaction_id"]).count() == 1
    again = lake.days("silver_quarantine", DAYS).where(F.col("transaction_id") == rows[0]["transaction_id"])
    assert [r["_rejection_reason"] for r in again.collect()] == ["DUPLICATE_TRANSACTION_ID"]
    assert {n: df.count() for n, df in audit.violations(spark, root).items() if not df.isEmpty()} == {}
    assert audit.schema_problems(spark, root) == {} and audit.rerun_differences(spark, root).isEmpty()


def silver_line(row):
    return f"{row['transaction_id']},{row['account_id']},2024-01-04,{row['amount']},{row['transaction_code']},,{row['channel']}"


def test_a_dead_run_is_gone_on_with(spark, place, monkeypatch):
    _, root = place
    copy, seen = layout.copy_days, []

    def dies(source, target, days):
        seen.append(days)
        if len(seen) == 2:
            raise OSError("lost")
        return copy(source, target, days)

    monkeypatch.setattr(layout, "copy_days", dies)
    with pytest.raises(OSError):
        change_layout(spark, root, 5, days_at_once=1)
    lake = Lake(spark, root)
    assert lake.layout == Layout(0, 8) and target_layout(lake, 5) == (Layout(1, 5), {FIRST})
    assert target_layout(lake, 6) == (Layout(2, 6), set())
    assert change_layout(spark, root, 5, days_at_once=9) is not None
    assert seen[2:] == [[date(2024, 1, 2), THIRD]]
    assert same(silver(lake), silver(Lake(spark, root))) and Lake(spark, root).layout == Layout(1, 5)


def test_a_load_in_between_stops_it(spark, place, monkeypatch):
    source, root = place
    copy = layout.copy_days

    def overtaken(*args):
        done = copy(*args)
        run_incremental(spark, source, root)
        return done

    monkeypatch.setattr(layout, "copy_days", overtaken)
    with pytest.raises(ConcurrentLoad):
        change_layout(spark, root, 5)
    assert Lake(spark, root).layout == Layout(0, 8)
    monkeypatch.setattr(layout, "copy_days", copy)
    before = Lake(spark, root)
    change_layout(spark, root, 5)
    assert same(silver(before), silver(Lake(spark, root)))


def test_changed_rows_are_noticed(spark, place, monkeypatch):
    _, root = place
    replace = Lake.replace_days

    def spoilt(lake, name, rows):
        replace(lake, name, rows.withColumn("merchant_name", F.coalesce("merchant_name", F.lit("?"))))

    monkeypatch.setattr(Lake, "replace_days", spoilt)
    with pytest.raises(layout.ContractViolation, match="2024-01-02, 2024-01-03"):
        change_layout(spark, root, 5)
    assert Lake(spark, root).layout == Layout(0, 8)


@pytest.mark.parametrize("numbers", [(0, 1), (4, 0)])
def test_numbers_must_be_positive(spark, tmp_path, numbers):
    with pytest.raises(ValueError):
        change_layout(spark, str(tmp_path), *numbers)


def test_nothing_stored(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert change_layout(spark, root, 9) is not None
    lake = Lake(spark, root)
    assert lake.id_buckets() == 9 and silver(lake).isEmpty()
