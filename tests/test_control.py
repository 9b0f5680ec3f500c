from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from sediment.operators.contracts import invalid_log_rows
from sediment.sources.control import Control, LogEntry, now
from sediment.sources.lake import Lake


def entry(**changes):
    at = now()
    base = LogEntry("r1", "HISTORICAL", "silver_transactions", "SILVER", at, at, "SUCCESS")
    return replace(base, **changes)


def test_mark_moves_forward_only(spark, tmp_path):
    control = Control(Lake(spark, str(tmp_path)))
    assert control.watermark() is None
    assert control.current().count() == 0
    control.advance(date(2024, 1, 5), "r1")
    for day in (date(2024, 1, 5), date(2024, 1, 4)):
        with pytest.raises(ValueError, match="forward"):
            control.advance(day, "r2")
    control.advance(date(2024, 1, 6), "r2")
    rows = control.current().collect()
    assert [(r["last_processed_date"], r["updated_by_run_id"]) for r in rows] == [
        (date(2024, 1, 6), "r2")
    ]


def test_log_is_append_only(spark, tmp_path):
    control = Control(Lake(spark, str(tmp_path)))
    assert control.log().count() == 0
    control.append([entry(records_written=3, process_date=date(2024, 1, 1))])
    before = control.log().collect()
    control.append([entry(run_id="r2", process_date=date(2024, 1, 2)), entry(status="FAILED")])
    after = control.log().collect()
    assert len(after) == 3 and all(row in after for row in before)
    assert control.done("silver_transactions") == {date(2024, 1, 1), date(2024, 1, 2)}
    assert control.done("silver_transactions", with_rows=True) == {date(2024, 1, 1)}
    assert invalid_log_rows(control.log()).isEmpty()


@pytest.mark.parametrize("change", [{"status": "DONE"}, {"run_id": None}, {"completed_at": None}])
def test_bad_entries_are_refused(change):
    with pytest.raises(ValueError):
        entry(**change)


def test_latest_run(spark, tmp_path):
    control = Control(Lake(spark, str(tmp_path)))
    assert control.latest_run("silver_accounts") is None
    control.append([entry(model_name="silver_accounts", run_id="old")])
    control.append([entry(model_name="silver_accounts", run_id="new")])
    control.append([entry(model_name="silver_accounts", run_id="bad", status="FAILED")])
    assert control.latest_run("silver_accounts") == "new"
