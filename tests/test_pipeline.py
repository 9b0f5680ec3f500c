from __future__ import annotations

import os
import shutil
from collections import Counter
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import extracts
from sediment.operators.contracts import ContractViolation, changed_rows
from sediment.plans import audit, pipeline
from sediment.plans.pipeline import run_historical, run_incremental
from sediment.sources import csvfiles
from sediment.sources.commits import ConcurrentLoad
from sediment.sources.control import Control
from sediment.sources.lake import SNAPSHOTS, Lake, LakeError

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 7)
CLOCKS = ["_promoted_at", "_rejected_at", "_pipeline_run_id", "_computed_at"]


def place(tmp_path):
    return str(extracts.write_week(tmp_path / "source")), str(tmp_path / "lake")


def files(root):
    """Data files of the lake with their modification times."""
    found = Path(root).rglob("*.parquet")
    return {str(p): p.stat().st_mtime_ns for p in found if "_staging" not in p.parts}


def status_counts(control):
    return {r["status"]: r["count"] for r in control.log().groupBy("status").count().collect()}


def days(n=7):
    return [date(2024, 1, d) for d in range(1, n + 1)]


def current(lake, name):
    return lake.snapshot(name, Control(lake).latest_run(name))


@pytest.fixture(scope="module")
def week(spark, tmp_path_factory):
    source, root = place(tmp_path_factory.mktemp("week"))
    run_id = run_historical(spark, source, root, FIRST, LAST)
    return source, root, run_id


def good(n=7):
    return [row for day in list(extracts.WEEK)[:n] for row in extracts.promoted(day)]


ALL_ROWS = sum(map(len, extracts.WEEK.values()))


def test_week_counts(spark, week):
    lake = Lake(spark, week[1])
    assert lake.days("bronze_transactions", days()).count() == ALL_ROWS
    assert lake.days("bronze_accounts", days()).count() == 20
    silver = lake.days("silver_transactions", days())
    flags = {r["_is_resolvable"]: r["count"] for r in silver.groupBy("_is_resolvable").count().collect()}
    assert flags == dict(Counter(row[-1] for row in good()))
    reasons = lake.days("silver_quarantine", days()).groupBy("_rejection_reason").count().collect()
    wanted = Counter(extracts.reason(row) for rows in extracts.WEEK.values() for row in rows)
    assert {tuple(r) for r in reasons} == {(k, n) for k, n in wanted.items() if k}
    assert current(lake, "silver_accounts").count() == 3
    assert current(lake, "silver_transaction_codes").count() == 4
    merchants = {r["merchant_name"] for r in lake.days("bronze_transactions", days()).collect()}
    assert {"Corner, Shop", 'The "Quick" Bite', "Book \\ Nook", "Hats\nand more", None} <= merchants


def test_week_daily(spark, week):
    rows = current(Lake(spark, week[1]), "gold_daily_summary").collect()
    assert len(rows) == 7
    for row in rows:
        known = [r for r in extracts.promoted(str(row["transaction_date"])) if r[-1]]
        assert row["total_transactions"] == len(known)
        assert row["total_signed_amount"] == sum(r[1] for r in known)
        assert row["online_transactions"] == sum(r[3] == "ONLINE" for r in known)
        assert row["instore_transactions"] == sum(r[3] == "IN_STORE" for r in known)
        for code, kind in [*extracts.KINDS.items(), ("REF01", "refunds")]:
            amounts = [r[1] for r in known if r[2] == code]
            assert (row[f"{kind}_count"], row[f"{kind}_amount"]) == (len(amounts), sum(amounts))
    assert {(r["_source_period_start"], r["_source_period_end"]) for r in rows} == {(FIRST, LAST)}


def test_week_by_account(spark, week):
    rows = current(Lake(spark, week[1]), "gold_weekly_account_summary").collect()
    assert {r["account_id"] for r in rows} == set(extracts.BALANCES)
    for row in rows:
        by_code = {
            code: [r[1] for r in good() if r[-1] and r[0] == row["account_id"] and r[2] == code]
            for code in extracts.KINDS
        }
        assert row["total_purchases"] == len(by_code["PURCH01"])
        mean = float(sum(by_code["PURCH01"])) / len(by_code["PURCH01"])
        assert row["avg_purchase_amount"] == pytest.approx(mean)
        for code, name in (("PAY01", "payments"), ("FEE01", "fees"), ("INT01", "interest")):
            assert row[f"total_{name}"] == (sum(by_code[code]) if by_code[code] else None)
        assert row["closing_balance"] == extracts.BALANCES[row["account_id"]][-1]
    assert {(r["week_start_date"], r["week_end_date"]) for r in rows} == {(FIRST, LAST)}


def test_week_log(spark, week):
    control = Control(Lake(spark, week[1]))
    assert status_counts(control) == {"SUCCESS": 46}
    assert control.watermark() == LAST
    totals = {
        r["model_name"]: (r["p"], r["w"], r["r"])
        for r in control.log()
        .groupBy("model_name")
        .agg(
            F.sum("records_processed").alias("p"),
            F.sum("records_written").alias("w"),
            F.sum("records_rejected").alias("r"),
        )
        .collect()
    }
    assert totals["silver_transactions"] == (ALL_ROWS, len(good()), ALL_ROWS - len(good()))
    assert totals["silver_accounts"] == (20, 20, 0)
    assert totals["gold_daily_summary"] == (sum(row[-1] for row in good()), 7, None)
    assert {r["run_id"] for r in control.log().select("run_id").distinct().collect()} == {week[2]}


def test_contracts_hold(spark, week):
    source, root, _ = week
    broken = {n: df.count() for n, df in audit.violations(spark, root).items()}
    assert {n: c for n, c in broken.items() if c} == {}
    assert audit.schema_problems(spark, root) == {}
    assert audit.flag_violations(spark, root).isEmpty()
    assert audit.incomplete_files(spark, source, root).isEmpty()
    assert audit.rerun_differences(spark, root).isEmpty()


def test_rerun_then_increments(spark, tmp_path):
    source, root = place(tmp_path)
    lake = Lake(spark, root)
    control = Control(lake)
    first = run_historical(spark, source, root, FIRST, date(2024, 1, 3))
    assert control.watermark() == date(2024, 1, 3)
    landed = {p: t for p, t in files(root).items() if "/bronze/" in p}
    partial = lake.days("silver_transactions", days(3)).collect()

    # Resuming over a longer range leaves finished days alone.
    run_historical(spark, source, root, FIRST, date(2024, 1, 6))
    assert status_counts(control)["SKIPPED"] == 2 + 3 * 6
    assert control.watermark() == date(2024, 1, 6)
    assert landed.items() <= files(root).items()
    assert sorted(lake.days("silver_transactions", days(3)).collect()) == sorted(partial)

    # A finished range run again only rebuilds the marts; the mark stays.
    before = current(lake, "gold_daily_summary")
    silver_before = lake.days("silver_transactions", days()).collect()
    run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    assert control.watermark() == date(2024, 1, 6)
    assert changed_rows(before, current(lake, "gold_daily_summary"), CLOCKS).isEmpty()
    assert sorted(lake.days("silver_transactions", days()).collect()) == sorted(silver_before)

    # The next day arrives: eight log rows, the mark moves by one.
    logged = control.log().count()
    assert run_incremental(spark, source, root) is not None
    assert control.log().count() == logged + 8
    assert control.watermark() == LAST
    assert lake.days("silver_transactions", days()).count() == len(good())

    # Nothing left to do: nothing is written.
    before_files = files(root)
    assert run_incremental(spark, source, root) is None
    assert files(root) == before_files

    # The current and the previous version of a table are kept, older ones are gone.
    for name in ("gold_daily_summary", "silver_accounts"):
        path, _ = SNAPSHOTS[name]
        assert len(list(Path(root, path).glob("run_id=*"))) == 2
    assert lake.snapshot("gold_daily_summary", first).isEmpty()
    assert current(lake, "gold_daily_summary").count() == 7


def test_increment_copies_are_duplicates_or_misdated(spark, tmp_path):
    """A file that repeats another day's rows promotes none of them."""
    source, root = place(tmp_path)
    bad = extracts.account_line("K-19", 1, status="PENDING")
    extracts.write_accounts(
        Path(source), "2024-01-01", [*extracts.account_lines("2024-01-01"), bad]
    )
    run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    day = "2024-01-03"
    old = extracts.transaction_lines("2024-01-01")[:2]
    fresh = extracts.transaction_lines(day)[:1]
    extracts.write_transactions(Path(source), day, old + fresh + fresh)
    (Path(source) / f"accounts_{day}.csv").unlink()
    run_incremental(spark, source, root)
    lake = Lake(spark, root)
    today = [date(2024, 1, 3)]
    assert lake.days("silver_transactions", today).count() == 1
    reasons = [r["_rejection_reason"] for r in lake.days("silver_quarantine", today).collect()]
    assert reasons == ["DUPLICATE_TRANSACTION_ID"] * 3
    # Rejects of both entities are kept side by side.
    first_day = [FIRST]
    assert lake.days("silver_accounts_quarantine", first_day).count() == 1
    assert lake.days("silver_quarantine", first_day).count() == 1
    # No accounts file means no change to the accounts.
    assert current(lake, "silver_accounts").count() == 3


def test_increment_needs_a_mark(spark, tmp_path):
    source, root = place(tmp_path)
    with pytest.raises(RuntimeError, match="high-water mark"):
        run_incremental(spark, source, root)


def test_missing_transactions_file(spark, tmp_path):
    source, root = place(tmp_path)
    (Path(source) / "transactions_2024-01-02.csv").unlink()
    with pytest.raises(FileNotFoundError, match="2024-01-02"):
        run_historical(spark, source, root, FIRST, date(2024, 1, 3))
    control = Control(Lake(spark, root))
    failed = control.log().where("status = 'FAILED'").collect()
    assert [(r["model_name"], str(r["process_date"])) for r in failed] == [
        ("bronze_transactions", "2024-01-02")
    ]
    assert control.watermark() is None


def test_file_without_rows(spark, tmp_path):
    source, root = place(tmp_path)
    extracts.write_transactions(Path(source), "2024-01-02", [])
    with pytest.raises(ContractViolation, match="2024-01-02"):
        run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    assert Control(Lake(spark, root)).watermark() is None


def test_account_twice_in_one_delta_publishes_nothing(spark, tmp_path):
    """Checked before anything is visible, and a corrected file lets the load go on."""
    source, root = place(tmp_path)
    day = "2024-01-02"
    extracts.write_accounts(Path(source), day, extracts.account_lines(day) * 2)
    with pytest.raises(ContractViolation, match="twice"):
        run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    lake = Lake(spark, root)
    control = Control(lake)
    assert control.done("silver_transactions") == set()
    assert control.latest_run("silver_accounts") is None
    assert control.watermark() is None
    counts = status_counts(control)
    assert counts["FAILED"] == 4 and counts["SKIPPED"] == 4


def test_empty_code_table(spark, tmp_path):
    source, root = place(tmp_path)
    (Path(source) / "transaction_codes.csv").write_text(extracts.CODES.splitlines()[0] + "\n")
    with pytest.raises(ContractViolation, match="no rows"):
        run_historical(spark, source, root, FIRST, FIRST)


def test_crash_before_commit_can_be_run_again(spark, tmp_path, monkeypatch):
    """Dying between publishing and logging must not change what the next run decides."""
    source, root = place(tmp_path)
    publish = pipeline.Load._publish

    def publish_then_die(self, *args):
        publish(self, *args)
        raise OSError("executor lost")

    monkeypatch.setattr(pipeline.Load, "_publish", publish_then_die)
    with pytest.raises(OSError):
        run_historical(spark, source, root, FIRST, LAST)
    lake = Lake(spark, root)
    control = Control(lake)
    assert control.latest_run("silver_accounts") is None
    assert {
        (r["model_name"], r["status"])
        for r in control.log().where("layer = 'SILVER' and process_date is not null").collect()
    } == {
        ("silver_transactions", "FAILED"),
        ("silver_quarantine", "FAILED"),
        ("silver_accounts", "SKIPPED"),
        ("silver_accounts_quarantine", "SKIPPED"),
    }
    monkeypatch.undo()
    # A smaller range comes first and takes ids that the dead load had published for day 7, so
    # nothing of day 7 is promoted now and its left-over partition must not come back.
    taken = [f"{id},K-10,2024-01-06,1.00,PURCH01,,ONLINE" for id in
             [line.split(",")[0] for line in extracts.transaction_lines("2024-01-07")]]
    day_six = extracts.transaction_lines("2024-01-06")
    shutil.rmtree(Path(root) / "bronze" / "transactions" / "date=2024-01-06")
    extracts.write_transactions(Path(source), "2024-01-06", day_six + taken)
    landed = csvfiles.read_transactions(
        spark, [f"{source}/transactions_2024-01-06.csv"], "test", "2024-02-01 00:00:00"
    )
    lake.replace_days("bronze_transactions", landed)
    run_historical(spark, source, root, FIRST, date(2024, 1, 6))
    run_historical(spark, source, root, FIRST, LAST)
    assert lake.days("silver_transactions", [LAST]).isEmpty()
    assert lake.days("silver_quarantine", [LAST]).count() == len(taken)
    silver = lake.days("silver_transactions", days())
    assert silver.count() == len(good(6)) + len(taken)
    assert silver.where("_is_resolvable").count() == sum(r[-1] for r in good(6)) + len(taken)
    assert audit.flag_violations(spark, root).isEmpty()
    assert control.watermark() == LAST


def test_lost_rows_stop_the_load(spark, tmp_path, monkeypatch):
    source, root = place(tmp_path)
    tag = pipeline.tag_transactions
    monkeypatch.setattr(
        pipeline, "tag_transactions", lambda *a, **k: tag(*a, **k).where("channel <> 'IN_STORE'")
    )
    with pytest.raises(ContractViolation, match="lost"):
        run_historical(spark, source, root, FIRST, FIRST)
    assert Lake(spark, root).days("silver_transactions", days()).isEmpty()


def test_staging_uses_the_shared_folder(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert lake.staging("r1") == f"{named or lake.root + '/_staging'}/r1"
    for setting, folder in (("/shared", "/shared"), (None, f"{lake.root}/_staging")):
        conf = SimpleNamespace(get=lambda key, default, value=setting: value or default)
        monkeypatch.setattr(lake, "spark", SimpleNamespace(conf=conf))
        assert lake.staging("r1") == f"{folder}/r1"


def test_relative_root_in_two_sessions(spark, tmp_path, monkeypatch):
    """A root that is relative to the working folder gives the tables an absolute one gives."""
    source, root = place(tmp_path)
    work = tmp_path / "work"
    work.mkdir()
    # The folder the session resolves relative paths against is the JVM's, so lead there from it.
    relative = os.path.relpath(work / "lake", spark._jvm.java.lang.System.getProperty("user.dir"))
    for one in (relative, root):
        run_historical(spark, source, one, FIRST, date(2024, 1, 2))
        name = Lake(spark, one)._bucketed_table()
        spark.sql(f"DROP TABLE {name}")  # what another session's catalog knows
        run_incremental(spark.newSession(), source, one)
    assert (work / "lake" / "silver" / "transactions").exists()
    for name in ("silver_transactions", "silver_quarantine"):
        one, other = (Lake(spark, r).days(name, days(3)) for r in (relative, root))
        assert one.count() == other.count() > 0
        assert changed_rows(one, other, [*CLOCKS, "_bronze_ingested_at"]).isEmpty()
    for name in ("gold_daily_summary", "gold_weekly_account_summary"):
        one, other = (current(Lake(spark, r), name) for r in (relative, root))
        assert one.count() == other.count() and changed_rows(one, other, CLOCKS).isEmpty()
    assert audit.rerun_differences(spark, root).isEmpty()


def test_lost_days_stop_a_load(spark, tmp_path):
    source, root = place(tmp_path)
    run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    shutil.rmtree(Path(root, "silver", "transactions", "date=2024-01-01"))
    with pytest.raises(LakeError, match="2024-01-01"):
        run_incremental(spark, source, root)


def test_errors_are_logged_whole_and_staging_is_removed(spark, tmp_path, monkeypatch):
    source, root = place(tmp_path)
    text = "x" * 10_000

    def die(self, *args):
        raise OSError(text)

    monkeypatch.setattr(pipeline.Load, "_check_split", die)
    with pytest.raises(OSError):
        run_historical(spark, source, root, FIRST, FIRST)
    lake = Lake(spark, root)
    control = Control(lake)
    messages = {r["error_message"] for r in control.log().where("status = 'FAILED'").collect()}
    assert messages == {text}
    for run in control.runs():
        assert not Path(lake.staging(run).removeprefix("file:")).exists()


def test_increment_reads_only_changed_days_for_the_marts(spark, tmp_path, monkeypatch):
    source, root = place(tmp_path)
    run_historical(spark, source, root, FIRST, date(2024, 1, 5))
    asked = []
    read = Lake.days
    monkeypatch.setattr(Lake, "days", lambda self, name, dates: asked.append((name, dates)) or read(self, name, dates))
    load = pipeline.Load(spark, source, root, "INCREMENTAL")
    load.marts(load.codes(), F.current_timestamp())
    assert asked == [("silver_transactions", [])] * 2
    monkeypatch.undo()
    for _ in range(2):
        run_incremental(spark, source, root)
    assert audit.rerun_differences(spark, root).isEmpty()
    assert current(Lake(spark, root), "gold_daily_summary").count() == 7


def test_the_second_of_two_loads_stops_before_it_changes_a_table(spark, tmp_path):
    source, root = place(tmp_path)
    run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    one, two = (pipeline.Load(spark, source, root, "INCREMENTAL") for _ in range(2))
    one.claim()
    before = files(root)
    with pytest.raises(ConcurrentLoad, match=one.run_id):
        two.claim()
    assert files(root) == before
    day = [date(2024, 1, 3)]
    one.load_bronze(day)
    one.load_silver(day)
    assert Control(Lake(spark, root)).done("silver_transactions") == set(days(3))


def test_a_load_that_was_overtaken_does_not_publish(spark, tmp_path):
    """A load that seemed dead goes on after another has begun: it changes nothing any more."""
    source, root = place(tmp_path)
    run_historical(spark, source, root, FIRST, date(2024, 1, 2))
    slow = pipeline.Load(spark, source, root, "INCREMENTAL")
    slow.claim()
    slow.load_bronze([date(2024, 1, 3)])
    run_incremental(spark, source, root)
    before = files(root)
    with pytest.raises(ConcurrentLoad):
        slow.load_silver([date(2024, 1, 3)])
    with pytest.raises(ConcurrentLoad):
        slow.load_gold()
    assert files(root) == before
    lake = Lake(spark, root)
    silver = lake.days("silver_transactions", days())
    assert silver.select("_pipeline_run_id").distinct().count() == 2
    failed = Control(lake).log().where("status = 'FAILED'").collect()
    assert {r["run_id"] for r in failed} == {slow.run_id}
    assert audit.rerun_differences(spark, root).isEmpty()


def test_log_files_stay_as_many(spark, tmp_path):
    """What a lookup opens does not grow with the number of loads."""
    source, root = place(tmp_path)
    run_historical(spark, source, root, FIRST, FIRST)
    control = Control(Lake(spark, root))
    control.entries.every = 10
    load = pipeline.Load(spark, source, root, "INCREMENTAL")
    for _ in range(60):
        control.append(load.skipped(["silver_transactions"], [LAST]))
        assert len(control.entries.files()) <= 11
    assert control.log().where("status = 'SKIPPED'").count() == 60
    assert control.done("silver_transactions") == {FIRST}
