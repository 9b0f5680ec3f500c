"""Numbered commits: order, claims, checkpoints, and what a reader opens."""

from __future__ import annotations

import threading
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import types as T

from sediment.sources.commits import CommitLog, ConcurrentLoad
from sediment.sources.control import Control
from sediment.sources.files import create_new
from sediment.sources.lake import Lake

SCHEMA = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("text", T.StringType()), T.StructField("at", T.TimestampType())]
)
AT = datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)


def numbers(log):
    return sorted(row["n"] for row in log.read().collect())


def test_create_new_once(spark, tmp_path):
    path = f"{tmp_path}/folder/one"
    assert create_new(spark, path, "first é\n") and not create_new(spark, path, "second")
    assert Path(path).read_text() == "first é\n"
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.startswith(".")] == ["one"]


def test_rows_come_back(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", SCHEMA)
    assert log.latest() == 0 and log.read().collect() == []
    assert log.append([(1, 'a "quoted"\nline', AT), (2, None, None)]) == 1
    assert log.append([(3, "é日", AT)]) == 2
    rows = {r["n"]: (r["text"], r["at"]) for r in log.read().collect()}
    assert rows[1][0] == 'a "quoted"\nline' and rows[2] == (None, None) and rows[3][0] == "é日"
    assert rows[1][1].astimezone(timezone.utc) == AT


def test_files_read_stay_as_many(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", SCHEMA, every=4)
    most = []
    for n in range(1, 41):
        log.append([(n, "x", AT)])
        most.append(len(log.files()))
        if n % 13 == 0:
            assert numbers(log) == list(range(1, n + 1))
    assert max(most) <= 5 and numbers(log) == list(range(1, 41))
    kept = [p for p in Path(f"{tmp_path}/log").iterdir() if not p.name.startswith((".", "_"))]
    assert len(kept) <= 2 + 2 * 4
    assert CommitLog(spark, f"{tmp_path}/log", SCHEMA).latest() == 40


def test_a_checkpoint_that_was_not_finished_is_not_read(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", SCHEMA, every=100)
    for n in range(3):
        log.append([(n, "x", AT)])
    (Path(f"{tmp_path}/log") / "_draft-dead").mkdir()
    (Path(f"{tmp_path}/log") / "_draft-dead" / "part-0.parquet").write_bytes(b"broken")
    assert numbers(log) == [0, 1, 2]
    log.compact(log.latest())
    assert numbers(log) == [0, 1, 2] and len(log.files()) == 1


def test_writers_at_once_lose_nothing(spark, tmp_path):
    logs = [CommitLog(spark, f"{tmp_path}/log", SCHEMA, every=1000) for _ in range(4)]

    def write(k):
        for n in range(5):
            logs[k].append([(10 * k + n, "x", AT)])

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert numbers(logs[0]) == sorted(10 * k + n for k in range(4) for n in range(5))
    assert logs[0].latest() == 20


def test_claims(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", SCHEMA)
    log.append([(1, "x", AT)])
    since = log.latest()
    log.append([(2, "what others log is no claim", AT)])
    mine = log.claim("a", since)
    with pytest.raises(ConcurrentLoad, match="load a"):
        log.claim("b", since)
    log.append([(3, "x", AT)], mine)
    # A load that begins later voids the claim of one that has died.
    later = log.claim("c", log.latest())
    with pytest.raises(ConcurrentLoad, match="load c"):
        log.append([(4, "x", AT)], mine)
    log.append([(5, "x", AT)], later)
    assert numbers(log) == [1, 2, 3, 5]


def test_a_claim_that_is_compacted_away_is_void(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", SCHEMA, every=2)
    mine = log.claim("a", 0)
    for n in range(8):
        log.append([(n, "x", AT)])
    with pytest.raises(ConcurrentLoad, match="compacted"):
        log.append([(9, "x", AT)], mine)


def test_rows_of_an_older_lake_are_kept(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = [(date(2024, 1, 5), datetime(2024, 1, 6), "r1")]
    schema = Control(lake).marks.schema
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/pipeline/control")
    control = Control(lake)
    assert control.watermark() == date(2024, 1, 5)
    for day in range(6, 30):
        control.advance(date(2024, 1, day), "r2")
    assert control.watermark() == date(2024, 1, 29)
    assert control.marks.read().count() == 25
