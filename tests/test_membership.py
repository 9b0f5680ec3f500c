"""Sketches of stored ids: nothing that is there is missed, and files that cannot match stay closed."""

from __future__ import annotations

import re
import shutil
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import extracts
from sediment.operators import membership
from sediment.operators.dedup import stored_flag
from sediment.operators.membership import groups_that_may_hold, may_hold, sketches
from sediment.plans import pipeline
from sediment.plans.pipeline import run_historical, run_incremental
from sediment.sources.control import Control
from sediment.sources.lake import SKETCHES, Lake, LakeError

FIRST = date(2024, 1, 1)


def grouped(spark, n, days=3, buckets=4):
    line = F.col("id")
    return spark.range(n).select(
        (line % days).alias("day"), F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket"), F.concat(F.lit("T"), line.cast("string")).alias("key")
    )


def test_no_stored_id_is_missed(spark):
    ids = grouped(spark, 3000)
    found = sketches(ids, "day", "bucket", "key")
    held = ids.join(found, ["day", "bucket"]).select(may_hold(F.col("bits"), F.col("size"), F.col("key")).alias("held"))
    assert held.where("held").count() == 3000 == held.count()
    assert found.groupBy("day").agg(F.count_distinct("size").alias("n")).where("n > 1").isEmpty()


def test_few_others_pass(spark):
    found = sketches(grouped(spark, 3000), "day", "bucket", "key")
    others = spark.range(20_000).select(F.concat(F.lit("new"), F.col("id").cast("string")).alias("key"))
    asked = others.crossJoin(found).select(may_hold(F.col("bits"), F.col("size"), F.col("key")).alias("held"))
    assert asked.where("held").count() <= 40 and asked.count() == 20_000 * 12


@pytest.mark.parametrize("wanted", [[5], [5, 8, 2999], [4000, 4001], []])
def test_groups_that_may_hold(spark, wanted):
    ids = grouped(spark, 3000)
    asked = spark.createDataFrame([(n,) for n in wanted], "id long")
    asked = asked.select(F.pmod(F.hash("id"), F.lit(4)).alias("bucket"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("key"))
    got = groups_that_may_hold(sketches(ids, "day", "bucket", "key"), asked, "day", "bucket", "key").collect()
    right = ids.join(asked, "key", "left_semi").select("day", "bucket").distinct().collect()
    assert {tuple(r) for r in right} <= {tuple(r) for r in got} and len(got) <= len(right) + 1


def test_nulls_copies_and_no_rows(spark):
    ids = spark.createDataFrame([(1, 1, None), (1, 1, "a"), (1, 1, "a"), (2, 1, None)], "day int, bucket int, key string")
    found = sketches(ids, "day", "bucket", "key")
    assert [(r["day"], r["size"], len(r["bits"])) for r in found.collect()] == [(1, 64, 1)]
    assert groups_that_may_hold(found, ids.where("key IS NULL"), "day", "bucket", "key").isEmpty()
    assert sketches(ids.limit(0), "day", "bucket", "key").isEmpty()


def test_a_hot_id_collapses_before_it_is_shuffled(spark):
    ids = spark.range(1000).select(F.lit(1).alias("day"), F.lit(2).alias("bucket"), F.lit("HOT").alias("key"))
    text = sketches(ids, "day", "bucket", "key")._jdf.queryExecution().executedPlan().toString()
    first = text.rindex("Exchange hashpartitioning(day")
    assert "HashAggregate(keys=[day" in text[first:] and "Python" not in text


@pytest.fixture
def lake(spark, tmp_path):
    source, root = extracts.write_week(tmp_path / "source"), str(tmp_path / "lake")
    run_historical(spark, str(source), root, FIRST, date(2024, 1, 3), id_buckets=64)
    return str(source), root


def data_files(root):
    return sorted(Path(root, "silver", "transactions").rglob("part-*.parquet"))


def spoil(path):
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    path.write_bytes(b"not parquet")


def test_only_files_that_can_match_are_opened(spark, lake):
    """All other files are spoilt: opening one would stop the query."""
    _, root = lake
    table, days = Lake(spark, root), [date(2024, 1, d) for d in (1, 2, 3)]
    ids = table.days("silver_transactions", days).select("transaction_id").orderBy("transaction_id")
    wanted = spark.createDataFrame(ids.limit(2).collect(), ids.schema)
    near = table.files_that_may_hold(wanted, days).collect()
    keep = {(str(r["date"]), r["bucket"]) for r in near}
    files = data_files(root)
    assert 1 <= len(keep) <= 3 < len(files)
    for path in files:
        if (path.parent.name.split("=")[1], int(path.name.split("_")[-1].split(".")[0])) not in keep:
            spoil(path)
    found = table.stored_ids(wanted, days).join(wanted, "transaction_id", "left_semi")
    assert found.distinct().count() == 2
    nothing = spark.createDataFrame([("never seen",)], ids.schema)
    for path in files:
        spoil(path)
    assert table.stored_ids(nothing, days).isEmpty()


def test_increment_opens_no_file_without_its_ids(spark, lake):
    source, root = lake
    before = data_files(root)
    load = pipeline.Load(spark, source, root, "INCREMENTAL")
    load.claim()
    day = [date(2024, 1, 4)]
    load.load_bronze(day)
    fresh = load.lake.days("bronze_transactions", day).select("transaction_id").distinct()
    committed = sorted(load.control.done("silver_transactions"))
    near = {(str(r["date"]), r["bucket"]) for r in load.lake.files_that_may_hold(fresh, committed).collect()}
    spoilt = 0
    for path in before:
        if (path.parent.name.split("=")[1], int(path.name.split("_")[-1].split(".")[0])) not in near:
            spoil(path)
            spoilt += 1
    assert spoilt
    load.load_silver(day)
    assert day[0] in Control(Lake(spark, root)).done("silver_transactions")


def test_days_without_sketches_are_read_whole(spark, lake):
    source, root = lake
    table, days = Lake(spark, root), [date(2024, 1, d) for d in (1, 2, 3)]
    ids = table.days("silver_transactions", days).select("transaction_id")
    wanted = spark.createDataFrame([(r[0],) for r in ids.collect()], "transaction_id string")
    whole = sorted(r[0] for r in table.stored_ids(wanted, days).collect())
    for path in Path(root, SKETCHES, "date=2024-01-02").iterdir():
        path.unlink()
    Path(root, SKETCHES, "date=2024-01-02").rmdir()
    assert sorted(r[0] for r in table.stored_ids(wanted, days).collect()) == whole
    assert run_incremental(spark, source, root) is not None
    assert Path(root, SKETCHES, "date=2024-01-04").exists()


def test_lost_days_still_stop_a_load(spark, lake):
    source, root = lake
    for path in data_files(root):
        if "2024-01-01" in str(path):
            path.unlink()
    Path(root, "silver", "transactions", "date=2024-01-01").rename(Path(root, "silver", "gone"))
    with pytest.raises(LakeError, match="2024-01-01"):
        run_incremental(spark, source, root)


def broadcast_columns(df):
    """What the plan sends to all tasks, one text a broadcast."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*?)\]", df._jdf.queryExecution().explainString(mode))


def test_ids_are_not_broadcast(spark, tmp_path):
    """However small their files are: those of many ids can be, and Spark broadcasts by that size."""
    grouped(spark, 3000).write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    found = sketches(ids, "day", "bucket", "key")
    asked = groups_that_may_hold(found, ids.select("bucket", "key"), "day", "bucket", "key")
    firsts = ids.withColumnRenamed("key", "transaction_id")
    flagged = stored_flag(firsts, firsts.where("day = 1"))
    for df in (found, asked, flagged):
        assert not [columns for columns in broadcast_columns(df) if re.search("key#|transaction_id#", columns)]
    assert asked.count() == 12 and flagged.where("_stored").count() == 1000 and flagged.count() == 3000


def test_sketches_of_many_words(spark, monkeypatch):
    """Words are made in chunks: none is missing, the last chunk included."""
    whole = {tuple(r[:2]): r for r in sketches(grouped(spark, 3000), "day", "bucket", "key").collect()}
    monkeypatch.setattr(membership, "CHUNK", 7)
    cut = {tuple(r[:2]): r for r in sketches(grouped(spark, 3000), "day", "bucket", "key").collect()}
    assert whole == cut and all(len(r["bits"]) == r["size"] // 64 > 7 for r in cut.values())


@pytest.mark.parametrize("id_buckets", [2, 64])
def test_few_buckets_do_not_bound_the_tasks_that_look_ids_up(spark, tmp_path, id_buckets):
    source, root = extracts.write_week(tmp_path / "source"), str(tmp_path / "lake")
    run_historical(spark, str(source), root, FIRST, date(2024, 1, 3), id_buckets=id_buckets)
    table, days = Lake(spark, root), [date(2024, 1, d) for d in (1, 2, 3)]
    ids = table.days("silver_transactions", days).select("transaction_id")
    for unsketched in (False, True):
        wanted = spark.createDataFrame(ids.collect(), ids.schema)
        found = table.stored_ids(wanted, days)
        text = found.distinct()._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange hashpartitioning(transaction_id" in text) == (id_buckets < 4)
        assert sorted(found.collect()) == sorted(ids.collect())
        for day in days:
            shutil.rmtree(Path(root, SKETCHES, f"date={day}"), ignore_errors=True)
