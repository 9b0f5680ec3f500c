from __future__ import annotations

import csv
import random
import re
from datetime import date

import pytest

import extracts
from sediment.sources import csvfiles

DAY = "2024-01-01"


def load(spark, folder, lines, header=extracts.TX_HEADER, **options):
    path = folder / f"transactions_{DAY}.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return csvfiles.read_transactions(spark, [str(path)], "r1", "2024-02-01 00:00:00")


def good(n, amount="1.00", merchant="M"):
    return f"T{n},A,{DAY},{amount},PURCH01,{merchant},ONLINE"


def test_types_and_audit_columns(spark, tmp_path):
    row = load(spark, tmp_path, [good(1, "12.3456", "")]).first()
    assert str(row["amount"]) == "12.3456"
    assert row["transaction_date"] == row["date"] == date(2024, 1, 1)
    assert row["merchant_name"] is None
    assert row["_source_file"] == f"transactions_{DAY}.csv"
    assert row["_pipeline_run_id"] == "r1"
    assert str(row["_ingested_at"]) == "2024-02-01 00:00:00"


def test_quoted_empty_is_null_and_blank_is_kept(spark, tmp_path):
    rows = load(spark, tmp_path, [good(1, merchant='""'), good(2, merchant='" "')]).collect()
    assert {r["transaction_id"]: r["merchant_name"] for r in rows} == {"T1": None, "T2": " "}


def test_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "transaction_codes.csv").write_text(extracts.CODES)
    rows = csvfiles.read_codes(spark, str(tmp_path), "r1", "2024-02-01 00:00:00").collect()
    assert {r["transaction_code"]: r["transaction_type"] for r in rows} == {
        "PURCH01": "PURCHASE",
        "PAY01": "PAYMENT",
        "FEE01": "FEE",
        "INT01": "INTEREST",
    }
    assert all(r["affects_balance"] is True for r in rows)


def test_personal_name_is_dropped(spark, tmp_path):
    extracts.write_accounts(tmp_path, DAY, extracts.account_lines(DAY))
    path = str(tmp_path / f"accounts_{DAY}.csv")
    df = csvfiles.read_accounts(spark, [path], "r1", "2024-02-01 00:00:00")
    assert "customer_name" not in df.columns
    assert df.count() == 2


@pytest.mark.parametrize(
    "line",
    [
        good(1, "abc"),
        good(1, "1.23456"),
        good(1, "123456789012345.00"),
        f"T1,A,2024-13-01,1.00,PURCH01,M,ONLINE",
        f"T1,A,2024,1.00,PURCH01,M,ONLINE",
        f"T1,A,{DAY},1.00,PURCH01,M",
        f"T1,A,{DAY},1.00,PURCH01,M,ONLINE,extra",
    ],
)
def test_bad_values_raise(spark, tmp_path, line):
    with pytest.raises(Exception):
        load(spark, tmp_path, [line]).collect()


def test_strict_without_ansi(spark, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a valid"):
            load(spark, tmp_path, [good(1, "abc")]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_missing_column_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="channel"):
        load(spark, tmp_path, ["T1,A"], header="transaction_id,account_id")


def test_headers_differ_by_file(spark, tmp_path):
    extracts.write_transactions(tmp_path, DAY, [good(1)])
    other = tmp_path / "transactions_2024-01-02.csv"
    other.write_text("account_id,transaction_id,note,transaction_date,amount,transaction_code,"
                     "merchant_name,channel\nA,T2,x,2024-01-02,1.00,PURCH01,M,ONLINE\n")
    paths = [str(tmp_path / f"transactions_{DAY}.csv"), str(other)]
    rows = csvfiles.read_transactions(spark, paths, "r1", "2024-02-01 00:00:00").collect()
    got = {(r["transaction_id"], r["account_id"], r["date"].day, r["channel"]) for r in rows}
    assert got == {("T1", "A", 1, "ONLINE"), ("T2", "A", 2, "ONLINE")}
    assert "note" not in rows[0].asDict()


MERCHANTS = ['"Joe ""The"" Diner"', '"Joe ""The"", Diner"', "ends in \\", '"a\nb"', '"a, b"', '"x\n\n""y"""', "5 inch"]


def test_quotes_and_line_breaks_as_another_reader_takes_them(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = load(spark, tmp_path, [good(n, merchant=m) for n, m in enumerate(MERCHANTS)]).collect()
    path = tmp_path / f"transactions_{DAY}.csv"
    wanted = duckdb.sql(
        f"SELECT transaction_id, merchant_name FROM read_csv('{path}', all_varchar = true, header = true)"
    ).fetchall()
    assert sorted((r["transaction_id"], r["merchant_name"]) for r in rows) == sorted(wanted)
    counted = csvfiles.count_records(spark, [str(path)]).collect()
    assert [tuple(r) for r in counted] == [(path.name, len(MERCHANTS))]


def test_files_are_split_also_with_quoted_line_breaks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        plain = load(spark, tmp_path, [good(n, merchant='"a ""b"""') for n in range(3000)])
        assert plain.rdd.getNumPartitions() > 8
        broken = load(spark, tmp_path, [good(n, merchant='"a\nb"') for n in range(3000)])
        path = str(tmp_path / f"transactions_{DAY}.csv")
        assert csvfiles.with_open_quotes(spark, [path]) == [path]
        assert csvfiles._lines(spark, [path]).rdd.getNumPartitions() > 8
        rows = broken.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    ordered = sorted(rows, key=lambda r: tuple(r["_row_ordinal"]))
    assert [r["transaction_id"] for r in ordered] == [f"T{n}" for n in range(3000)]
    assert {r["merchant_name"] for r in rows} == {"a\nb"} and len({tuple(r["_row_ordinal"]) for r in rows}) == 3000


FIELDS = ['"a\nb"', '"x,\n""y""\n\nz"', "plain", '5" pipe', '"q""\n""r"', '"""\n"""', "", '""', '"long ' + "line\n" * 40 + '"', '"ü\r\né"', '","', 'in "the" middle']


@pytest.mark.parametrize("size, seed, end", [(64, 1, "\n"), (200, 2, "\n"), (97, 3, "\r\n"), (100_000, 4, "\n")])
def test_records_cut_anywhere_are_those_of_one_task(spark, tmp_path, size, seed, end):
    """Against Python's reader, with splits much smaller than records."""
    rng = random.Random(seed)
    lines = [good(n, merchant=rng.choice(FIELDS)) for n in range(120)]
    path = tmp_path / f"transactions_{DAY}.csv"
    with open(path, "w", newline="") as file:
        file.write(end.join([extracts.TX_HEADER, *lines, "", ""]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = csvfiles.read_transactions(spark, [str(path)], "r1", "2024-02-01 00:00:00").collect()
        counted = csvfiles.count_records(spark, [str(path)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = sorted(rows, key=lambda r: tuple(r["_row_ordinal"]))
    with open(path, newline="") as file:
        wanted = [r for r in csv.reader(file) if r][1:]
    assert [r["transaction_id"] for r in rows] == [w[0] for w in wanted]
    assert [r["merchant_name"] for r in rows] == [w[5].replace("\r\n", "\n") or None for w in wanted]
    assert [tuple(r) for r in counted] == [(path.name, 120)]


def test_text_is_not_shuffled_to_find_line_breaks(spark, tmp_path):
    """Only numbers of lines are; of records that run over several lines the pieces meet."""
    rows = load(spark, tmp_path, [good(n, merchant='"a\nb"' if n % 50 == 0 else "M") for n in range(500)])
    text = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)
    assert sent and not [columns for columns in sent if "value#" in columns]
    assert not [columns for columns in re.findall(r"\) Sort\nInput \[\d+\]: \[(.*?)\]", text) if "value#" in columns]


def test_many_long_records_are_not_broadcast(spark, tmp_path, monkeypatch):
    lines = [good(n, merchant=FIELDS[n % len(FIELDS)]) for n in range(60)]
    few = load(spark, tmp_path, lines).collect()
    path = str(tmp_path / f"transactions_{DAY}.csv")
    monkeypatch.setattr(csvfiles, "FEW_LINES", 0)
    many = load(spark, tmp_path, lines).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(many) == 60
    assert [r["records"] for r in csvfiles.count_records(spark, [path]).collect()] == [60]


def test_two_broken_files_and_a_bad_row(spark, tmp_path):
    extracts.write_transactions(tmp_path, DAY, [good(1, merchant='"a\nb"'), good(2)])
    extracts.write_transactions(tmp_path, "2024-01-02", [good(3, merchant='"c\n\nd"'), good(4)])
    paths = [str(tmp_path / f"transactions_2024-01-0{d}.csv") for d in (1, 2)]
    rows = csvfiles.read_transactions(spark, paths, "r1", "2024-02-01 00:00:00").collect()
    assert {(r["transaction_id"], r["merchant_name"], r["_source_file"][-6:]) for r in rows} == {
        ("T1", "a\nb", "01.csv"), ("T2", "M", "01.csv"), ("T3", "c\n\nd", "02.csv"), ("T4", "M", "02.csv")
    }
    for bad in (f"T5,A,{DAY},1.00,PURCH01,M", f"T5,A,{DAY},abc,PURCH01,M,ONLINE", f"T5,A,{DAY},1.00,PURCH01,M,ONLINE,x"):
        with pytest.raises(Exception):
            load(spark, tmp_path, [good(1, merchant='"a\nb"'), bad]).collect()


def test_row_position_follows_the_file(spark, tmp_path):
    """Also when a file is cut into many small splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        df = load(spark, tmp_path, [good(n) for n in range(5000)])
        assert df.rdd.getNumPartitions() > 8
        rows = sorted((tuple(r["_row_ordinal"]), int(r["transaction_id"][1:])) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [n for _, n in rows] == list(range(5000))
    assert len({key for key, _ in rows}) == 5000


def test_listing(spark, tmp_path):
    extracts.write_week(tmp_path)
    (tmp_path / "transactions_notes.csv").write_text("not an extract\n")
    found = csvfiles.daily_files(
        spark, str(tmp_path), "transactions", date(2024, 1, 3), date(2024, 1, 20)
    )
    assert sorted(d.day for d in found) == [3, 4, 5, 6, 7]
    assert csvfiles.daily_files(
        spark, str(tmp_path), "transactions", date(2025, 1, 1), date(2025, 1, 2)
    ) == {}


def test_records_are_counted_without_looking_lines_up(spark, tmp_path):
    """Empty lines count neither outside nor inside quotes; no line is joined with the lines inside quotes."""
    body = [good(1, merchant='"a\n\n\nb"'), "", good(2), "", "", good(3, merchant='"\n"'), good(4), '"T5\n",' + good(5).split(",", 1)[1], ""]
    extracts.write_transactions(tmp_path, DAY, body)
    extracts.write_transactions(tmp_path, "2024-01-02", [good(n) for n in range(7)])
    paths = [str(tmp_path / f"transactions_{day}.csv") for day in (DAY, "2024-01-02")]
    for size in ("64", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            counted = csvfiles.count_records(spark, paths)
            found = {r["_source_file"][-6:]: r["records"] for r in counted.collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert found == {"01.csv": 5, "02.csv": 7}
        assert "LeftAnti" not in counted._jdf.queryExecution().executedPlan().toString()
