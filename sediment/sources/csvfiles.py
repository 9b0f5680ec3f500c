"""Daily CSV extracts: finding them and reading them with fixed types."""

from __future__ import annotations

import csv
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.dates import file_date
from sediment.functions.money import strict
from sediment.functions.text import empty_to_null
from sediment.schemas import ACCOUNT_SOURCE, CODE_SOURCE, TRANSACTION_SOURCE
from sediment.sources.files import first_line, matching, qualified

#: So many lines of records that run over several are broadcast at most: some 100 MB.
FEW_LINES = 1_000_000


def daily_files(
    spark: SparkSession, source_dir: str, entity: str, start: date, end: date
) -> dict[date, str]:
    """Path of each day's extract in the closed range; at most one per calendar day."""
    day = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
    paths = matching(spark, f"{source_dir}/{entity}_{day}.csv")
    found = {date.fromisoformat(path[-len("yyyy-mm-dd.csv") : -len(".csv")]): path for path in paths}
    return {d: path for d, path in found.items() if start <= d <= end}


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([first_line(spark, path)]), ()))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files' lines as they are, with their place: the split they are in and a number that grows.

    ``opens`` tells whether a quoted field is open at a line's end if none was at its beginning,
    ``stays`` whether one is if one was. Quotes count where a field begins, and where they end one;
    a quote amid an unquoted field is a character like any other, two quotes are never an end.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\\r$", "")).otherwise(F.col("value")).alias("value"),
    )
    quoted = F.contains("value", F.lit('"'))  # most lines have none, and are not searched by patterns
    single = F.replace("value", F.lit('""'), F.lit(""))

    def left_open(text: Column) -> Column:
        return F.regexp_replace(text, '(^|,)"[^"]*"', "$1").rlike('(^|,)"')

    closed = F.concat(F.lit("-"), F.regexp_replace(single, '^[^"]*"', ""))
    stays = ~F.contains(single, F.lit('"')) | left_open(closed)
    return lines.withColumns({"opens": quoted & left_open(single), "stays": ~quoted | stays})


def with_open_quotes(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the files in which a quoted field goes on in the next line.

    One pass over the lines; at most one name per file comes back.
    """
    found = _lines(spark, paths).where("opens").select("path").distinct().collect()
    named = {_plain(unquote(r["path"])) for r in found}
    return [path for path in paths if _plain(qualified(spark, path)) in named]


def _followed(rows: DataFrame, window: WindowSpec) -> DataFrame:
    """``rows`` with what happens up to each by its window, from (``opens``, ``stays``).

    A line leaves the state as it is, turns it, or sets it. So the state after a line is what the last
    line that sets it has set (``fixed``; null if there is none: the state at the beginning), turned as
    often as lines have turned it since (``turns``, modulo 2).
    """
    turn = (F.col("opens") & ~F.col("stays")).cast("long")
    all_turns = F.coalesce(F.sum(turn).over(window), F.lit(0))
    rows = rows.withColumn("_turns", all_turns)
    sets = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").cast("long").alias("state"), F.col("_turns")))
    rows = rows.withColumn("_set", F.last(sets, ignorenulls=True).over(window))
    since = F.col("_turns") - F.coalesce("_set._turns", F.lit(0))
    return rows.withColumns({"fixed": F.col("_set.state"), "turns": since % 2}).drop("_turns", "_set")


def _splits(lines: DataFrame) -> DataFrame:
    """The numbers of each split's first and last line."""
    return lines.groupBy("path", "_source_file", "block").agg(F.min("line").alias("begin"), F.max("line").alias("last"))


def stretches(lines: DataFrame, cut: str = "opens OR NOT stays") -> DataFrame:
    """Stretches of lines, each with ``before``: whether a quoted field is open before the first, and ``after``: after all.

    A stretch is a line that can change the state with the lines after it that cannot, (``line`` to
    ``until``); another one is before the first such line of each split (``number`` 0, from ``line`` + 1 on).
    ``cut`` may let other lines begin one too, and ``blank`` tells those of them that are empty.
    Only lines that can change the state are shuffled and sorted, without their text. Each split is
    followed by itself, and a prefix over one row a split tells how it begins: no task reads more than
    a split, however large the file.
    """
    within = Window.partitionBy("path", "block").orderBy("line")
    place = ["path", "_source_file", "block"]
    changing = lines.where(cut).selectExpr(*place, "line", "opens", "stays", "value = '' AS blank", "CAST(NULL AS LONG) AS last")
    begins = _splits(lines).selectExpr(*place, "begin - 1 AS line", "false AS opens", "true AS stays", "false AS blank", "last")
    marks = _followed(begins.unionByName(changing), within)
    splits = marks.groupBy("path", "block").agg(
        F.max_by(F.struct("fixed", "turns"), "line").alias("end"), F.max("last").alias("last")
    )
    # A split as a whole is like one line: what comes out if it begins outside, and if inside.
    out = [F.coalesce("end.fixed", F.lit(start)).bitwiseXOR(F.col("end.turns")) == 1 for start in (0, 1)]
    splits = splits.select("path", "block", "last", out[0].alias("opens"), out[1].alias("stays"))
    splits = _followed(splits, Window.partitionBy("path").orderBy("block"))
    ended = F.coalesce("fixed", F.lit(0)).bitwiseXOR(F.col("turns"))
    inside = F.lag(ended, 1, 0).over(Window.partitionBy("path").orderBy("block"))
    splits = splits.select("path", "block", "last", inside.alias("begins"))
    marks = marks.drop("last").join(splits, ["path", "block"])
    after = F.coalesce("fixed", "begins").bitwiseXOR(F.col("turns"))
    before = F.coalesce(F.lag(after).over(within), F.col("begins"))
    until = F.coalesce(F.lead("line").over(within) - 1, F.col("last"))
    number = F.row_number().over(within) - 1
    return marks.select(
        *place, "line", "blank", until.alias("until"), number.alias("number"), before.alias("before"), after.alias("after")
    )


def lines_of_long_records(lines: DataFrame) -> DataFrame:
    """(``line``, ``first``, ``after``) of the lines of records that run over several: the place of the record's first line."""
    found = stretches(lines)
    starts = F.when((F.col("before") == 0) & (F.col("after") == 1), F.struct("block", "line"))
    within = Window.partitionBy("path", "block").orderBy("line")
    # What a split begins with belongs to the last record that began before it.
    last = found.groupBy("path", "block").agg(F.max(starts).alias("last"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("path", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    found = found.withColumn("first", F.last(starts, ignorenulls=True).over(within)).where("before = 1 OR after = 1")
    found = found.join(carried, ["path", "block"]).withColumn("first", F.coalesce("first", "carried"))
    found = found.withColumn("start", F.when(F.col("number") == 0, F.col("line") + 1).otherwise(F.col("line")))
    # Of a stretch that is outside after its first line, that line alone is the end of a record.
    end = F.when(F.col("after") == 1, F.col("until")).when(F.col("number") > 0, F.col("line"))
    found = found.withColumn("end", end).where("start <= end")
    return found.select(F.explode(F.sequence("start", "end")).alias("line"), "first", "after")


def _hinted(some: DataFrame) -> DataFrame:
    """``some`` lines to be broadcast if they are few by count: all lines are joined with them, and need not be shuffled then."""
    return F.broadcast(some) if some.count() <= FEW_LINES else some


def records(lines: DataFrame) -> DataFrame:
    """(``path``, ``_source_file``, ``block``, ``line``, ``value``): whole records, the place that of their first line.

    Only the lines of records that run over several are brought together. The header and lines
    without anything are left out. Lines are told by their numbers, which are the same in every scan of
    the same files within one plan.
    """
    columns = ["path", "_source_file", "block", "line", "value"]
    headers = _splits(lines).where("block = 0").select(F.col("begin").alias("line"))
    long = _hinted(lines_of_long_records(lines).select("line", "first"))
    rows = lines.select(*columns).join(F.broadcast(headers), "line", "left_anti")  # one a file
    single = rows.join(long, "line", "left_anti").where("trim(value) <> ''").select(*columns)
    text = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = rows.join(long, "line").groupBy("path", "_source_file", "first").agg(
        F.array_join(F.transform(text, lambda part: part["value"]), "\n").alias("value")
    )
    return single.unionByName(joined.select("path", "_source_file", "first.block", "first.line", "value"))


def _plain(path: str) -> str:
    """A path without its scheme, which is written in more than one way."""
    return path.split(":", 1)[-1].lstrip("/")


def read_typed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Read CSV files with a header row, binding columns to types by name, file by file.

    All columns are read as text first, since a schema given to the reader binds by position and
    the extracts do not agree on an order; columns that the schema does not name are left out.
    Quotes are doubled inside quoted fields, a backslash is a plain character, and quoted fields
    can hold line breaks. All files are split across tasks, also those with such line breaks (see
    ``records``). Rows with a wrong number of fields and values that do not fit their type exactly
    raise.

    Adds ``_row_ordinal`` (position in the file) and ``_source_file``.
    """
    broken = set(with_open_quotes(spark, paths))
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path in paths:
        header = header_of(spark, path)
        absent = [name for name in schema.names if name not in header]
        if absent:
            raise ValueError(f"{path}: columns missing from header: {absent}")
        groups.setdefault((header, path in broken), []).append(path)
    parts = [_read_alike(spark, p, schema, *kind) for kind, p in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def _read_alike(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    header: tuple[str, ...],
    multi_line: bool,
) -> DataFrame:
    """Files with the same header."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if multi_line:
        rows = records(_lines(spark, paths))
        columns = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in header)
        parsed = F.from_csv("value", columns, {"mode": "FAILFAST", "escape": '"'})
        raw = rows.select(F.struct("block", "line").alias("_row_ordinal"), "_source_file", parsed.alias("row"))
        raw = raw.select("row.*", "_source_file", "_row_ordinal")
        place = [F.col("_source_file"), F.col("_row_ordinal")]
    else:
        raw = (
            spark.read.schema(text)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("columnPruning", False)
            .option("escape", '"')
            .csv(paths)
        )
        number = F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        place = [F.col("_metadata.file_name").alias("_source_file"), number.alias("_row_ordinal")]
    return raw.select(
        *[
            strict(empty_to_null(F.col(f"`{f.name}`")), f.dataType, f.name).alias(f.name)
            for f in schema.fields
        ],
        *place,
    )


def count_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records per file without the CSV reader: lines that end outside quotes, the header aside.

    Lines without anything are no records. Of files with open quotes the stretches of lines are counted,
    so that no line is looked up.
    """
    broken = with_open_quotes(spark, paths)
    plain = [path for path in paths if path not in set(broken)]
    parts = []
    if plain:
        ends = _lines(spark, plain).where("value <> ''").groupBy("_source_file")
        parts.append(ends.agg(F.count("*").alias("ends")))
    if broken:
        found = stretches(_lines(spark, broken), "opens OR NOT stays OR value = ''")
        first = F.when((F.col("number") > 0) & ~F.col("blank"), 1).otherwise(0)
        ends = found.where("after = 0").withColumn("ends", F.col("until") - F.col("line") + first)
        parts.append(ends.groupBy("_source_file").agg(F.sum("ends").alias("ends")))
    ends = reduce(DataFrame.unionByName, parts).where("ends > 0")
    return ends.select("_source_file", (F.col("ends") - 1).alias("records"))


def _stamp(rows: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    source = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(
        *source,
        "_source_file",
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(run_id).alias("_pipeline_run_id"),
        "_row_ordinal",
    )


def _daily(spark, paths, schema, run_id, ingested_at) -> DataFrame:
    rows = _stamp(read_typed(spark, paths, schema), run_id, ingested_at)
    return rows.withColumn("date", file_date(F.col("_source_file")))


def read_transactions(
    spark: SparkSession, paths: list[str], run_id: str, ingested_at: str
) -> DataFrame:
    return _daily(spark, paths, TRANSACTION_SOURCE, run_id, ingested_at)


def read_accounts(
    spark: SparkSession, paths: list[str], run_id: str, ingested_at: str
) -> DataFrame:
    return _daily(spark, paths, ACCOUNT_SOURCE, run_id, ingested_at)


def read_codes(spark: SparkSession, source_dir: str, run_id: str, ingested_at: str) -> DataFrame:
    path = f"{source_dir}/transaction_codes.csv"
    return _stamp(read_typed(spark, [path], CODE_SOURCE), run_id, ingested_at)
