"""What the operators of this package share: reading tables, staging results, Arrow batches."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: texts can be very long, and a task holds one batch at a time.
ROWS_PER_BATCH = 512


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if not any(Path(f).name == "sediment.zip" for f in context.listFiles):
        package = Path(__file__).resolve().parents[1]
        base = str(Path(tempfile.mkdtemp(prefix="package-")) / "sediment")
        context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: this package on the executors, and small Arrow batches."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables; one of this machine only for a local session without."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="staged-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs start from the files."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def identifier(column: str) -> Column:
    """An id as a long that is never null; the null id becomes the smallest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63)))


def restored(column: str) -> Column:
    """The inverse of ``identifier``."""
    return F.when(F.col(column) != F.lit(-(2**63)), F.col(column))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` over every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(function, batches)

    return df.mapInArrow(run, schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by key; only one key's rows are held."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = table[key].combine_chunks()
        if isinstance(keys, pa.ChunkedArray):
            keys = pa.concat_arrays(keys.chunks)
        begin = 0
        values = keys.to_numpy(zero_copy_only=False)
        cuts = [*((values[1:] != values[:-1]).nonzero()[0] + 1).tolist(), len(values)]
        for end in cuts:
            part = table.slice(begin, end - begin)
            if held and begin == 0 and held[0][key][0].as_py() != values[0]:
                yield pa.concat_tables(held)
                held = []
            held.append(part)
            if end < len(values):
                yield pa.concat_tables(held)
                held = []
            begin = end
    if held:
        yield pa.concat_tables(held)
