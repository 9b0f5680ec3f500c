"""Questions to the file system, whichever one a path names.

They go through the driver's gateway, so the lake needs a classic session, not a remote one.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, with its file system; a relative one starts at the working folder."""
    target, system = _locate(spark, path)
    return system.makeQualified(target).toString()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without its end; only the beginning of the file is read."""
    target, system = _locate(spark, path)
    jvm = spark._jvm.java.io
    reader = jvm.BufferedReader(jvm.InputStreamReader(system.open(target), "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _locate(spark, path)
    return system.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; names only, no content is read."""
    target, system = _locate(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(target) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or directory tree; nothing happens if it is not there."""
    target, system = _locate(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    target, system = _locate(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, path: str) -> bool:
    """Give a file or folder its final name; False if there is one of that name already.

    One step that only one of several callers can win, where the file system has such a rename.
    """
    origin, _ = _locate(spark, source)
    target, system = _locate(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(system.makeQualified(origin), system.makeQualified(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that appears whole; False, and nothing changed, if it is there already.

    On a local disk, whose rename replaces files, a hard link takes the name.
    """
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_draft-{name}-{uuid.uuid4().hex}"
    target, system = _locate(spark, draft)
    if system.getScheme() == "file":
        disk = spark._jvm.java.nio.file
        system.mkdirs(target.getParent())
        none = [spark.sparkContext._gateway.new_array(kind, 0) for kind in (spark._jvm.String, disk.OpenOption)]
        written, final = (disk.Path.of(_locate(spark, p)[0].toUri().getPath(), none[0]) for p in (draft, path))
        disk.Files.write(written, bytearray(text.encode()), none[1])
        try:
            disk.Files.createLink(final, written)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        finally:
            disk.Files.delete(written)
        return True
    stream = system.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if move_new(spark, draft, path):
        return True
    remove(spark, draft)
    return False
