"""Driver-side file-system calls and staged tables.

Only metadata passes through here: listing, renaming, deleting a directory. Rows never do.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Formats that are plain directories of files, without a transaction log of their own.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text")

# Folders below the application's own into which tables are staged now.
_SCOPE: ContextVar[tuple[str, ...]] = ContextVar("scope", default=())


def join(*parts: str) -> str:
    """Join URI parts with single slashes, leaving out empty ones."""
    head, *tail = parts
    return "/".join([head.rstrip("/"), *(p.strip("/") for p in tail if p.strip("/"))])


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def has_part_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a ``part-*`` file at its top level. Only a path that is not there counts as no.

    The listing is read lazily and stops at the first hit, so a large directory is not listed whole. Any
    other failure, such as a throttled store, is raised.
    """
    try:
        fs, handle = _open(spark, path)
        entries = fs.listStatusIterator(handle)
        while entries.hasNext():
            if entries.next().getPath().getName().startswith("part-"):
                return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.io.FileNotFoundException":
            raise
    return False


def make_directory(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.mkdirs(handle)


def holds_anything(spark: SparkSession, path: str) -> bool:
    """Whether a directory is there and not empty; it is not listed whole."""
    fs, handle = _open(spark, path)
    return fs.exists(handle) and fs.listStatusIterator(handle).hasNext()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a directory holds, sorted; none where it is not there."""
    fs, handle = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(handle)) if fs.exists(handle) else []


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a file that is not blank; None without one. No more of the file is read than a buffer.

    A file that is named as a compressed one, such as ``.gz``, is read as Spark's readers do.
    """
    io = spark._jvm.java.io
    fs, handle = _open(spark, path)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = codecs.getCodec(handle)
    data = fs.open(handle)
    if codec is not None:
        data = codec.createInputStream(data)
    reader = io.BufferedReader(io.InputStreamReader(data, encoding))
    try:
        while (line := reader.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        reader.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; whether this call did, and not another writer before it. The store decides who is first.

    Hadoop's local file system looks first and creates then, so there the operating system is asked to do both.
    """
    fs, handle = _open(spark, path)
    data = bytearray(text.encode())
    try:
        if fs.getScheme() == "file":
            _create_local(spark, fs, handle, data)
            return True
        out = fs.create(handle, False)
    except Py4JJavaError as error:
        if not fs.exists(handle):
            raise error
        return False
    try:
        out.write(data)
    finally:
        out.close()
    return True


def _create_local(spark: SparkSession, fs, handle, data: bytearray) -> None:
    nio = spark._jvm.java.nio.file
    fs.mkdirs(handle.getParent())
    options = spark.sparkContext._gateway.new_array(nio.OpenOption, 2)
    options[0], options[1] = nio.StandardOpenOption.CREATE_NEW, nio.StandardOpenOption.WRITE
    nio.Files.write(spark._jvm.java.io.File(fs.makeQualified(handle).toUri()).toPath(), data, options)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, handle = _open(spark, path)
    stream = fs.open(handle)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.delete(handle, True)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a finished directory to a name that is not taken yet."""
    fs, source = _open(spark, staged)
    destination = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(destination.getParent())
    if fs.exists(destination) or not fs.rename(source, destination):
        raise OSError(f"could not move {staged} to {target}")


def replace(spark: SparkSession, fresh: str, target: str) -> None:
    """Put directory ``fresh`` in the place of ``target``.

    The old directory is moved aside before it is deleted, so a reader meets the old table, the new
    one, or for a moment none, but never a half-written one.
    """
    fs, new = _open(spark, fresh)
    old = spark._jvm.org.apache.hadoop.fs.Path(target)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}__old_{uuid.uuid4().hex}")
    if fs.exists(old):
        if not fs.rename(old, aside):
            raise OSError(f"could not move {target} aside")
    elif old.getParent() is not None:
        fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        if fs.exists(aside):
            fs.rename(aside, old)
        raise OSError(f"could not move {fresh} to {target}")
    if fs.exists(aside):
        fs.delete(aside, True)


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A local session without one gets a temporary folder; a cluster without one is an error, because
    a folder of one machine cannot be read by the others. A ``file:`` folder on a cluster has to be a mount
    that all machines share.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierflow-"))
        root = sc.getCheckpointDir()
    return root


def _staging_home(spark: SparkSession) -> str:
    return join(staging_root(spark), "tierflow", spark.sparkContext.applicationId)


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's own folder under the staging root."""
    return join(_staging_home(spark), *_SCOPE.get(), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what was staged by the application, the results being written by then."""
    try:
        yield
    finally:
        clear_staged(spark)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged, once no DataFrame needs it any more."""
    fs, home = _open(spark, _staging_home(spark))
    fs.delete(home, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`stage` for the block only: the table is deleted at its end."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    try:
        df.write.parquet(path, compression="zstd")
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def stage_result(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """`stage` what ``make`` returns, and delete what it staged itself on the way, also if it fails."""
    path = staging_path(spark, label)
    scope = (*_SCOPE.get(), f"scope-{uuid.uuid4().hex}")
    outer = _SCOPE.set(scope)
    try:
        made = make()
        made.write.parquet(path)
    finally:
        _SCOPE.reset(outer)
        delete(spark, join(_staging_home(spark), *scope))
    return spark.read.schema(made.schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a staged table and read it back.

    Fixes the rows once and for all: recomputation after a lost executor, or a second scan, sees the
    same rows with the same values, also where the plan above was not repeatable. The table stays until
    `clear_staged`.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
