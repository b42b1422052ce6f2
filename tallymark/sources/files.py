"""Small files on the session's file store: markers, states, folders."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tallymark.sources.tables import path_exists

MARKER = "_CURRENT"


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()


#: Stores without a rename in one step, where a file appears whole when it is closed.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")

#: Of these, stores whose connector puts a file under the condition that its name is free: by
#: itself where overwriting is not asked for, or where it is told to.
CONDITIONAL = ("gs", "abfs", "abfss")
CONDITIONAL_OPTION = {"s3a": "fs.option.create.conditional.overwrite"}


def _scheme(spark: SparkSession, path) -> str:
    _, conf = _hadoop(spark)
    return path.getFileSystem(conf).getUri().getScheme() or "file"


def _put(spark: SparkSession, path, text: str, overwrite: bool) -> None:
    _, conf = _hadoop(spark)
    stream = path.getFileSystem(conf).create(path, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename(spark: SparkSession, source, target, overwrite: bool) -> None:
    fs, conf = _hadoop(spark)
    rename = getattr(fs, "Options$Rename")
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE if overwrite else rename.NONE
    fs.FileContext.getFileContext(target.toUri(), conf).rename(source, target, flags)


def write_marker(spark: SparkSession, folder: str, text: str) -> None:
    """Replace the marker of a folder: by a rename, or on an object store, whose renames are a
    copy and a delete, by one overwriting put."""
    fs, _ = _hadoop(spark)
    target = fs.Path(f"{folder}/{MARKER}")
    if _scheme(spark, target) in OBJECT_STORES:
        _put(spark, target, text, overwrite=True)
        return
    draft = fs.Path(f"{folder}/{MARKER}.{uuid.uuid4().hex}")
    _put(spark, draft, text, overwrite=True)
    _rename(spark, draft, target, overwrite=True)


def _put_new(spark: SparkSession, path, text: str) -> None:
    """Put a file if its name is free, decided by the store and not by looking first."""
    _, conf = _hadoop(spark)
    scheme = _scheme(spark, path)
    if scheme in CONDITIONAL:
        _put(spark, path, text, overwrite=False)
        return
    if scheme not in CONDITIONAL_OPTION:
        raise RuntimeError(f"{scheme}: not known to create files conditionally; keep states elsewhere")
    builder = path.getFileSystem(conf).createFile(path).overwrite(True)
    stream = builder.must(CONDITIONAL_OPTION[scheme], "true").build()
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; false if somebody else was first.

    Local disks link a finished draft, HDFS renames it without overwriting, object stores put
    it on the condition that the name is free: each shows the file whole or not at all. A store
    that is not known to check the condition itself is refused.
    """
    fs, conf = _hadoop(spark)
    target = fs.Path(path)
    scheme = _scheme(spark, target)
    if scheme in OBJECT_STORES:
        try:
            _put_new(spark, target, text)
        except Py4JJavaError:
            if target.getFileSystem(conf).exists(target):
                return False
            raise
        return True
    draft = fs.Path(f"{target.getParent().toString()}/.draft-{uuid.uuid4().hex}")
    _put(spark, draft, text, overwrite=True)
    try:
        if scheme == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            _rename(spark, draft, target, overwrite=False)
    except FileExistsError:
        return False
    except Py4JJavaError:
        if target.getFileSystem(conf).exists(target):
            return False
        raise
    finally:
        draft.getFileSystem(conf).delete(draft, False)
    return True


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder; none where it is missing."""
    if not path_exists(spark, folder):
        return []
    fs, conf = _hadoop(spark)
    target = fs.Path(folder)
    return [s.getPath().getName() for s in target.getFileSystem(conf).listStatus(target)]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, conf = _hadoop(spark)
    target = fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def read_marker(spark: SparkSession, folder: str) -> str | None:
    return read_file(spark, f"{folder}/{MARKER}")


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    if not path_exists(spark, path):
        return None
    fs, conf = _hadoop(spark)
    target = fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_by_age(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names directly under a folder that begin so, newest first; none where it is missing."""
    if not path_exists(spark, folder):
        return []
    fs, conf = _hadoop(spark)
    target = fs.Path(folder)
    found = [s for s in target.getFileSystem(conf).listStatus(target) if s.getPath().getName().startswith(prefix)]
    found.sort(key=lambda s: s.getModificationTime(), reverse=True)
    return [s.getPath().getName() for s in found]
