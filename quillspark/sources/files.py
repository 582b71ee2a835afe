"""Small files and folders of the driver on any file system that Hadoop knows: local, shared or object storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def join(*parts: str) -> str:
    return "/".join([*(p.rstrip("/") for p in parts[:-1]), parts[-1]])


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def any_like(spark: SparkSession, pattern: str) -> bool:
    """Whether there is a file of such a name (* and ? stand for characters)."""
    fs, where = _at(spark, pattern)
    return bool(fs.globStatus(where))


def described(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """The qualified path, the bytes in it (a folder's are those of all its files), and the second of the last change."""
    fs, where = _at(spark, path)
    return str(fs.makeQualified(where)), int(fs.getContentSummary(where).getLength()), fs.getFileStatus(where).getModificationTime() // 1000


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    fs, where = _at(spark, path)
    return [str(x.getPath().getName()) for x in fs.listStatus(where) if x.isFile()] if fs.exists(where) else []


def folders(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the folders in a folder, and the second of their last change."""
    fs, where = _at(spark, path)
    return {str(x.getPath().getName()): x.getModificationTime() / 1000 for x in fs.listStatus(where) if x.isDirectory()} if fs.exists(where) else {}


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the data files in a folder, and their bytes."""
    fs, where = _at(spark, path)
    return {str(x.getPath().getName()): x.getLen() for x in fs.listStatus(where) if x.isFile() and not str(x.getPath().getName()).startswith(("_", "."))}


def read_text(spark: SparkSession, path: str, errors: str = "strict") -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8", errors)
    finally:
        stream.close()


def _write_aside(spark: SparkSession, path: str, body: str) -> str:
    aside = f"{path}.{uuid.uuid4().hex}.new"
    fs, where = _at(spark, aside)
    fs.mkdirs(where.getParent())
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(body.encode("utf-8")))
    finally:
        stream.close()
    return aside


def _rename(spark: SparkSession, old: str, new: str, how: str) -> None:
    """One step of the file system; `how` is OVERWRITE, or NONE, by which it fails if the new name is taken."""
    fs, a = _at(spark, old)
    _, b = _at(spark, new)
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = getattr(kinds, how)
    a, b = fs.makeQualified(a), fs.makeQualified(b)
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark._jsparkSession.sessionState().newHadoopConf()).rename(a, b, options)


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """Written aside and put in the old text's place by one rename, so that a reader finds the old text or the new."""
    _rename(spark, _write_aside(spark, path, body), path, "OVERWRITE")


def create_text(spark: SparkSession, path: str, body: str) -> bool:
    """Write a file that is not there yet, whole when it comes into sight; False if there is one, which stays as it is."""
    aside = _write_aside(spark, path, body)
    try:
        _rename(spark, aside, path, "NONE")
        return True
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        return False
    finally:
        delete(spark, aside)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share, spark.checkpoint.dir; it is deleted when the driver's JVM ends.

    A local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillspark-")
        spark.sparkContext.setCheckpointDir(base)
    path = join(base, f"quillspark-{uuid.uuid4().hex}")
    fs, where = _at(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path
