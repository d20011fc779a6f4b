"""Small control files in shared storage (pointers, commit markers), through
Hadoop's file systems so that any URI works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(FileSystem, Path) of any URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; hidden and temporary ones are left out. A
    folder that is not there is empty."""
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(n for n in names if not n.startswith((".", "_tmp-")))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole text of a small file, None if it is not there. Any other
    failure is raised."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _rename(spark: SparkSession, text: str, path: str, overwrite: bool) -> None:
    jvm = spark.sparkContext._jvm
    fs, target = file_system(spark, path)
    fs.mkdirs(target.getParent())
    tmp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if overwrite else kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), options)
    finally:
        fs.delete(tmp, False)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` in place of the file in one atomic, overwriting rename:
    a reader sees the old or the new text, never none."""
    _rename(spark, text, path, overwrite=True)


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its text; False, and no change, if it is already
    there. Of several writers one wins."""
    from py4j.protocol import Py4JJavaError

    try:
        _rename(spark, text, path, overwrite=False)
        return True
    except Py4JJavaError as ex:
        if "AlreadyExists" in str(ex.java_exception.getClass().getName()) or exists(spark, path):
            return False
        raise
