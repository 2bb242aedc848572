"""File-system calls on the cluster's storage (HDFS, object stores, local).

Thin helpers over the Hadoop ``FileSystem`` the session is configured with,
for what DataFrame readers and writers do not do themselves: listing
version folders, checking a path, moving a single exported file.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches anything."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """``(name, full path, is_directory)`` of the entries of a folder; [] when absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(st.getPath().getName(), st.getPath().toString(), bool(st.isDirectory()))
            for st in fs.listStatus(p)]


def move(spark: SparkSession, src: str, dest: str) -> None:
    fs, p = _fs(spark, src)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dest)):
        raise RuntimeError(f"could not move {src} to {dest}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content in one step; False when it is there already.

    Written beside its place first, then put there by an operation that fails if the name is taken: a rename
    (HDFS), a hard link (local files), or an exclusive create on stores without either.
    """
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    scheme = fs.getUri().getScheme()
    if scheme in ("file", "hdfs", "viewfs"):
        # dot names are skipped by listings of numbers and by readers
        other = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        out = fs.create(other, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if scheme != "file":
                return bool(fs.rename(other, p))
            nio = jvm.java.nio.file
            name = lambda q: nio.Path.of(fs.makeQualified(q).toUri())
            try:
                nio.Files.createLink(name(p), name(other))
                return True
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                    return False
                # a file system without links: the exclusive create below
        finally:
            fs.delete(other, False)
    try:
        out = fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise


def modified(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder, in milliseconds."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the files at ``path``: itself, or the files directly inside it."""
    fs, p = _fs(spark, path)
    found = fs.globStatus(p) or []
    out = []
    for st in found:
        inside = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [int(x.getLen()) for x in inside if not x.isDirectory()]
    return out
