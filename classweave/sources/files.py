"""Small files and renames on any Hadoop file system, seen from the driver."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    files, found = hadoop_path(spark, path)
    return files.exists(found)


def delete_path(spark: SparkSession, path: str) -> None:
    files, found = hadoop_path(spark, path)
    files.delete(found, True)


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    files, found = hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(found)) if files.exists(found) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file with this text; an existing one raises."""
    files, found = hadoop_path(spark, path)
    out = files.create(found, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    files, found = hadoop_path(spark, path)
    opened = files.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def sibling(spark: SparkSession, path: str, word: str) -> str:
    """A fresh path beside `path`, on the same file system; the underscore hides it from readers of the folder."""
    _, found = hadoop_path(spark, path)
    return f"{found.getParent()}/{_sibling_name(found.getName(), word)}{uuid4().hex}"


def _sibling_name(name: str, word: str) -> str:
    return f"_{name}-{word}-"


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put what is complete at `fresh` in the place of `path`, by renames.

    The old table is moved aside first and comes back if the new one can't take its place. A driver that dies between
    both renames leaves it aside, where `recover` finds it.
    """
    files, target = hadoop_path(spark, path)
    _, source = hadoop_path(spark, fresh)
    aside = None
    if files.exists(target):
        _, aside = hadoop_path(spark, sibling(spark, path, "old"))
        if not files.rename(target, aside):
            raise OSError(f"{path} could not be moved aside")
    elif target.getParent() is not None:
        files.mkdirs(target.getParent())
    moved = False
    try:
        moved = files.rename(source, target)
    finally:
        if not moved and aside is not None:
            files.rename(aside, target)
    if not moved:
        raise OSError(f"{path} could not be replaced")
    if aside is not None:
        files.delete(aside, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Bring back the latest table that was moved aside, if there is none at `path`; whether one came back."""
    files, target = hadoop_path(spark, path)
    if files.exists(target) or not files.exists(target.getParent()):
        return False
    start = _sibling_name(target.getName(), "old")
    aside = [s for s in files.listStatus(target.getParent()) if s.getPath().getName().startswith(start)]
    if not aside:
        return False
    return files.rename(max(aside, key=lambda s: s.getModificationTime()).getPath(), target)
