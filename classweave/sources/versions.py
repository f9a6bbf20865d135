"""Parquet tables in versions: a new one appears with one small file, and readers of an old one are not disturbed.

For stores without a rename, and for tables that are read while they are replaced. Nothing is overwritten: a version is
a folder of its own, and a list of versions is a new file with the next number. The highest number whose file is whole
holds.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from classweave.sources.files import child_names, delete_path, read_text, write_text

_LIST = "_versions-"


def _lists(spark: SparkSession, path: str) -> list[tuple[int, list[str]]]:
    """(number, version folders, oldest first) of every list that is whole, newest first."""
    found = []
    for name in reversed([n for n in child_names(spark, path) if n.startswith(_LIST)]):
        try:
            found.append((int(name.removeprefix(_LIST)), json.loads(read_text(spark, f"{path}/{name}"))["versions"]))
        except (ValueError, KeyError):
            continue
    return found


def version_names(spark: SparkSession, path: str) -> list[str]:
    """The versions that can be read, oldest first; none if nothing was ever published."""
    lists = _lists(spark, path)
    return lists[0][1] if lists else []


def write_version(df: DataFrame, path: str, keep: int = 2) -> str:
    """Write `df` as the newest version of the table at `path` and return the version's name.

    Versions beyond the newest `keep` are deleted, once the list without them is in place. A write that fails changes
    nothing that can be read. One writer at a time: of two, the second to list its version raises.
    """
    if keep < 1:
        raise ValueError("at least one version must be kept")
    spark = df.sparkSession
    lists = _lists(spark, path)
    number, old = (lists[0][0], lists[0][1]) if lists else (0, [])
    name = f"version-{uuid4().hex}"
    try:
        df.write.parquet(f"{path}/{name}")
        versions = [*old, name][-keep:]
        write_text(spark, f"{path}/{_LIST}{number + 1:012d}", json.dumps({"versions": versions}))
    except BaseException:
        delete_path(spark, f"{path}/{name}")
        raise
    for past, names in lists:
        for gone in set(names) - set(versions):
            delete_path(spark, f"{path}/{gone}")
        # The list before this one stays until the next write: a reader may just have opened it.
        if past < number:
            delete_path(spark, f"{path}/{_LIST}{past:012d}")
    return name


def read_version(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The newest version, or the one so many versions before it."""
    names = version_names(spark, path)
    if back < 0 or back >= len(names):
        raise ValueError(f"{path} has {len(names)} versions, none lies {back} back")
    return spark.read.parquet(f"{path}/{names[-1 - back]}")
