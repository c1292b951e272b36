"""Tables that appear whole: every attempt has a folder of its own, and an empty marker file says which one counts.

A name is committed when its marker exists. Nothing that is committed is ever overwritten, so readers are never disturbed. If two
writers commit one name, the older marker counts; the other attempt stays unused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_MARKERS = "_commits"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def committed(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders of all committed names, in order of name. One listing, whatever they hold."""
    files, folder = _folder(spark, f"{root}/{_MARKERS}")
    if not files.exists(folder):
        return {}
    found = sorted((s.getModificationTime(), s.getPath().getName()) for s in files.listStatus(folder))
    out: dict[str, str] = {}
    for _, marker in found:
        name, _, attempt = marker.rpartition("=")
        out.setdefault(name, f"{root}/{name}-{attempt}")
    return dict(sorted(out.items()))


def commit(df: DataFrame, root: str, name: str) -> str:
    """Write ``df`` below ``root`` as ``name`` unless that is committed; the folder that counts."""
    spark = df.sparkSession
    there = committed(spark, root).get(name)
    if there:
        return there
    attempt = uuid.uuid4().hex
    df.write.parquet(f"{root}/{name}-{attempt}")
    files, marker = _folder(spark, f"{root}/{_MARKERS}/{name}={attempt}")
    files.create(marker, False).close()
    return committed(spark, root)[name]


def forget(spark: SparkSession, root: str, name: str) -> None:
    """Remove a committed name: its marker first, then its rows."""
    there = committed(spark, root).get(name)
    if there:
        files, folder = _folder(spark, there)
        attempt = there.rpartition("-")[2]
        files.delete(_folder(spark, f"{root}/{_MARKERS}/{name}={attempt}")[1], False)
        files.delete(folder, True)


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()) if files.exists(folder) else []
