"""Numbered folders that appear whole, each number taken by one writer.

Content is written to a hidden folder first and renamed to ``version=N``.  A
rename onto a folder that exists does not replace it: file systems refuse it or
put the source inside.  So one writer wins a number, whatever runs beside it,
and a version that can be seen is complete.  Needs a file system whose folder
rename is atomic (HDFS and its like, POSIX); plain object stores need a
committer in front.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_VERSION = re.compile(r"version=(\d+)")
_TOKEN = "_owner-"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def filesystem(spark: SparkSession, path: str):
    root = _path(spark, path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    root, fs = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published version numbers, ascending by number."""
    found = (_VERSION.fullmatch(n) for n in folder_names(spark, root))
    return sorted(int(m.group(1)) for m in found if m)


def version_path(root: str, version: int) -> str:
    return f"{root}/version={version}"


def staging_path(root: str) -> str:
    """A fresh hidden folder beside the versions."""
    return f"{root}/_staging-{uuid.uuid4().hex}"


def publish_as(spark: SparkSession, staged: str, root: str, version: int) -> bool:
    """Turn a finished staging folder into ``version``; False if the number is taken."""
    _, fs = filesystem(spark, root)
    source, target = _path(spark, staged), _path(spark, version_path(root, version))
    owner = _TOKEN + source.getName()
    fs.create(_path(spark, staged, owner), True).close()
    if fs.exists(target):
        return False
    moved = fs.rename(source, target)
    if fs.isFile(_path(spark, version_path(root, version), owner)):
        return True
    inside = _path(spark, version_path(root, version), source.getName())
    if moved and fs.exists(inside):
        fs.rename(inside, source)
    return False


def publish_next(spark: SparkSession, staged: str, root: str) -> int:
    """Publish under the first number above all taken ones."""
    version = (versions(spark, root) or [0])[-1] + 1
    while not publish_as(spark, staged, root, version):
        version += 1
    return version


def remove(spark: SparkSession, path: str) -> None:
    target, fs = filesystem(spark, path)
    fs.delete(target, True)
