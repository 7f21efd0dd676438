"""Tables that are replaced together, by a pointer that readers follow.

A load writes its tables to new folders, which nobody reads yet, and then publishes a
numbered version: a small file that names each table's folder. Readers take the version
with the highest number. Version files are never changed and folders never moved, so
whoever reads meets either the tables before the load or all of those after it, on a
store without renames of folders, too. `expire` deletes what old versions alone name.

One load publishes at a time. A load claims the number after the version it started from;
if that is taken, another load came first and this one fails, leaving nothing but folders
that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from legalops.model import TABLES
from legalops.sources.tables import read_folder, write_folder

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another load has published, or is publishing, since this one began."""


def _files(spark: SparkSession, root: str) -> tuple[JavaObject, type]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, root: str, ending: str = ".json") -> list[int]:
    files, path = _files(spark, root)
    folder = path(f"{root}/{VERSIONS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n[: -len(ending)]) for n in names if n.endswith(ending) and n[: -len(ending)].isdigit())


def current_version(spark: SparkSession, root: str) -> int:
    """The number of the version that readers see, 0 before the first."""
    return max(_numbers(spark, root), default=0)


def folders(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """The folder of each table in a version, by default the current one."""
    number = current_version(spark, root) if version is None else version
    if not number:
        return {}
    files, path = _files(spark, root)
    stream = files.open(path(f"{root}/{VERSIONS}/{number:012d}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def read_current(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of one version; together they are as one load left them."""
    return {name: read_folder(spark, f"{root}/{at}", name) for name, at in folders(spark, root, version).items()}


def _publish(spark: SparkSession, root: str, before: int, named: Mapping[str, str]) -> int:
    files, path = _files(spark, root)
    number = before + 1
    claim = path(f"{root}/{VERSIONS}/{number:012d}.claim")
    if current_version(spark, root) != before or files.exists(claim):
        raise Conflict(f"version {number} of {root} is taken")
    # Of two loads only one can create the claim.
    files.create(claim, False).close()
    made = path(f"{root}/{VERSIONS}/.{uuid.uuid4().hex}")
    stream = files.create(made, False)
    stream.write(bytearray(json.dumps(dict(named), sort_keys=True).encode()))
    stream.close()
    # The file is whole when it gets its name.
    if not files.rename(made, path(f"{root}/{VERSIONS}/{number:012d}.json")):
        raise Conflict(f"version {number} of {root} is taken")
    return number


def replace_tables(t: Mapping[str, DataFrame], root: str, since: int | None = None) -> int:
    """Publish a version with these tables in place of those of the same names.

    The other tables stay. `since` is the version the frames were read from, by default the
    current one: if another was published after it, this fails with Conflict. Frames may
    read tables they replace. Gives the new version's number.
    """
    if not t:
        raise ValueError("no tables to replace")
    spark = next(iter(t.values())).sparkSession
    before = current_version(spark, root) if since is None else since
    named = folders(spark, root, before)
    for name, df in t.items():
        folder = f"{name}/{uuid.uuid4().hex}"
        write_folder(df, f"{root}/{folder}", name)
        named[name] = folder
    return _publish(spark, root, before, named)


def abandon_claim(spark: SparkSession, root: str) -> None:
    """Give back a number that a load claimed and then died without publishing."""
    files, path = _files(spark, root)
    for number in _numbers(spark, root, ".claim"):
        if number > current_version(spark, root):
            files.delete(path(f"{root}/{VERSIONS}/{number:012d}.claim"), False)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last `keep` versions and the folders that only they name.

    Keep as many as readers may still be at. Folders that no version names, left by loads
    that failed, go as well, so no load may be under way. Gives the folders deleted.
    """
    files, path = _files(spark, root)
    numbers = _numbers(spark, root)
    kept = numbers[-max(keep, 1) :]
    named = {folder for number in kept for folder in folders(spark, root, number).values()}
    gone = []
    for name in TABLES:
        if files.exists(path(f"{root}/{name}")):
            found = [f"{name}/{status.getPath().getName()}" for status in files.listStatus(path(f"{root}/{name}"))]
            gone += [folder for folder in found if folder not in named]
    for number in numbers[: -max(keep, 1)]:
        for ending in ("json", "claim"):
            files.delete(path(f"{root}/{VERSIONS}/{number:012d}.{ending}"), False)
    for folder in gone:
        files.delete(path(f"{root}/{folder}"), True)
    return gone
