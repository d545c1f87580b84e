"""The list of processed files as a log of changes.

Each run adds one version: the names it adds, written to a folder of their own, and then a commit, a small file named after the version that
names this folder. A commit is created only if there is none of that number, so of two runs that write
the same version one wins and the other is told. What a run that died has written is named by no commit and
is passed over. Every ``EVERY`` versions the whole list is written once more, so that a reader needs the last
such list and the few versions after it.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "file string"
EVERY = 20


class VersionTaken(Exception):
    """Another run has committed this version."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) for a path, whatever store it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it is there; whether this call made it."""
    fs, at = file_system(spark, path)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception) or fs.exists(at):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _commits(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(version, text) of all commits in order: a line per run, nothing per file. A commit whose writer died has no text."""
    fs, at = file_system(spark, os.path.join(folder, "commits"))
    if not fs.exists(at):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().isdigit())
    if not names:
        return []
    rows = spark.read.text(os.path.join(folder, "commits", "[0-9]*"), wholetext=True)
    texts = {r["name"]: r["value"] for r in rows.select(F.col("_metadata.file_name").alias("name"), "value").collect()}
    return [(int(n), (texts.get(n) or "").strip()) for n in names]


def latest(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """(files, version): all names committed so far and the highest version; no names and 0 when there is none."""
    commits = _commits(spark, folder)
    if not commits:
        return spark.createDataFrame([], SCHEMA), 0
    first = max((k for k, (_, text) in enumerate(commits) if text.startswith("whole ")), default=0)
    deltas = [text.split(" ", 1)[1] for _, text in commits[first:] if text]
    if not deltas:
        return spark.createDataFrame([], SCHEMA), commits[-1][0]
    paths = [os.path.join(folder, "names", d) for d in deltas]
    return spark.read.schema(SCHEMA).json(paths).distinct(), commits[-1][0]


def commit(added: DataFrame, folder: str, version: int) -> None:
    """Add the names of ``added`` as that version, which should be one more than the highest; raises ``VersionTaken`` if another
    run was first. Nothing of the names is visible before the commit."""
    spark = added.sparkSession
    kind, names = "added", added.select("file").distinct()
    if version % EVERY == 0:
        kind, names = "whole", names.union(latest(spark, folder)[0]).distinct()
    delta = f"{version:08d}-{uuid.uuid4().hex}"
    names.write.json(os.path.join(folder, "names", delta))
    if not create_once(spark, os.path.join(folder, "commits", f"{version:08d}"), f"{kind} {delta}"):
        raise VersionTaken(f"version {version} in {folder}")
