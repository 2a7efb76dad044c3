"""Parquet tables, and tables that can be replaced while they are being read.

A replaceable table is a directory of complete versions ``v0000000001``, ``v0000000002`` ...  A load writes
the next version and leaves the others alone, so it may read the very table it replaces, a reader keeps the
version it opened, and a load that dies leaves a directory without the success marker, which is never
read.  The marker is written last, by Spark's own job commit; nothing is moved or copied afterwards.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"v(\d{10})")
_TAKEN = re.compile(r"\.?v(\d{10})(?:\.claim)?")


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="starmill-")


def scratch_root(spark: SparkSession) -> str:
    """A new directory below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/starmill-{uuid.uuid4().hex}"


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash the rows over all cores if the input was cut into much fewer pieces than there are cores.

    A file of one row group, or a compressed text file, is read by one task however large it is.  An input of
    ordinary size for its cluster has more pieces than cores and comes back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if 2 * df.rdd.getNumPartitions() <= cores else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep_others: bool = False) -> None:
    """Overwrite the Parquet table at ``path``.

    With ``partition_by`` the rows are rebalanced first: few files per partition value, and adaptive execution
    splits a value that holds very many rows.  With ``keep_others`` only partitions that ``df`` has rows for are
    replaced; Spark writes them aside and moves them when all are complete, so a write that dies leaves the table as it
    was.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if keep_others:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version of a replaceable table."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no complete version below {root}")
    return spark.read.parquet(_version_path(root, version))


def current_version(spark: SparkSession, root: str) -> int | None:
    return max((n for n in _versions(spark, root) if _is_complete(spark, root, n)), default=None)


def replace_table(df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` as the next version of ``root`` and return that version, read back."""
    spark = df.sparkSession
    number = _claimed(spark, root)
    path = _version_path(root, number)
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    claim, fs = _filesystem(spark, _claim_path(root, number))
    fs.delete(claim, False)
    return spark.read.parquet(path)


def _claim_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/.v{number:010d}.claim"


def _claimed(spark: SparkSession, root: str) -> int:
    """The number of the next version, taken by creating a file that only one load can create.

    A load that dies leaves its file, so that its number is not used again.
    """
    folder, fs = _filesystem(spark, root)
    names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
    taken = [int(m.group(1)) for m in map(_TAKEN.fullmatch, names) if m]
    number = max(taken, default=0) + 1
    claim, fs = _filesystem(spark, _claim_path(root, number))
    if not fs.createNewFile(claim):
        raise RuntimeError(f"another load is writing version {number} of {root}")
    return number


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the ``keep`` newest complete versions and return the numbers removed.

    Directories newer than the current version are left alone: a load may be writing one.
    """
    if keep < 1:
        raise ValueError("the current version cannot be removed")
    complete = [n for n in sorted(_versions(spark, root)) if _is_complete(spark, root, n)]
    kept = complete[-keep:]
    removed = [n for n in sorted(_versions(spark, root)) if kept and n < kept[-1] and n not in kept]
    for number in removed:
        for location in (_version_path(root, number), _claim_path(root, number)):
            path, fs = _filesystem(spark, location)
            fs.delete(path, True)
    return removed


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:010d}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    path, fs = _filesystem(spark, root)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return [int(m.group(1)) for m in map(_VERSION.fullmatch, names) if m]


def _is_complete(spark: SparkSession, root: str, version: int) -> bool:
    marker, fs = _filesystem(spark, f"{_version_path(root, version)}/_SUCCESS")
    return fs.exists(marker)


def exists(spark: SparkSession, location: str) -> bool:
    path, fs = _filesystem(spark, location)
    return fs.exists(path)


def _filesystem(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
