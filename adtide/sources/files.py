"""Parquet and CSV scans and sinks, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Scan a root of ``key=value`` folders; filters on the key prune folders."""
    return spark.read.parquet(root)


def read_parts(spark: SparkSession, root: str, day: str, first: int | None = None) -> DataFrame:
    """All part files of one ``day=...`` folder, or by name the ``first`` so many that are asked for.

    Only the file listing of that day reaches the driver, as in any file scan.
    """
    files = sorted(spark.read.parquet(f"{root}/day={day}").inputFiles())
    return spark.read.option("basePath", root).parquet(*(files if first is None else files[:first]))


def spread_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows dealt evenly over all shuffle partitions by a row key, whatever the input's files.

    For rows that become expensive (hashed vectors) or are read many times (training input). A
    hash of the key gives a retried task the same rows again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, gather: bool = True,
    compression: str | None = None,
) -> DataFrame:
    """Overwrite ``path`` and return a scan of what was written.

    With partition columns, ``gather`` collects each value into few files; AQE splits a value that
    holds a large share of the rows over several tasks. Without it every task writes its own rows.
    """
    keys = partition_by or []
    out = df.hint("rebalance", *keys) if keys and gather else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*keys) if keys else writer).parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


_STAGED: list[str] = []


def _shared_base(spark: SparkSession) -> str:
    """The configured checkpoint folder; in local mode only, one of our own where none is set."""
    context = spark.sparkContext
    base = (
        context.getConf().get("spark.checkpoint.dir")
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if base:
        return base
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="adtide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder; it is deleted when the driver ends.

    The folder is ``spark.checkpoint.dir`` or what ``setCheckpointDir`` was given. On a cluster
    without either this is an error: a machine-local folder would silently lose rows.
    """
    path = f"{_shared_base(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(release_scratch, spark)
    _STAGED.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` gave out; tables read from them are gone then.

    A job calls it when its results are written. Returns how many folders were there.
    """
    found = 0
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while _STAGED:
            path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
            found += path.getFileSystem(conf).delete(path, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder's owner cleans up
        _STAGED.clear()
    return found


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and scan it.

    Used for small results of a scan over the fact tables that a plan reads more than once: the
    scan runs once, survives executor loss, and the optimiser knows its true size afterwards.
    """
    return write_parquet(df, scratch_path(df.sparkSession, name), compression="zstd")
