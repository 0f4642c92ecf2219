"""Spark session helpers.

The library never creates a session inside an operator; these helpers are
for scripts, tests and the bench.  On a cluster the session comes from the
caller and only ``shared_dir`` is used (it reads ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "depot") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DEPOT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster-shared scratch folder (``spark.checkpoint.dir``).

    A cluster names it in its configuration; we only read it.  Where it is
    unset, a local master (tests, benches) gets a fresh private folder, once
    per session; any other master is an error, since its executors would
    write to their own disks.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            path = None
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="depot-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_JOINED = 16 << 20                          # bytes shuffled that adaptive execution may join for one task


def spread_shuffles(spark: SparkSession, rows: int, rows_per_task: int = 250_000) -> None:
    """Let shuffles of a table of ``rows`` rows begin with a partition for each
    ``rows_per_task`` and be joined by adaptive execution to 16 MB shuffled at most
    (joined, summed and sorted rows take some 20 times that), so that what one task
    sorts and aggregates does not grow with the table.  Each of the two settings
    stays where the session's own is finer, whatever the other is: many partitions
    alone do not bound a task, since they are joined.  More is never taken back."""
    have = int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    need = -(-rows // rows_per_task)
    if need > have:
        spark.conf.set(_PARTITIONS, str(need))
    if need > 1 and _bytes(spark.conf.get(_ADVISORY)) > _JOINED:
        spark.conf.set(_ADVISORY, str(_JOINED))


def _bytes(size: str) -> int:
    """The bytes of a Spark size setting such as ``64MB``, ``8m`` or ``1048576b``."""
    number = size.strip().lower().removesuffix("b")
    unit = number[-1:] if number[-1:] in ("k", "m", "g", "t") else ""
    return int(number.removesuffix(unit)) << 10 * " kmgt".index(unit or " ")


_open = threading.local()                   # the scopes that this thread is in


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    for scope in getattr(_open, "scopes", ()):
        scope.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    from depot.sources import storage

    storage.delete(spark, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving whatever was stored under the scratch folder inside:
    for work whose results have been written elsewhere by then."""
    scopes = _open.__dict__.setdefault("scopes", [])
    mine: list[str] = []
    scopes.append(mine)
    try:
        yield
    finally:
        scopes[:] = [x for x in scopes if x is not mine]
        for path in mine:
            discard(spark, path)


def write_compact(df: DataFrame, path: str) -> None:
    """Write a table that only this package reads again: Zstandard, and the
    encodings of Parquet 2, which keep ids that follow each other as differences."""
    df.write.option("compression", "zstd").option("parquet.writer.version", "v2").parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back: an
    explicit, eager step that cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    write_compact(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
