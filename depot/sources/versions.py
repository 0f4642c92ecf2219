"""Tables that are replaced whole or not at all: version folders and a pointer.

``replace`` writes a new version folder beside the old one and then puts its
name into a small pointer file, by a rename.  Until that moment, and for good
if the write fails, readers get the old version.  The version before the
current one is kept for readers that planned with it; older ones and the
remains of failed writes go with the next replace.

``compact`` packs small files into larger ones by their bytes.  The scan itself
does the packing (its partitions are filled up to the target with whole files),
so nothing is shuffled, and each scan task writes one file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depot.sources import storage

_POINTER = "_current"
TARGET_BYTES = 128 << 20
#: Folders of one compaction job: a plan has a scan for each.
_FOLDERS_AT_ONCE = 100


def current(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table now; None where there is no table."""
    named = storage.read_text(spark, f"{path}/{_POINTER}")
    return f"{path}/{named.split()[0]}" if named else None


def _put(spark: SparkSession, path: str, version: str) -> None:
    """Point ``path`` at ``version``; keep the version before it, drop others."""
    named = (storage.read_text(spark, f"{path}/{_POINTER}") or "").split()
    storage.put_text(spark, f"{path}/{_POINTER}", " ".join([version, *named[:1]]))
    for other in storage.folders(spark, path):
        if other.startswith("v-") and other not in (version, *named[:1]):
            storage.delete(spark, f"{path}/{other}")


def _new(path: str) -> str:
    return f"v-{uuid.uuid4().hex[:12]}"


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists") -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path`` by ``df``, which may read that table."""
    spark, version = df.sparkSession, _new(path)
    _write(df, f"{path}/{version}", partition_by)
    _put(spark, path, version)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to the table at ``path`` (a first chunk makes the table)."""
    spark = df.sparkSession
    folder = current(spark, path)
    if folder is None:
        replace(df, path, partition_by)
    else:
        _write(df, folder, partition_by, "append")


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a table."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)


@contextmanager
def _packed_by(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Scans planned inside fill their partitions with whole files up to the target."""
    conf = {"spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] = (), target_bytes: int = TARGET_BYTES,
            sort_cols: Sequence[str] = (), schema: T.StructType | None = None) -> DataFrame:
    """Rewrite the table at ``path`` in place with files of about
    ``target_bytes`` and return it.

    Without ``sort_cols`` the scan packs the files of each partition folder: of
    two files packed one after another the bytes read are above the target, so
    all but one file of a folder come from half the target or more, and none
    from more than the target.  With ``sort_cols`` the rows are ranged over as
    many files as the bytes ask for.  The swap is that of ``replace``."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    files = storage.data_files(spark, folder)
    full = read(spark, path, schema)
    version = _new(path)
    with _packed_by(spark, target_bytes):
        if sort_cols:
            n = max(1, -(-sum(f.size for f in files) // target_bytes))
            _write(full.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols), f"{path}/{version}", partition_by)
        else:
            sizes: dict[str, int] = {}
            for f in files:
                top = f.path.rsplit("/", 1)[0]
                sizes[top] = sizes.get(top, 0) + f.size
            tops = sorted(sizes)
            for i in range(0, len(tops), _FOLDERS_AT_ONCE):
                parts = [_folder(spark, top, full, partition_by) for top in tops[i:i + _FOLDERS_AT_ONCE]]
                _write(reduce(DataFrame.unionByName, parts), f"{path}/{version}", partition_by, "append")
    _put(spark, path, version)
    return read(spark, path, schema)


def _folder(spark: SparkSession, top: str, full: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """One partition folder, with the partition columns that its name gives."""
    plain = T.StructType([f for f in full.schema if f.name not in partition_by])
    values = dict(x.split("=", 1) for x in top.split("/") if "=" in x)
    named = [F.lit(None if values[c] == "__HIVE_DEFAULT_PARTITION__" else unquote(values[c])).cast(full.schema[c].dataType).alias(c) for c in partition_by]
    return spark.read.schema(plain).parquet(top).select("*", *named).select(*full.columns)
