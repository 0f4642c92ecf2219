"""Commit records of streamed tables.

A micro-batch writes several tables, each into its own attempt folder.  What
makes the batch visible is one small record, written last and put in place by
a rename: readers look at the records first and open only the folders named
there.  A batch that broke between two tables has no record, so none of its
rows is seen, in any table, until its replay commits.

A record holds the batch, its attempt and the rows of every table, as counted
while the tables were written; ids of later batches continue from these.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depot.session import write_compact
from depot.sources import storage

FIRST = -1                                  # the record written before any batch
RECORD = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType()),
                       T.StructField("counts", T.MapType(T.StringType(), T.LongType()))])


def _record(sink: str, batch_id: int) -> str:
    return f"{sink}/_commits/{batch_id}.json"


def start(spark: SparkSession, sink: str) -> None:
    """Make ``sink`` a streamed table folder (once; a restart finds it so)."""
    if not storage.exists(spark, _record(sink, FIRST)):
        storage.put_text(spark, _record(sink, FIRST), json.dumps({"batch_id": FIRST, "attempt": "", "counts": {}}))


def records(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, attempt, counts) of all committed batches.  The first record
    always exists, so any error in reading them is an error of the caller."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(f"{sink}/_commits").filter(F.col("batch_id") > FIRST)


def row_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, table_name, row_count): a row per committed batch and table."""
    return records(spark, sink).select("batch_id", F.explode("counts").alias("table_name", "row_count"))


def read(spark: SparkSession, sink: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The committed rows of a streamed table.  ``schema`` is needed only where
    no batch has been committed yet: the result is then empty."""
    done = records(spark, sink).filter(F.map_contains_key("counts", F.lit(name))).select("batch_id", "attempt").collect()   # a row per batch
    if not done:
        if schema is None:
            raise ValueError(f"no committed batch of {name} in {sink}")
        return spark.createDataFrame([], schema)
    paths = [f"{sink}/{name}/batch_id={r['batch_id']}/attempt={r['attempt']}" for r in sorted(done)]
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


class Batch:
    """One attempt at a micro-batch: ``write`` its tables, then ``commit``."""

    def __init__(self, spark: SparkSession, sink: str, batch_id: int):
        self.spark, self.sink, self.batch_id = spark, sink, batch_id
        self.attempt, self.counts = uuid.uuid4().hex[:12], {}

    def committed(self) -> bool:
        return storage.exists(self.spark, _record(self.sink, self.batch_id))

    def earlier(self, name: str) -> int:
        """Rows of a table in the batches before this one."""
        rows = records(self.spark, self.sink).filter(F.col("batch_id") < self.batch_id)
        return rows.agg(F.coalesce(F.sum(F.col("counts")[name]), F.lit(0)).alias("n")).first()["n"]

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of this attempt, counting its rows on the way, and read it back."""
        path, seen = f"{self.sink}/{name}/batch_id={self.batch_id}/attempt={self.attempt}", Observation()
        write_compact(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
        self.counts[name] = seen.get["n"]
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> None:
        """Make the tables written visible together, and drop what attempts
        that never got here left behind."""
        storage.put_text(self.spark, _record(self.sink, self.batch_id),
                         json.dumps({"batch_id": self.batch_id, "attempt": self.attempt, "counts": self.counts}))
        for name in self.counts:
            top = f"{self.sink}/{name}/batch_id={self.batch_id}"
            for other in storage.folders(self.spark, top):
                if other != f"attempt={self.attempt}":
                    storage.delete(self.spark, f"{top}/{other}")
