"""Serving tables with a primary key: the last write of a key wins.

An upsert appends its rows in a folder of its own, named by who writes and the number of the batch, and
a read takes the newest row per key. So an upsert costs as much as its batch, whatever the table
holds; writing a batch again after a failure replaces it; a reader never sees half a batch; and writers
that know nothing of each other (a stream, a job, a stream restarted from nothing) keep apart.
``compact`` folds the batches that are there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfare.schemas import MATCH, SERVING_KEYS
from wayfare.session import remove_path

COLUMNS = {
    "vehicle_positions": "city string, zone_id int, event_time bigint, taxi_id int, "
                         "latitude double, longitude double, speed double, status string",
    "trips": MATCH,
    "demand_zones": "city string, zone_id int, window_start bigint, active_vehicles int, "
                    "pending_requests int, ratio double",
}


def stage(table: str) -> Column:
    """Which of two rows of a key in one batch is the later one: a decision comes after a request."""
    return F.when(F.col("status") == "PENDING", 0).otherwise(1) if table == "trips" else F.lit(0)


def _newest(rows: DataFrame, table: str, order: list[str]) -> DataFrame:
    """One row per key, the last in the order of some numbers; of equal ones the smallest values."""
    partition, rest = SERVING_KEYS[table]
    keys = partition + rest
    values = [name for name in rows.columns if name not in (*keys, *order)]
    first = F.struct(*[(-F.col(name)).alias(f"_{name}") for name in order], *order, *values)
    return rows.groupBy(*keys).agg(F.min(first).alias("_row")).select(
        *keys, *[f"_row.{name}" for name in (*order, *values)])


def upsert(df: DataFrame, path: str, table: str, batch: int, writer: str = "job",
           order: Column | None = None) -> None:
    """Write one batch of a writer. Of rows with one key the last by ``order`` stays (by default, for
    trips, the decision); a later commit wins over an earlier one, whoever wrote it."""
    partition, _ = SERVING_KEYS[table]
    names = [part.split()[0] for part in COLUMNS[table].split(", ")]
    rows = df.withColumn("_order", stage(table) if order is None else order).select(*names, "_order")
    # static: a repeated batch replaces all of its first attempt, not only the same partitions
    _newest(rows, table, ["_order"]).drop("_order").withColumn(
        "committed", F.lit(time.time_ns() // 1000)).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy(*partition).parquet(
        f"{path.rstrip('/')}/writer={writer}/batch={batch}")


def upsert_stream(path: str, table: str, writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the stream's batch number makes a repeated batch harmless. Each checkpoint
    needs a writer name of its own."""
    return lambda df, batch: upsert(df, path, table, batch, writer)


def _rows(spark: SparkSession, base: str, table: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(f"{COLUMNS[table]}, committed bigint, writer string, batch bigint").option(
        "basePath", base).parquet(*paths)


def read_serving(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Current rows, one per key."""
    rows = _rows(spark, path, table, [path])
    return _newest(rows, table, ["committed", "batch"]).drop("committed", "writer", "batch")


def newest_first(df: DataFrame, table: str) -> DataFrame:
    """The clustering order of the table, within its partitions."""
    partition, rest = SERVING_KEYS[table]
    first, *ties = rest
    return df.orderBy(*partition, F.desc(first), *ties)


def compact(spark: SparkSession, path: str, table: str) -> None:
    """Fold the batches that are there into one, then delete them.

    Rows keep the time of their commit, so writers may go on meanwhile, and between the two steps
    a reader merely finds rows twice. A read that has already listed the old files may fail and
    has to be repeated.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/writer=*/batch=*")
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    old = [status.getPath().toString() for status in listed or []]
    if len(old) < 2:
        return
    partition, _ = SERVING_KEYS[table]
    rows = _newest(_rows(spark, path, table, old), table, ["committed", "batch"])
    rows.drop("writer", "batch").write.partitionBy(*partition).parquet(
        f"{path.rstrip('/')}/writer=compact-{uuid.uuid4().hex}/batch=0")
    for folder in old:
        remove_path(spark, folder)
