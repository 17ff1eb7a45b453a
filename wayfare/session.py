"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Streaming state is kept on disk, so it is not limited by executor heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_own_roots: set[str] = set()
_shipped: set[str] = set()


def build_session(app: str = "wayfare", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on in a session made elsewhere."""
    for key, value in {**SESSION_CONF, **STREAM_CONF}.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, if their Python does not find it (asked once a session)."""
    if spark.sparkContext.applicationId in _shipped:
        return spark

    def look(batches):
        import importlib.util

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"found": [importlib.util.find_spec("wayfare") is not None]})

    look.__module__ = "__main__"  # sent as code, since the workers may lack this module
    if not all(row.found for row in spark.range(1).mapInArrow(look, "found boolean").collect()):
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "wayfare"), "zip",
                                      os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)  # from the driver's own disk to the executors
    _shipped.add(spark.sparkContext.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session, or else the
    warehouse, which all of them share as well. Only a local session may name a local folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if base.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)  # for the training loops of Spark ML
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, deleted when the driver ends."""
    root = f"{shared_dir(spark).rstrip('/')}/wayfare/{spark.sparkContext.applicationId}"
    if root not in _own_roots:
        _own_roots.add(root)
        atexit.register(_sweep, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _sweep(spark: SparkSession, root: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove_path(spark, root)
    except Exception:  # the JVM may be gone already; clearing the folder is then left to the cluster
        pass


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and go on from that table.

    A lost executor then costs no recomputation, and the next plan starts from the table's real
    size. (``checkpoint()`` would carry the estimates along; over many steps of an iteration
    these are products of products, and planning comes to a halt.)
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled.settled_at = path
    return settled


def release(*tables: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for table in tables:
        if path := getattr(table, "settled_at", None):
            remove_path(table.sparkSession, path)
