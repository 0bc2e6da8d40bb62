"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


#: Tables of cut() that may still be read: (path, a weak reference of the JVM to what every plan that reads it holds).
_tables: list[tuple[str, object]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where that is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="propweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    hadoop, files = _files(spark, path)
    files.deleteOnExit(hadoop)
    return path


def sweep(spark: SparkSession) -> None:
    """Delete tables of cut() that no plan can read any more: the JVM has collected their file index."""
    # the gateway's objects, and with them the JVM's plans, hold themselves by their methods: only Python's collector
    # lets them go, and the gateway passes that on up to a second late
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # also lets Spark's cleaner delete the shuffle files of finished steps
    kept = []
    for path, held in _tables:
        try:
            if held.get() is None:
                hadoop, files = _files(spark, path)
                files.delete(hadoop, True)
            else:
                kept.append((path, held))
        except Py4JError:  # of a session that has ended
            continue
    _tables[:] = kept


def settle(spark: SparkSession) -> None:
    """Between steps with large shuffles, when no name holds them any more: wait until they can go, and sweep."""
    if abs(_shuffled(spark) - _seen["settled"]) < DUE:
        return
    gc.collect()
    time.sleep(1.1)
    sweep(spark)
    time.sleep(0.3)  # Spark's cleaner takes some time
    _seen["settled"] = _shuffled(spark)


def _shuffled(spark: SparkSession) -> int:
    """Bytes of shuffles that executors have written so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


#: Bytes of shuffles, and of tables of cut(), after which a sweep is due.
DUE = 64 << 20
_seen = {"shuffled": 0, "tables": 0, "settled": 0}


def _due(spark: SparkSession, path: str) -> bool:
    """Whether enough has been written since the last sweep, so that small inputs don't pay for one after each step."""
    hadoop, files = _files(spark, path)
    _seen["tables"] += files.getContentSummary(hadoop).getLength()
    shuffled = _shuffled(spark)
    if abs(shuffled - _seen["shuffled"]) + _seen["tables"] < DUE:
        return False
    _seen.update(shuffled=shuffled, tables=0)
    return True


def cut(df: DataFrame, what: str, tidy: bool = True) -> DataFrame:
    """Write df to the shared folder and read it back: later steps don't compute it again, and a
    lost executor costs nothing but its own tasks.  The table goes once nothing can read it, at a later
    cut with `tidy`."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    index = out._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    _tables.append((path, spark.sparkContext._jvm.java.lang.ref.WeakReference(index)))
    del df, index
    if tidy and _due(spark, path):
        sweep(spark)
    return out
