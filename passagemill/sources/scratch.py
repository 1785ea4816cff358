"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
#: Spark's setting for deleting a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables that this application wrote and has not deleted.
_WRITTEN: list[str] = []
#: Seconds between two trims of the driver, and when the last one was.
TRIM_EVERY = 5.0
_trimmed = float("-inf")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; only a local session that names none (tests) gets a temporary one."""
    found = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{KEY} must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="passagemill-")
        spark.conf.set(KEY, found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/passagemill/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def trim(spark: SparkSession) -> bool:
    """Give back to the system what the driver's JVM has freed outside its heap; whether that was done.

    The compilers of a JVM that plans and runs very many queries leave hundreds of MB of freed memory in malloc's arenas, which only
    grows. JVMs without this command go on as they are.
    """
    java, new = spark.sparkContext._jvm.java, spark.sparkContext._gateway.new_array
    try:
        args = new(java.lang.Object, 4)
        args[0] = spark.sparkContext._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        args[1] = "systemTrimNativeHeap"
        # by the interface, as py4j doesn't see the methods of the server's own class
        (invoke,) = [m for m in java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke"]
        invoke.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return False
    return True


def _trim_at_times(spark: SparkSession) -> None:
    global _trimmed
    if time.monotonic() - _trimmed >= TRIM_EVERY:
        _trimmed = time.monotonic()
        trim(spark)


@contextlib.contextmanager
def without_leftovers(spark: SparkSession):
    """Shuffle files of the queries that are run within go as soon as each has ended; else they stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, lost executors lose nothing. The write's own shuffle files are deleted."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with without_leftovers(spark):
        df.write.parquet(path)
    _WRITTEN.append(path)
    _trim_at_times(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of materialize() that no frame in use reads any more."""
    path = df.__dict__.get("_scratch")
    if path:
        _delete(df.sparkSession, path)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


def mark() -> int:
    """A point after which tables can be discarded."""
    return len(_WRITTEN)


def discard_since(spark: SparkSession, point: int, *kept: DataFrame) -> None:
    """Delete the tables that were written after the point, but those of the kept frames: for the end of a stage whose result is written."""
    stay = {df.__dict__.get("_scratch") for df in kept}
    for path in [p for p in _WRITTEN[point:] if p not in stay]:
        _delete(spark, path)
    _WRITTEN[point:] = [p for p in _WRITTEN[point:] if p in stay]


def drop_all(spark: SparkSession) -> None:
    """Delete all scratch tables in the shared folder: for the end of a job that no other job shares the folder with."""
    _delete(spark, f"{shared_dir(spark)}/passagemill")
    _WRITTEN.clear()
