"""The folder that driver and executors share, and the disk and memory that is given back."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.

    Only where that is unset in a local session, as in tests, is a temporary folder chosen; on a
    cluster, whose executors would each write to a disk of their own, it is an error."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        with contextlib.suppress(Exception):
            have = spark.sparkContext.getCheckpointDir()
            have = have and have.rsplit("/", 1)[0]  # without the folder Spark made below it
    if not have:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        have = "file://" + tempfile.mkdtemp(prefix="treeflow-")
        spark.sparkContext.setCheckpointDir(have)
    return have.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def own_shuffles(df: DataFrame) -> Iterator[DataFrame]:
    """df for one action that stores it: what the action shuffles goes from the executors' disks
    with its end, not when the driver happens to collect its garbage.

    A plan takes the setting when it is made, so that this is a plan of its own: df itself and
    what is derived from it keep their shuffles."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        yield df.select("*")
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """df, stored in the shared folder, without its lineage."""
    shared_dir(df.sparkSession)
    with own_shuffles(df) as own:
        return own.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Deletes a folder of new_folder() that no table is read from any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back(spark: SparkSession) -> None:
    """Has each executor collect its garbage, so that its heap shrinks to a few times what it holds.

    A heap grows to its limit over the stages of a long run though little in it is in use, and
    what it once took it keeps, beside direct buffers and the Python workers.  One short task for
    each executor; one that is busy meanwhile may be missed.  A local session has none."""
    n = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1  # without the driver
    if n > 0:
        spark.range(0, n, 1, n).selectExpr("java_method('java.lang.System', 'gc')").collect()
