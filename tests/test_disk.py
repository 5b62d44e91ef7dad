import os
import time

import pytest
from pyspark.sql import functions as F

from treeflow.shared import cut

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled(spark):
    """Names of the shuffle files that Spark keeps."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return {n for top in env.blockManager().diskBlockManager().localDirsString() for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files beyond those of before, when none go any more; they are removed beside the driver."""
    until = time.time() + 5
    while (more := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return more


@pytest.mark.parametrize("setting", [None, "false"])
def test_what_is_stored_leaves_no_shuffle(spark, setting):
    if setting:
        spark.conf.set(_CLEANUP, setting)
    try:
        rows = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count()
        own = sorted(map(tuple, rows.collect()))
        before = shuffled(spark)
        assert before
        out = cut(rows.repartition(3, "count"))
        assert not left(spark, before)
        assert shuffled(spark) >= before  # what others may read again stays
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect())) == own
        assert spark.conf.get(_CLEANUP, None) == setting
    finally:
        spark.conf.unset(_CLEANUP)
