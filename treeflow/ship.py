"""Makes this package importable in Python workers, and bounds what they are sent at once."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Spark counts rows only: 10,000 whole texts or sets are 40 MB and more, which an executor
#: holds several times outside of its heap for each task, and each Python worker again.
BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors, once for each application.

    Workers unpickle functions by module name, so a worker without the package on its path
    could not run them.  Spark serves the archive itself; no shared folder is needed.

    Also bounds the bytes of the session's Arrow batches, unless the session sets a bound.
    """
    if _LIMIT not in spark.conf.getAll:
        spark.conf.set(_LIMIT, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="treeflow-ship-"), "treeflow_src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(p.relative_to(root.parent)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark
