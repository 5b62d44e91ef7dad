import os
import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

#: An executor of its own, whose heap is not the driver's.
SCRIPT = """
import re
from pathlib import Path

import psutil
from pyspark.sql import SparkSession

import corpus_pipeline
from treeflow.shared import give_back

conf = {"spark.master": "local-cluster[1,1,1024]", "spark.executor.memory": "1g", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": "file://FOLDER/shared", "spark.sql.shuffle.partitions": "1"}
conf["spark.executor.extraJavaOptions"] = "-XX:+UseG1GC -XX:InitialHeapSize=600m -XX:MetaspaceSize=256m -XX:+AlwaysPreTouch"
spark = SparkSession.builder.config(map=conf).getOrCreate()
spark.range(1).repartition(1).count()
own = next(p for p in psutil.Process().children(recursive=True) if "CoarseGrainedExecutorBackend" in " ".join(p.cmdline()))


def mb():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", Path(f"/proc/{own.pid}/smaps_rollup").read_text()))) // 1024


DO
"""


def executor_mb(tmp_path, do):
    import pyspark

    home = tmp_path / "home"
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():  # executors' logs go to work in Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_PYTHON": sys.executable, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(tmp_path / "local")}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    script = SCRIPT.replace("FOLDER", str(tmp_path)).replace("DO", do)
    said = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=180, cwd=tmp_path)
    assert said.returncode == 0, said.stderr[-2000:]
    return [int(x) for x in re.findall(r"MB (\d+)", said.stdout)]


def test_a_stage_begins_without_the_garbage_of_those_before(tmp_path):
    do = """
docs = spark.createDataFrame([("a", "one line")], "doc_id string, text string")
print('MB', mb()); corpus_pipeline.STAGES[1][1](spark, docs, ""); print('MB', mb())
"""
    before, after = executor_mb(tmp_path, do)
    assert before > 600 and after < before - 200


def test_a_local_session_has_no_executors(spark):
    from treeflow.shared import give_back

    status = spark.sparkContext.statusTracker()
    jobs = len(status.getJobIdsForGroup())
    give_back(spark)
    assert len(status.getJobIdsForGroup()) == jobs
