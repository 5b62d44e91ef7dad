"""Part files as a stream (an extra: the batch operators on arriving files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graft import index_parts, part_entries
from ..sources.workdir import PART_GLOB


def part_stream(spark: SparkSession, folder: str, file_key: str, files_a_batch: int = 1000) -> DataFrame:
    """(file_key, file, payload) of part files as they arrive; each file is read once."""
    raw = spark.readStream.schema("value string").option("wholetext", True).option("pathGlobFilter", PART_GLOB).option("maxFilesPerTrigger", files_a_batch).text(folder)
    return raw.select(F.lit(file_key).alias("file_key"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("payload"))


def write_entries(parts: DataFrame, table_dir: str, checkpoint: str) -> StreamingQuery:
    """Appends the parts' entries to a Parquet folder.  A batch that is written again replaces
    its own files, so every entry lands once."""

    def put(batch: DataFrame, number: int) -> None:
        part_entries(batch).write.mode("overwrite").parquet(f"{table_dir}/batch={number}")

    return parts.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_index(spark: SparkSession, table_dir: str) -> DataFrame:
    """The index over all entries so far."""
    return index_parts(spark.read.parquet(table_dir).drop("batch"))
