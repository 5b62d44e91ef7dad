"""Shared session helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..shared import cut, give_back, new_folder, own_shuffles, remove_folder, shared_dir  # noqa: F401
from ..ship import ship


def with_places(docs: DataFrame) -> DataFrame:
    """docs with columns named by place (_0, _1, ...), so that no name can clash."""
    return docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))


def fields(df: DataFrame, columns: list[str], more: str) -> T.StructType:
    """Schema of some columns of df followed by those of a DDL string."""
    return T.StructType([*(df.schema[c] for c in columns), *T._parse_datatype_string(more).fields])


def stored(df: DataFrame, folder: str) -> DataFrame:
    """df, written as Parquet to a folder of new_folder() and read back: a checkpoint that is packed."""
    with own_shuffles(df) as own:
        own.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
