"""A training-corpus pipeline over `documents`: language ID, line dedup, n-gram Jaccard
join, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor kept, written as
Parquet and read again.  All but the last return the columns of `documents`; the last
returns the packed pieces.  run() deletes a stage's folder once the next one is written.
Each stage begins with executors' heaps without the garbage of those before it.

A null or empty text, and one without a letter, goes with language ID.  A text that line dedup
empties stays, is linked with nothing, and is packed as its end id alone.  Rows with a null id
all stay but for their own text's faults; rows of equal ids are judged each by its text, and
of equal ids and texts one stays.  An empty table gives no pieces.  Extra columns are carried
to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeflow.llm import jaccard_join, language_id, line_dedup, packing, winnow
from treeflow.llm._spark import documents, give_back, new_folder, ship
from treeflow.llm.queries import tokenizer_path
from treeflow.shared import remove_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts of which no language has two fifths of the letters."""
    give_back(ship(spark))
    return language_id.drop_unknown(docs, language_id.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that ten documents or more share; n_chars follows the text."""
    give_back(spark)
    out = line_dedup.drop_shared_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each linked group."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    give_back(spark)
    return winnow.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of at most 2048 ids."""
    give_back(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination), ("best-fit packing", packed)]

#: SQL cannot express the learned language model or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = new_folder(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    return docs
