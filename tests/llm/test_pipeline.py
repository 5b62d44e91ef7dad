import shutil
from collections import Counter

import pytest

from tests.conftest import DATA

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it kept, over the table with rows added."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    fox = "The quick brown fox jumps over the lazy dog while she waits for the other one to come"
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").filter("length(text) > 100").first().text
    extra = [(10_000, None, "en", "s", 0), (10_001, "12 - 34", "en", "s", 7), (10_002, fox, None, None, None), (10_003, fox.upper(), "en", "s", 9), (10_004, f"{fox} and {item}", "en", "s", 9), (10_005, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    docs.write.parquet(f"{folder}/in")
    seen, now = [], spark.read.parquet(f"{folder}/in")
    for k, (name, f) in enumerate(pipeline.STAGES):
        out = f(spark, now, DATA)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{folder}/{k}")
        seen.append((name, now.collect(), (then := spark.read.parquet(f"{folder}/{k}")).collect()))
        now = then
    return seen


def test_language_stage(stages):
    _, given, kept = stages[0]
    gone = {r.doc_id for r in given} - {r.doc_id for r in kept}
    assert {10_000, 10_001, 10_005} <= gone and 10_002 not in gone
    assert all(not any(c.isalpha() for c in r.text or "") or r.doc_id in gone for r in given if r.doc_id in gone)
    assert len(gone) < 0.05 * len(given)


def test_line_stage(stages):
    from tests.llm.test_line_dedup import brute

    _, given, kept = stages[1]
    own = Counter((r[0], r[3]) for r in brute([(r.doc_id, r.text) for r in given], 10, 1).elements())
    assert Counter((r.doc_id, r.text) for r in kept) == own
    assert all(r.n_chars == len(r.text) for r in kept)


def test_near_duplicate_stage(stages):
    from tests.llm.test_jaccard import brute

    _, given, kept = stages[2]
    own = {i for (i, _, c), n in brute([(r.doc_id, r.text) for r in given]).items() if i == c}
    assert sorted(r.doc_id for r in kept) == sorted(own) and 10_003 not in own


def test_decontamination_stage(stages, spark):
    from tests.llm.test_winnow import brute

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    _, given, kept = stages[3]
    own = {r[0] for r in brute([(r.doc_id, r.text) for r in given], items) if not r[4]}
    assert {r.doc_id for r in kept} == own and 10_004 not in own


def test_packing_stage(stages):
    _, given, pieces = stages[4]
    assert {r.doc_id for r in pieces} == {r.doc_id for r in given}
    size = Counter()
    for r in pieces:
        size[r.sequence_id] += r.length
    assert max(size.values()) <= 2048


def test_run(spark):
    out = pipeline.run(spark, DATA)
    assert out.count() > 0 and "sequence_id" in out.columns
    shutil.rmtree("spark-warehouse", ignore_errors=True)


def test_empty_tables_and_null_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/none/benchmark.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
    # a null in every column, and a text that line dedup empties
    rows = [(None, None, None, None, None), (None, "Words without an id stand here", None, None, None), *((i, "The same line of words", "en", None, None) for i in range(12))]
    spark.read.parquet(f"{DATA}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/few/benchmark.parquet")
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{tmp_path}/few/documents.parquet")
    pieces = pipeline.run(spark, f"{tmp_path}/few").collect()
    assert sorted(r.doc_id for r in pieces if r.doc_id is not None) == list(range(12)) and sum(r.doc_id is None for r in pieces) == 1
    assert all(r.length == 1 for r in pieces if r.doc_id is not None)
