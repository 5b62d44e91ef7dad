import pyarrow as pa

from treeflow.ship import BATCH_BYTES, ship

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(session):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["n", "rows"])

    rows = session.range(4000).repartition(1).selectExpr("repeat('x', 4000) t").mapInArrow(run, "n long, rows long").collect()
    assert sum(r.rows for r in rows) == 4000
    return max(r.n for r in rows)


def test_batches_of_long_texts_are_bounded(spark):
    assert largest_batch(ship(spark.newSession())) <= BATCH_BYTES + 10_000


def test_a_bound_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(LIMIT, 1 << 20)
    assert ship(own).conf.get(LIMIT) == str(1 << 20)
    assert largest_batch(own) <= (1 << 20) + 10_000
