import pyarrow as pa

from tidemark.llm import common
from tidemark.llm.common import BATCH_BYTES, BATCH_SETTING
from tidemark.llm.substring import staged


def largest_batch(spark):
    """Bytes of the largest batch of 20 MB of rows in one partition that reaches Python in a staged job."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["size", "n"])

    rows = spark.range(0, 2000, 1, 1).selectExpr("repeat(cast(id % 10 as string), 10000) AS text").mapInArrow(sizes, "size long, n long")
    out = staged(rows, "sizes").selectExpr("max(size) AS size", "sum(n) AS n").first()
    assert out["n"] == 2000
    return out["size"]


def test_staged_jobs_send_python_small_batches(spark):
    assert largest_batch(spark) < 2 * BATCH_BYTES
    assert BATCH_SETTING not in spark.conf.getAll


def test_a_limit_of_the_session_stays(spark):
    spark.conf.set(BATCH_SETTING, 1 << 20)
    try:
        assert largest_batch(spark) < 2 << 20
        assert spark.conf.getAll[BATCH_SETTING] == str(1 << 20)
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_the_limit_goes_when_a_job_fails(spark):
    try:
        with common.small_batches(spark):
            raise KeyError
    except KeyError:
        pass
    assert BATCH_SETTING not in spark.conf.getAll
