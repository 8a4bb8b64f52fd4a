import pyarrow as pa
from docledger.llm import common

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_the_bound_on_batches_is_set_once_and_a_smaller_one_stays(spark):
    before = spark.conf.get(NAME)
    try:
        for now, want in (("67108864", common.BATCH_BYTES), ("4096", 4096), ("64m", common.BATCH_BYTES)):
            spark.conf.set(NAME, now)
            common.bounded(spark)
            assert int(spark.conf.get(NAME).rstrip("b")) == want
    finally:
        spark.conf.set(NAME, before)


def test_slices_hold_every_row_once():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], names=["x"]) for n in (0, 1, 256, 700)]
    parts = list(common.sliced(iter(batches)))
    assert max(p.num_rows for p in parts) == 256 and [x for p in parts for x in p.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]
