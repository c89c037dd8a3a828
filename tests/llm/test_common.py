import pyarrow as pa
from pyspark.sql import functions as F

from keytally.llm import common


def test_tables_are_written_through_small_batches(spark):
    """What both sides of a Python worker hold at once is bounded in bytes, not by ten thousand long texts."""
    docs = spark.range(0, 3000, 1, 1).withColumn("text", F.repeat(F.lit("word "), 2000))

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    before = spark.conf.get(common.BATCH)
    got = common.shared_table(docs.mapInArrow(measure, "n long, bytes long"), "measured").agg(F.sum("n"), F.max("bytes")).first()
    assert got[0] == 3000 and got[1] <= 5 << 20
    assert spark.conf.get(common.BATCH) == before
