"""Texts go to Python in bounded batches; results don't depend on their size."""
import pyarrow as pa

from pricelens.llm import common, jaccard_join


def test_small_batches(spark, odd, none):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    held = spark.conf.get(common._BATCH, None)
    try:
        spark.conf.unset(common._BATCH)
        common.small_batches(odd)
        assert int(spark.conf.get(common._BATCH)) == common.BATCH_BYTES
        texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('0123456789', 1000) as text")
        got = common.small_batches(texts).mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 3000 and len(got) > 5
        assert max(r["bytes"] for r in got) < 2 * common.BATCH_BYTES
        expected = sorted(map(str, jaccard_join.jaccard_components(odd).collect()))
        spark.conf.set(common._BATCH, "1000")  # a session's own size stays
        assert sorted(map(str, jaccard_join.jaccard_components(odd).collect())) == expected
        assert spark.conf.get(common._BATCH) == "1000"
        assert common.small_batches(none).count() == 0
    finally:
        spark.conf.unset(common._BATCH) if held is None else spark.conf.set(common._BATCH, held)
