import numpy as np

from weftline.llm.neardup import hot_bands


def test_a_hash_spread_thinly_over_the_batches_is_hot(spark):
    """60 members in 8 partitions, where no batch has 64 of one hash."""
    rows = [(i, 0, 0, bytearray(np.array([7, 1000 + i], np.uint32).tobytes())) for i in range(60)]
    df = spark.createDataFrame(rows, "cls long, code long, more long, bands binary").repartition(8)
    for hot in (3, 20, 40):
        split = hot_bands(df, 2, 60, hot)
        assert len(split) == 1 and list(split.values())[0] >= 60 / hot
    assert hot_bands(df, 2, 60, 200) == {}
