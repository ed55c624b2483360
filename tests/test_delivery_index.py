import random
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.operators.delivery_index import DeliveryIndex, _sorted_least, search, source_key, surplus_deliveries
from pyspark.sql import functions as F

SCHEMA = "delivery_id long, batch_id long, exported_at timestamp, source string, telegram_message_id long, text string"


def brute(rows):
    first = {}
    for d, _, at, s, m, _ in rows:
        if m is None:
            continue
        k = ((s or "").strip().lower(), m)
        key = (at is None, at or datetime.min, d)
        first[k] = min(first.get(k, (key, d)), (key, d))
    keep = {v[1] for v in first.values()}
    return sorted(d for d, _, _, _, m, _ in rows if m is not None and d not in keep)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(r.delivery_id for r in surplus_deliveries(df, **how).collect())


def some_rows(n, seed=1):
    rnd, t0 = random.Random(seed), datetime(2024, 9, 1)
    spell = [str, str.upper, lambda s: f" {s}\t", str.title]
    return [(i, i // 10, t0 + timedelta(hours=rnd.randrange(30)), rnd.choice(spell)(f"chan_{rnd.randrange(4)}"), rnd.randrange(40), "x") for i in range(1, n + 1)]


def test_late_and_out_of_order_batches(spark):
    rows = some_rows(300)
    for waves in (1, 3, 6):
        assert found(spark, rows, waves=waves) == brute(rows)


def test_nulls_ties_and_a_hot_message(spark):
    t = datetime(2024, 9, 1)
    rows = [(1, 1, None, "a", 1, "x"), (2, 1, t, "a", 1, "x"), (3, 1, t, "A ", 1, "y"), (4, 1, t, None, 1, None), (5, 1, t, "", 1, ""), (6, 1, t, "a", None, "x"), (7, 1, t, "a", None, "x")]
    rows += [(i, 2, t, "hot", 9, "z") for i in range(10, 210)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_further_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame(some_rows(30), SCHEMA).withColumn("did", F.lit("clash")).withColumn("s", F.lit(1))
    assert sorted(r.delivery_id for r in surplus_deliveries(df).collect()) == brute(some_rows(30))


def test_index_keeps_over_ingests_and_merges(spark):
    rows = some_rows(200, seed=5)
    df = spark.createDataFrame(rows, SCHEMA).select(source_key(F.col("source")).alias("s"), F.col("telegram_message_id").alias("m"), F.unix_micros("exported_at").alias("ts"), F.col("delivery_id").alias("did"))
    index = DeliveryIndex(spark, 200, merge_every=3)
    for k in (3, 1, 0, 2, 4):  # any order of arrival
        index.ingest(df.where(F.pmod("did", F.lit(5)) == k))
    kept = {r.did for r in index.firsts().collect()}
    assert sorted({r[0] for r in rows} - kept) == brute(rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(0, 9), st.integers(0, 99)), min_size=1))
def test_search_finds_exactly_what_is_there(rows):
    hi, lo, ts, did = (np.array(x) for x in zip(*rows))
    run = _sorted_least(hi.astype(np.uint64), lo.astype(np.uint64), ts.astype(np.int64), did.astype(np.int64))
    asked = [(a, b) for a in range(6) for b in range(6)]
    at = search(run, np.array([a for a, _ in asked], np.uint64), np.array([b for _, b in asked], np.uint64))
    for (a, b), i in zip(asked, at):
        here = [(t, d) for h, g, t, d in rows if (h, g) == (a, b)]
        assert (i >= 0) == bool(here)
        if here:
            assert (run[2][i], run[3][i]) == min(here)


def _index_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select(source_key(F.col("source")).alias("s"), F.col("telegram_message_id").alias("m"), F.unix_micros("exported_at").alias("ts"), F.col("delivery_id").alias("did"))


def test_an_index_opened_again_in_another_session_equals_one(spark, tmp_path):
    rows, path = some_rows(240, seed=9), f"file://{tmp_path}/index"
    index = DeliveryIndex(spark, 240, path=path)
    for k in (0, 1, 2):
        index.ingest(_index_rows(spark, rows).where(F.pmod("did", F.lit(6)) == k))
    other = spark.newSession()
    again = DeliveryIndex(other, path=path)
    assert again.state == index.state and len(again.runs) == 3
    for k in (3, 4, 5):
        again.ingest(_index_rows(other, rows).where(F.pmod("did", F.lit(6)) == k))
    kept = {r.did for r in again.firsts().collect()}
    assert sorted({r[0] for r in rows} - kept) == brute(rows)
    third = DeliveryIndex(spark, path=path)
    assert {r.did for r in third.firsts().collect()} == kept


def test_runs_are_read_without_a_shuffle_and_levelled(spark, tmp_path):
    rows = some_rows(200, seed=3)
    index = DeliveryIndex(spark, 200, merge_every=2, path=f"file://{tmp_path}/index")
    for k in range(5):
        index.ingest(_index_rows(spark, rows).where(F.pmod("did", F.lit(5)) == k))
    assert sorted(r["level"] for r in index.runs) == [0, 2]
    plan = index._beside(index._all(), index.runs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2  # the numbers of the prefixes only
