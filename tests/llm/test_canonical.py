import pytest
from pyspark.sql import functions as F

from weftline.llm.canonical import with_canonical
from weftline.llm.lookalike import lookalike_pairs

SAME = [
    ("привет мир", "пpивeт мир"), ("hello world", "hеllо wоrld"), ("кофе 15", "кофе １５"), ("ёлка", "ёлка"), ("йод", "йод"),
    ("a b", "a b"), ("тихо, да", "ти​хо， да"), ("so many", "ѕо mаnу"), ("кто", "ктο"), ("да", "да "), ("file", "ﬁle"), ("СОН", "COH"),
    ("на 👩‍💻 все", "на‍ 👩‍💻 вcе"),
]
DIFFERENT = [("Привет", "привет"), ("cafe", "café"), ("x2", "x²"), ("елка", "ёлка"), ("кот", "кит"), ("a b", "ab"), ("бот", "bot")]


def keys(spark, texts):
    d = with_canonical(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), "text")
    return {r.i: (r.canonical, r.form_key) for r in d.collect()}


def test_what_looks_the_same_is_equal(spark):
    k = keys(spark, [t for p in SAME for t in p])
    for i in range(0, 2 * len(SAME), 2):
        assert k[i] == k[i + 1], SAME[i // 2]


def test_what_looks_different_stays_different(spark):
    k = keys(spark, [t for p in DIFFERENT for t in p])
    for i in range(0, 2 * len(DIFFERENT), 2):
        assert k[i][1] != k[i + 1][1] and k[i][0] != k[i + 1][0], DIFFERENT[i // 2]


def test_null_blank_long_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " ​ ", "x"), (4, "пpи" * 30_000, "x")], "id int, text string, canonical string").withColumn("c0", F.lit(7)).withColumn("batch", F.lit("b"))
    rows = {r.id: r for r in with_canonical(d, "text").collect()}
    assert rows[1].canonical is None and rows[1].form_key is None and rows[2].canonical == "" and rows[3].canonical == ""
    assert rows[4].canonical == "при" * 30_000 and rows[4].c0 == 7 and rows[4].batch == "b"
    assert with_canonical(d.limit(0), "text").count() == 0


@pytest.mark.parametrize("block", [2, 20_000])
def test_pairs_against_brute_force(spark, block):
    texts = ["мне лень", "мнe лeнь", "мне лень", "Мне лень", None, "...", "．．．", "x²", "x2", "мне лень"] * 3
    rows = [(i, f"S{i % 3}", i % 7, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "delivery_id long, source string, telegram_message_id long, text string")
    k = keys(spark, texts)
    want = {(a, b) for a, s, m, t in rows for b, s2, m2, t2 in rows if a < b and t and t2 and t != t2 and k[a][1] == k[b][1] and (s, m) != (s2, m2) and any(c.isalpha() for c in t)}
    got = [(r.a, r.b) for r in lookalike_pairs(df, block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert lookalike_pairs(df.limit(0)).count() == 0


def test_large_batches_go_in_portions(spark, monkeypatch):
    import pyarrow as pa

    from weftline.llm import canonical as C

    monkeypatch.setattr(C, "PORTION", 100)
    b = pa.RecordBatch.from_pydict({"i": list(range(50)), "text": ["пpи " + "ы" * 30] * 49 + ["x" * 5_000]})
    out = pa.Table.from_batches(list(C.duckdb_batches("SELECT i, length(text) AS n FROM batch", iter([b]))))
    assert out["i"].to_pylist() == list(range(50)) and out["n"].to_pylist()[-1] == 5_000
