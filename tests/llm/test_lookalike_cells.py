from weftline.llm.lookalike import lookalike_pairs, string_pairs


def test_one_variant_of_a_hot_string_costs_one_pair_of_strings(spark):
    strings = spark.createDataFrame([("form", 1, 50), ("form", 2, 1), ("other", 5, 1), ("other", 6, 1), ("other", 7, 2)], "k string, h long, cells int")
    for block in (2, 20_000):
        got = [tuple(r) for r in string_pairs(strings, block).collect()]
        assert len(got) == len(set(got)) and sum(r[0] == "form" for r in got) == 50  # the cells of the first by that of the second
        assert sorted((r[1], r[2], r[3], r[4]) for r in got if r[0] == "other") == [(5, 0, 6, 0), (5, 0, 7, 0), (5, 0, 7, 1), (6, 0, 7, 0), (6, 0, 7, 1)]


def test_a_hot_form_pairs_every_row_with_its_variant(spark):
    rows = [(i, "s", i, "мне лень") for i in range(300)] + [(900, "s", 900, "мнe лeнь")]
    df = spark.createDataFrame(rows, "delivery_id long, source string, telegram_message_id long, text string")
    assert {(r.a, r.b) for r in lookalike_pairs(df, block=20).collect()} == {(i, 900) for i in range(300)}
