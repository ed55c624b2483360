import pytest
from pyspark.sql import functions as F

from weftline.functions import text as T

# The literal fixture of FIXTURES.md, section 3 (rows whose class follows from the rules).
FIXTURE = [
    ("hi", "EXCLUDE", "too_short", 0, "latin", "en"),
    ("what time does the gym open?", "SAFE_STYLE_REFERENCE", "", 4, "latin", "en"),
    ("aaaaaaaaaaaaaaaa is how i feel", "EXCLUDE", "noise", 2, "latin", "en"),
    ("!!! ??? ... *** ((( ))) ---", "EXCLUDE", "noise", 5, "other", "ru"),
    ("write me at someone@example.org today", "EXCLUDE", "contact_information", 2, "latin", "en"),
    ("call +7 (700) 123-45-67 after class", "EXCLUDE", "contact_information", 2, "latin", "en"),
    ("is that guy from the library single or not", "EXCLUDE", "personal_identification_request", 2, "latin", "en"),
    ("кто эта девушка из второй группы", "EXCLUDE", "targeted_person_reference", 2, "cyrillic", "ru"),
    ("today only скидка on all my notes", "EXCLUDE", "advertisement", 4, "mixed", "ru_en"),
    ("my essex train was late again today", "EXCLUDE", "sensitive_content", 2, "latin", "en"),
    ("дебил сломал принтер опять сегодня", "EXCLUDE", "targeted_harassment", 2, "cyrillic", "ru"),
    ("lorem " * 99 + "lorem", "REVIEW", "", 0, "latin", "en"),
    ("го в кино сегодня вечером bro 😂😂", "SAFE_STYLE_REFERENCE", "", 6, "mixed", "ru_en"),
    ("я не знаю что мне делать с экзаменом...", "SAFE_STYLE_REFERENCE", "", 4, "cyrillic", "ru"),
    ("мен бүгін ұйықтап қалдым", "SAFE_STYLE_REFERENCE", "", 3, "cyrillic", "kz"),
    ("я сегодня бүгін поздно встал рано лёг", "SAFE_STYLE_REFERENCE", "", 3, "cyrillic", "ru"),
    ("я сегодня бүгін поздно встал", "SAFE_STYLE_REFERENCE", "", 3, "cyrillic", "ru_kz"),
    ("12345 67890 !!", "EXCLUDE", "too_short,contact_information", 0, "other", "ru"),
    ("как вы учите слова так быстро??", "SAFE_STYLE_REFERENCE", "", 5, "cyrillic", "ru"),
    ("ё ё ё ё ё ё ё ё ё", "SAFE_STYLE_REFERENCE", "", 2, "other", "ru"),
]


def test_literal_fixture(spark):
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(FIXTURE)], "i int, text string").withColumn("t", T.normalize("text"))
    out = d.select("i", T.reasons("t").alias("r"), T.style_score("t").alias("s"), T.script("t").alias("script"), T.word_language("t").alias("lang"))
    rows = out.select("i", T.classification(F.col("r"), F.col("s")).alias("c"), F.array_join("r", ",").alias("f"), "s", "script", "lang").orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == [r[1:] for r in FIXTURE]


@pytest.mark.parametrize("text", [None, "", " ", "﻿", "x" * 50_000, "а б " * 20_000])
def test_any_text_has_features(spark, text):
    d = spark.createDataFrame([(text,)], "text string").withColumn("t", T.normalize(F.coalesce("text", F.lit(""))))
    f = T.features("t")
    r = d.select(*[c.alias(k) for k, c in f.items()], T.reasons("t").alias("r"), T.question_type("t").alias("q")).first()
    assert r.length == len(" ".join((text or "").split())) or text == "﻿"


def test_grams_and_jaccard(spark):
    d = spark.createDataFrame([("a b c d e f", "a b"), ("a b", "c d"), ("", "")], "x string, y string")
    r = d.select(T.grams(F.split("x", " "), 5).alias("g"), T.jaccard(F.split("x", " "), F.split("y", " ")).alias("j")).collect()
    assert r[0].g == ["a b c d e", "b c d e f"] and r[1].g == [] and abs(r[0].j - 2 / 6) < 1e-12 and r[1].j == 0
