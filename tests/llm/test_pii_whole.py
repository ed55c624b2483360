from weftline.llm.pii import items

SIGNS = [
    ("address", "живу на проспект абая 15"), ("address", "на улице абая 15, кв 7"), ("address", "бульвар мира 7"), ("address", "переулок тихий 4"),
    ("address", "микрорайон самал 5"), ("address", "15 abay boulevard"), ("address", "пр-кт абая 15"), ("address", "15 elm dr."), ("address", "ул. абая 15"),
    ("email", "пишите anna (ат) site.test"), ("email", "пишите anna [ит] site.test"), ("phone", "звоните 8–701–123–45–67"), ("phone", "звоните 8—701—123—45—67"),
]


def test_every_text_reaches_the_detector(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(SIGNS)], "id long, text string")
    got = {(r.id, r.kind) for r in items(df).collect()}
    assert [t for i, (k, t) in enumerate(SIGNS) if (i, k) not in got] == []
