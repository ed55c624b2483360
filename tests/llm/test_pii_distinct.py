import itertools

from pyspark.sql import functions as F

from weftline.llm.pii import _number, parts, surrogate, surrogates


def test_more_names_than_short_surrogates_stay_distinct(spark):
    """18 ** 3 Kazakh surnames of three syllables are fewer than these."""
    names = ["А. " + "".join(x).capitalize() for x in itertools.islice(itertools.product("әіңғқөұ", repeat=5), 7_000)]
    rows = [(i, "name", "", n) for i, n in enumerate(names)] + [(7_000 + i, "address", "", f"ул. {n[3:]} 5") for i, n in enumerate(names)] + [(1, "phone", "7823642322", "8 782 364 23 22")]
    got = surrogates(spark.createDataFrame(rows, "id long, kind string, key string, entity string"), b"k")
    plain = F.lower("surrogate")
    assert {r.kind: (r.n, r.d) for r in got.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct(plain).alias("d")).collect()} == {"name": (7_000, 7_000), "address": (7_000, 7_000), "phone": (1, 1)}


def test_a_part_keeps_its_surrogate_whatever_stands_beside_it(spark):
    """Many surnames clash; a surname has one surrogate with every given name, in every gender and case."""
    stems = ["".join(x) for x in itertools.islice(itertools.product("бвгдз", "аеиоу", "клмнр", "аеиоу", "бвгдж", "аеиоу", "пст"), 8_000)]
    rows = [(f"{g} {s.capitalize()}{e}",) for s in stems for g, e in (("Иван", "ов"), ("Анна", "ова"))] + [("Олег Бакабапову",), ("БАКАБАПОВ И. О.",)]
    got = {r.entity: r.surrogate for r in surrogates(spark.createDataFrame(rows, "entity string").withColumn("kind", F.lit("name")), b"k").collect()}
    assert len(got) == len(set(got.values())) == len(set(rows))
    he, she = got["Иван Бакабапов"].split()[1], got["Анна Бакабапова"].split()[1]
    assert he + "а" == she and got["Олег Бакабапову"].split()[1] == he + "у" and got["БАКАБАПОВ И. О."].split()[0] == he.upper()


def test_numbers_and_keys():
    assert sorted(int(_number(b"k", str(i))) for i in range(10, 100)) == list(range(10, 100))
    assert surrogate("name", "Иван Петров", b"k") != surrogate("name", "Иван Петров", b"l")
    assert [t for t, _, _ in parts("address", "ул. Абая 15, кв. 7", b"k")] == ["street-ru"]
    a, b = surrogate("email", "anna@site.test", b"k"), surrogate("email", "anna (at) site dot test", b"k")
    assert a.partition("@")[0] == b.split()[0] and a.endswith(".test") and "site" not in a + b
