import itertools
import json
import random

from pyspark.sql import functions as F

from weftline.operators import scoring
from weftline.operators.allocation import assign_seeds, chunks, draw, slots, type_seed_pairs
from weftline.operators.selection import Aims, blocked, objective, select_diverse
from weftline.sources.channels import ChannelSource
from weftline.sources.exports import read_export, write_export
from weftline.sources.provider import FatalProviderError, failure_ratio, respond, with_retries


def row(i, rnd):
    return {"id": i, "score": rnd.uniform(4, 10), "formulaic": rnd.random() < 0.2, "ai_feel": rnd.random() < 0.1, "post_type": rnd.choice("abc"), "topic": rnd.choice("wxyz"), "language": rnd.choice(["ru", "kz"]), "lenband": rnd.randrange(7), "is_question": rnd.random() < 0.4, "advice": rnd.random() < 0.2, "patterns": rnd.choice(["", "p", "p,q"]), "opener1": rnd.choice("klmno"), "opener2": rnd.choice(["k l", "m n", "o p"]), "ending": "q", "casing": rnd.choice(["lower", "upper"]), "shape": "s1_fp", "tells": rnd.randrange(3), "emoji": rnd.random() < 0.5, "seed_id": rnd.randrange(12), "theme_key": rnd.choice("rstuv"), "v": [1.0, 0.0] if rnd.random() < 0.1 else [0.6, 0.8], "stems": rnd.sample("abcdefgh", 3)}


def test_selection_equals_the_sequential_one(spark):
    rnd = random.Random(2)
    rows = [row(i, rnd) for i in range(40)]
    for r in rows:
        r["v"] = None
    aims = Aims([0.5] * 7, {"casing": {"lower": 2, "upper": 3}, "emoji": {True: 2, False: 3}}, 3)
    chosen = []
    while len(chosen) < 4:
        ok = [r for r in rows if r not in chosen and not blocked(chosen, r, aims)]
        if not ok:
            break
        base = objective(chosen, aims)
        chosen.append(max(ok, key=lambda r: (objective([*chosen, r], aims) - base, -r["id"])))
    kinds = {"id": "long", "score": "double", "formulaic": "boolean", "ai_feel": "boolean", "lenband": "int", "is_question": "boolean", "advice": "boolean", "tells": "int", "emoji": "boolean", "seed_id": "long", "v": "array<double>", "stems": "array<string>"}
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in rows[0]))
    got = select_diverse(df, aims, k=4, passes=0).orderBy("position").collect()
    assert [r.id for r in got] == [r["id"] for r in chosen]
    assert abs(got[0].objective - objective(chosen, aims)) < 1e-6
    assert select_diverse(df.limit(0), aims, k=4).count() == 0


def test_swaps_do_not_lower_the_objective(spark):
    rnd = random.Random(4)
    rows = [row(i, rnd) for i in range(25)]
    aims = Aims([0.5] * 7, {"casing": {"lower": 2, "upper": 2}, "emoji": {True: 2, False: 2}}, 2)
    kinds = {"id": "long", "score": "double", "formulaic": "boolean", "ai_feel": "boolean", "lenband": "int", "is_question": "boolean", "advice": "boolean", "tells": "int", "emoji": "boolean", "seed_id": "long", "v": "array<double>", "stems": "array<string>"}
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in rows[0]))
    a, b = (select_diverse(df, aims, k=3, passes=p).first() for p in (0, 2))
    assert b is None or a is None or b.objective >= a.objective - 1e-9


def test_latest_scores_and_keep_rule(spark):
    e = spark.createDataFrame([(1, 7, 1, 3, None), (2, 7, 2, 4, 6.0), (3, 7, 2, 5, 8.0), (4, 8, 1, 99, 9.0), (5, 9, 1, 1, 5.0)], "eval_id long, candidate_id int, pass_no int, item_index int, score double").withColumn("received_at", F.lit("2024-01-01").cast("timestamp"))
    got = {r.candidate_id: r.eval_id for r in scoring.latest_scores(e).collect()}
    assert got == {7: 3, 9: 5}
    k = spark.createDataFrame([(True, 5.0), (True, 4.9), (None, 9.0), (False, 9.0), (True, None)], "keep boolean, score double").select(scoring.keep_rule(F.col("keep"), F.col("score")).alias("k")).collect()
    assert [r.k for r in k] == [True, False, False, False, False]


def test_planning(spark):
    assert dict(slots({"a": 5, "b": 1}, 0.7)) == {"a": 4, "b": 2}
    d = chunks(spark.range(11).withColumn("g", F.lit("x")), "g", "id", 5)
    assert [r["count"] for r in d.groupBy("chunk").count().orderBy("chunk").collect()] == [5, 5, 1]
    n = {r.v: r["count"] for r in spark.range(4000).select(draw({"m": 45, "f": 45, "x": 10}, F.col("id").cast("string")).alias("v")).groupBy("v").count().collect()}
    assert abs(n["m"] - 1800) < 200 and abs(n["x"] - 400) < 120
    types = spark.createDataFrame([("t1", ["k1"], ["d1"]), ("t2", ["k1", "k2"], []), ("t3", ["k1"], ["nowhere"])], "name string, kinds array<string>, affinity array<string>")
    seeds = spark.createDataFrame([(i, f"d{i % 2}", f"k{1 + i % 3 // 2}") for i in range(12)], "id int, domain string, kind string")
    pairs = type_seed_pairs(types, seeds)
    tiers = {r.name: r.t for r in pairs.groupBy("name").agg(F.max("tier").alias("t")).collect()}
    assert tiers == {"t1": 1, "t2": 1, "t3": 2}
    got = assign_seeds(pairs, spark.createDataFrame([("t1", 2), ("t2", 3), ("t3", 2)], "name string, n long")).collect()
    assert len({r.id for r in got}) == len(got) == 7


def test_exports_channels_and_provider(spark, tmp_path):
    rows = [(1, 0, "a", 5, "2024-01-01", "x y"), (1, 1, "b", 6, None, None), (2, 0, "a", 7, "2024-01-02", "zz")]
    posts = spark.createDataFrame(rows, "batch_id long, pos int, source string, telegram_message_id long, date string, text string").withColumn("exported_at", F.lit("2024-09-01").cast("timestamp"))
    write_export(posts, str(tmp_path / "out"))
    back = spark.read.schema("exported_at string, total_posts long, posts array<struct<source:string,telegram_message_id:long,date:string,text:string>>").json(str(tmp_path / "out"))
    assert sorted(r.total_posts for r in back.collect()) == [1, 2]
    assert read_export(spark, str(tmp_path / "none"), required=False).count() == 0
    with open(tmp_path / "chan.jsonl", "w") as f:
        for i, t in enumerate(["old", " ", "new text"]):
            f.write(json.dumps({"id": i, "date": "d", "text": t}) + "\n")
    spark.dataSource.register(ChannelSource)
    got = spark.read.format("channels").option("path", str(tmp_path)).option("limit", 2).option("peek", 3).load().collect()
    assert [(r.source, r.telegram_message_id, r.text) for r in got] == [("chan", 2, "new")]

    calls = itertools.count()

    def flaky(_):
        if next(calls) < 2:
            raise TimeoutError("later")
        return "ok"

    assert with_retries(flaky, "q", wait=0) == ("ok", None)
    try:
        with_retries(lambda _: (_ for _ in ()).throw(FatalProviderError("key")), "q")
        raise AssertionError
    except FatalProviderError:
        pass

    def make():
        def call(r):
            if r == "bad":
                raise ValueError("no")
            return r.upper()

        return call

    out = respond(spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "id long, request string"), make, attempts=1, wait=0)
    assert [(r.response, bool(r.error)) for r in out.orderBy("id").collect()] == [("A", False), (None, True), (None, True)]
    assert abs(failure_ratio(out) - 2 / 3) < 1e-9


def _swapped(rows, chosen, aims, passes):
    """The sequential search."""
    for _ in range(passes):
        changed = False
        for p in range(len(chosen)):
            rest, best = chosen[:p] + chosen[p + 1 :], chosen[p]
            value = objective(chosen, aims)
            ok = [r for r in rows if r not in chosen and not blocked(rest, r, aims)]
            for r in sorted(ok, key=lambda r: (-round(objective([*rest, r], aims), 9), r["id"]))[:1]:
                if objective([*rest, r], aims) > value + 1e-9:
                    best, changed = r, True
            chosen = [*chosen[:p], best, *chosen[p + 1 :]]
        if not changed:
            break
    return chosen


def test_swap_search_equals_the_sequential_one_in_both_backends(spark):
    rnd = random.Random(11)
    rows = [row(i, rnd) for i in range(40)]
    for r in rows:
        r["v"] = rnd.choice([None, [1.0, 0.0], [0.6, 0.8], [0.0, 1.0], [-0.6, 0.8]])
    kinds = {"id": "long", "score": "double", "formulaic": "boolean", "ai_feel": "boolean", "lenband": "int", "is_question": "boolean", "advice": "boolean", "tells": "int", "emoji": "boolean", "seed_id": "long", "v": "array<double>", "stems": "array<string>"}
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in rows[0]))
    for lexical in (False, True):
        aims = Aims([0.1, 0.9, 0.3, 0.5, 0.7, 0.2, 0.6], {"casing": {"lower": 2, "upper": 2}, "emoji": {True: 2, False: 2}}, 2, lexical=lexical)
        start = select_diverse(df, aims, k=4, passes=0).orderBy("position").collect()
        want = _swapped(rows, [rows[r.id] for r in start], aims, 5)
        got = select_diverse(df, aims, k=4).orderBy("position").collect()
        assert [r.id for r in got] == [r["id"] for r in want]
    assert aims.hard < Aims([], {}, 1).hard


def test_assignment_goes_on_until_nothing_is_open(spark):
    """Many types want the same few seeds: rounds go on until no open type has a seed left."""
    pairs = [(f"t{i:02d}", s) for i in range(30) for s in range(25)]
    got = assign_seeds(spark.createDataFrame(pairs, "name string, id int"), spark.createDataFrame([(f"t{i:02d}", 1) for i in range(30)], "name string, n long")).collect()
    assert len(got) == len({r.name for r in got}) == len({r.id for r in got}) == 25


def test_replies_embeddings_settings_and_audit(spark, tmp_path, monkeypatch):
    import pytest

    from weftline.sources.exports import audited, write_profile
    from weftline.sources.provider import embeddings, json_object, require_success
    from weftline.sources.settings import setting

    for reply, cut in (("{}", True), (" ", False), ("[1]", False), ("{", False), (None, False)):
        assert with_retries(json_object(lambda _: (reply, cut)), "q", attempts=1)[1]  # noqa: B023
    assert with_retries(json_object(lambda _: ('{"a": 1}', False)), "q") == ('{"a": 1}', None)

    def make():
        def call(texts):
            assert len(texts) <= 2
            if "bad" in texts:
                raise TimeoutError
            return [[3.0, 4.0] if t else [0.0, 0.0] for t in texts]

        return call

    rows = spark.createDataFrame([(1, "x"), (2, "bad"), (3, "y"), (4, None), (5, "z"), (6, "")], "id long, text string").coalesce(1)
    got = {r.id: r.embedding for r in embeddings(rows, make, size=2, attempts=1, wait=0).collect()}
    assert got == {1: None, 2: None, 3: [0.6, 0.8], 4: None, 5: [0.6, 0.8], 6: None}
    failed = spark.createDataFrame([(1, None, "e"), (2, "{}", None), (3, None, "e")], "id long, response string, error string")
    with pytest.raises(FatalProviderError):
        require_success(failed)
    assert require_success(failed, most=0.7) is failed
    (tmp_path / ".env").write_text("# keys\nexport API_KEY = 'abc'\nOTHER=1\nnot a line\n")
    monkeypatch.delenv("API_KEY", raising=False)
    assert setting("API_KEY", str(tmp_path / ".env")) == "abc" and setting("NONE", str(tmp_path / "no"), required=False) is None
    with pytest.raises(KeyError):
        setting("NONE", str(tmp_path / ".env"))
    with pytest.raises(ZeroDivisionError):
        audited(failed, str(tmp_path / "audit"), lambda d: 1 / 0)
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 3
    profile = spark.createDataFrame([("length", "longest", 5.0, None)], "section string, key string, value double, percentage double")
    for _ in range(2):
        write_profile(profile, str(tmp_path / "profile"))
    assert spark.read.schema(profile.schema).json(str(tmp_path / "profile")).collect() == profile.collect()
