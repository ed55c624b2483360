"""Queries on planning, scoring, selection and validation, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import safety as S
from ..functions import text as T
from ..operators import scoring
from ..operators.allocation import assign_seeds, chunks, draw, slots, type_seed_pairs
from ..operators.selection import COLUMNS, Aims, against_set, objective, select_diverse
from ..operators.similarity_join import set_similarity_join, vector_pairs
from ..session import table
from . import sqlgen as G
from .text_queries import _VIOLATION, length_band_prior, posts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_SLOTS = ", ".join(f"({G.q(k)}, {n})" for k, n in L.SLOTS.items())


@query(f"SELECT p.name, s.slots::INT AS round_1, greatest(2, round_even(s.slots * 0.7, 0))::INT AS round_2 FROM post_types AS p JOIN (VALUES {_SLOTS}) AS s(name, slots) ON p.name = s.name")
def slot_plan(spark, sf):
    plan = [(a, n, m) for (a, n), (_, m) in zip(slots(L.SLOTS, 1.0), slots(L.SLOTS, 0.7))]
    return table(spark, sf, "post_types").select("name").join(F.broadcast(spark.createDataFrame(plan, "name string, round_1 int, round_2 int")), "name")


@query("SELECT id, post_type, CAST(floor((row_number() OVER (PARTITION BY post_type ORDER BY id) - 1) / 5) AS INT) AS chunk FROM candidates")
def batch_chunks(spark, sf):
    return chunks(table(spark, sf, "candidates").select("id", "post_type"), "post_type", "id", 5)


_PAIRS = "k AS (SELECT name, affinity, unnest(kinds) AS kind FROM post_types), p AS (SELECT k.name, s.id, CASE WHEN len(k.affinity) = 0 OR list_contains(k.affinity, s.domain) THEN 1 ELSE 2 END AS tier FROM seeds AS s JOIN k ON k.kind = s.kind)"


@query(f"WITH {_PAIRS} SELECT name, id, tier FROM p WHERE tier = (SELECT min(tier) FROM p AS p2 WHERE p2.name = p.name)")
def type_kind_join(spark, sf):
    return type_seed_pairs(table(spark, sf, "post_types"), table(spark, sf, "seeds"))


@query(None)
def assignment_plan(spark, sf):
    """Seeds for types by rounds of proposals; each seed once."""
    wanted = spark.createDataFrame(slots(L.SLOTS, 1.0), "name string, n long")
    return assign_seeds(type_seed_pairs(table(spark, sf, "post_types"), table(spark, sf, "seeds")), wanted)


@query(None)
def speaker_language_draw(spark, sf):
    """Speaker and language of every candidate by a hash of its id."""
    c = table(spark, sf, "candidates")
    return c.select("id", draw({"m": 45, "f": 45, "x": 10}, F.concat(F.lit("s"), "id")).alias("speaker"), draw({"ru": 0.44, "ru_kz": 0.10, "kz": 0.14, "ru_en": 0.14, "en": 0.18}, F.concat(F.lit("l"), "id")).alias("language"))


@query("WITH e AS (SELECT * FROM evaluations WHERE item_index BETWEEN 1 AND 20 AND score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY pass_no NULLS LAST, received_at DESC NULLS LAST, eval_id DESC) = 1) SELECT c.id, e.eval_id, e.pass_no, e.score, coalesce(e.keep AND e.score >= 5, false) AS kept, e.eval_id IS NULL AS unscored FROM candidates AS c LEFT JOIN e ON e.candidate_id = c.id")
def score_join(spark, sf):
    e = scoring.latest_scores(table(spark, sf, "evaluations")).select(F.col("candidate_id").alias("id"), "eval_id", "pass_no", "score", "keep")
    j = table(spark, sf, "candidates").select("id").join(e, "id", "left")
    return j.select("id", "eval_id", "pass_no", "score", scoring.keep_rule(F.col("keep"), F.col("score")).alias("kept"), F.col("eval_id").isNull().alias("unscored"))


@query("SELECT id FROM candidates AS c WHERE NOT EXISTS (SELECT 1 FROM evaluations AS e WHERE e.candidate_id = c.id AND e.pass_no = 1 AND e.item_index BETWEEN 1 AND 20 AND e.score IS NOT NULL)")
def unscored_retry(spark, sf):
    e = table(spark, sf, "evaluations").where(scoring.valid(F.col("item_index"), F.col("score")) & (F.col("pass_no") == 1)).select(F.col("candidate_id").alias("id"))
    return table(spark, sf, "candidates").select("id").join(e, "id", "left_anti")


@query("SELECT CAST(floor(score) AS INT) AS score, count(*) AS n FROM candidates WHERE score IS NOT NULL GROUP BY 1")
def score_histogram(spark, sf):
    return table(spark, sf, "candidates").where("score IS NOT NULL").groupBy(F.floor("score").cast("int").alias("score")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count_if(item_index IS NULL OR item_index NOT BETWEEN 1 AND 20) AS out_of_range, count_if(score IS NULL) AS without_score, count(DISTINCT candidate_id) AS n_candidates FROM evaluations")
def evaluation_validity(spark, sf):
    e = table(spark, sf, "evaluations")
    return e.agg(F.count("*").alias("n_rows"), F.count_if(F.col("item_index").isNull() | ~F.col("item_index").between(1, 20)).alias("out_of_range"), F.count_if(F.col("score").isNull()).alias("without_score"), F.count_distinct("candidate_id").alias("n_candidates"))


_RESPONSES = [
    (1, 3, '{"posts":[{"n":1,"text":"a short post"},{"n":2,"skip":true},{"n":9,"text":"out of range"},{"n":"x","text":"bad index"}]}'),
    (2, 2, '{"posts":[{"n":1,"text":"  "},{"n":2,"text":"second"}]}'),
]


@query("SELECT * FROM (VALUES (1, 0, 1, 'a short post', 'kept'), (1, 1, 2, '', 'skipped'), (1, 2, 9, 'out of range', 'malformed'), (1, 3, NULL, 'bad index', 'malformed'), (2, 0, 1, '', 'malformed'), (2, 1, 2, 'second', 'kept')) AS v(batch_id, pos, n, text, outcome)")
def parse_model_items(spark, sf):
    return scoring.parse_items(spark.createDataFrame(_RESPONSES, "batch_id int, size int, json string"))


@query("SELECT * FROM (VALUES (1, 1, 8.0::DOUBLE, true), (1, 2, 4.0::DOUBLE, true), (1, 3, 9.0::DOUBLE, false)) AS v(batch_id, index, score, keep)")
def parse_evaluations(spark, sf):
    j = '{"evaluations":[{"index":1,"score":3,"keep":true},{"index":1,"score":8,"keep":true},{"index":2,"score":4,"keep":true},{"index":3,"score":9,"keep":false},{"index":7,"score":9,"keep":true}]}'
    return scoring.parse_evaluations(spark.createDataFrame([(1, 4, j)], "batch_id int, size int, json string"))


_KNOWN_KINDS = "('incident', 'topic', 'oddity', 'interest')"


@query(f"SELECT id, CASE WHEN kind IS NULL OR kind NOT IN {_KNOWN_KINDS} OR coalesce(trim(theme), '') = '' OR coalesce(trim(subject), '') = '' THEN 'malformed' ELSE 'valid' END AS outcome, CASE WHEN kind = 'incident' THEN detail END AS detail FROM seeds")
def seed_validity(spark, sf):
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    bad = F.col("kind").isNull() | ~F.col("kind").isin("incident", "topic", "oddity", "interest") | blank("theme") | blank("subject")
    return table(spark, sf, "seeds").select("id", F.when(bad, "malformed").otherwise("valid").alias("outcome"), F.when(F.col("kind") == "incident", F.col("detail")).alias("detail"))


@query("WITH d AS (SELECT DISTINCT domain FROM seeds) SELECT c.id, CASE WHEN c.topic IN (SELECT domain FROM d) THEN c.topic ELSE s.domain END AS topic FROM candidates AS c LEFT JOIN seeds AS s ON s.id = c.seed_id")
def topic_fallback(spark, sf):
    s = table(spark, sf, "seeds").select(F.col("id").alias("seed_id"), "domain")
    known = s.select(F.col("domain").alias("topic")).distinct().withColumn("known", F.lit(True))
    j = table(spark, sf, "candidates").select("id", "topic", "seed_id").join(s, "seed_id", "left").join(known, "topic", "left")
    return j.select("id", F.when(F.col("known"), F.col("topic")).otherwise(F.col("domain")).alias("topic"))


_FEATURES = ", ".join(f"{v} AS {k}" for k, v in G.features().items())
#: The fixed set that the objective and the checks are computed for: the twenty best scores.
_FINAL = f"f AS (SELECT * FROM (SELECT id, {G.NORM} AS t, post_type, topic, score, embedding::DOUBLE[] AS e FROM candidates WHERE text IS NOT NULL AND score IS NOT NULL) AS x ORDER BY score DESC, id LIMIT 20), g AS (SELECT id, t, e, post_type, topic, score, {_FEATURES}, {G.word_language()} AS lang FROM f)"


def final_set(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "candidates").where("text IS NOT NULL AND score IS NOT NULL").select("id", T.normalize("text").alias("t"), "post_type", "topic", "score", "embedding")
    d = d.orderBy(F.desc("score"), "id").limit(20)
    return d.select("*", *[v.alias(k) for k, v in T.features("t").items()], T.word_language("t").alias("lang"))


_COVER = {"type": "post_type", "topic": "topic", "lang": "lang", "lenband": "lenband", "opener": "opener1", "ending": "ending", "shape": "shape"}
_COVER_SQL = " UNION ALL ".join(f"SELECT '{k}' AS attribute, sum(sqrt(n)) AS root_sum, {w}::DOUBLE AS weight FROM (SELECT count(*) AS n FROM g GROUP BY {_COVER[k]}) AS x{i}" for i, (k, w) in enumerate(L.COVERAGE.items()))


@query(f"WITH {_FINAL} SELECT attribute, round(root_sum, 6) AS root_sum, round(weight * root_sum, 6) AS reward FROM ({_COVER_SQL}) AS y")
def coverage_score(spark, sf):
    g = final_set(spark, sf)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("attribute"), F.col(c).cast("string").alias("value")) for k, c in _COVER.items()]))
    roots = g.select(each.alias("x")).groupBy("x.attribute", "x.value").agg(F.count("*").alias("n")).groupBy("attribute").agg(F.sum(F.sqrt("n")).alias("r"))
    weight = F.create_map(*[F.lit(x) for kv in L.COVERAGE.items() for x in kv])
    return roots.select("attribute", F.round("r", 6).alias("root_sum"), F.round(F.element_at(weight, F.col("attribute")) * F.col("r"), 6).alias("reward"))


def _shared(label: str, column: str, limit: int, more: str = "") -> str:
    return f"SELECT 'warning' AS severity, {G.q(label)} AS rule, {column}::VARCHAR AS subject, count(*)::DOUBLE AS value FROM g {more} GROUP BY {column} HAVING count(*) >= {limit}"


_HARD, _SOFT = L.SIMILARITY["embedding"]["hard"], L.SIMILARITY["embedding"]["soft"]
_NEAR = (_HARD + _SOFT) / 2
_CHECKS = [
    "SELECT 'error', 'count', '', count(*)::DOUBLE FROM g HAVING count(*) <> 20",
    f"SELECT 'error', 'safety', v || ':' || id, 1.0 FROM (SELECT id, {_VIOLATION} AS v FROM g) AS y WHERE v IS NOT NULL",
    "SELECT 'error', 'duplicates', '', (count(*) - count(DISTINCT regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g')))::DOUBLE FROM g HAVING count(*) > count(DISTINCT regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g'))",
    f"SELECT 'warning', 'lexical_overlap', a || ',' || b, round(o / (na + nb - o), 6) FROM (SELECT a.id AS a, b.id AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb FROM gs AS a JOIN gs AS b ON a.w = b.w AND a.id < b.id GROUP BY 1, 2) AS p WHERE o / (na + nb - o) >= 0.5",
    "SELECT 'warning', 'advice', '', count_if(advice)::DOUBLE FROM g HAVING count_if(advice) > 2",
    "SELECT 'warning', 'narrow_lengths', '', round(stddev_pop(ln(length)), 6) FROM g HAVING stddev_pop(ln(length)) < 0.45",
    f"SELECT CASE WHEN c >= {_HARD} THEN 'error' ELSE 'warning' END, 'similar_pair', a || ',' || b, round(c, 6) FROM (SELECT x.id AS a, y.id AS b, list_sum(list_transform(list_zip(x.e, y.e), lambda z: z[1] * z[2])) / sqrt(list_sum(list_transform(x.e, lambda v: v * v)) * list_sum(list_transform(y.e, lambda v: v * v))) AS c FROM g AS x JOIN g AS y ON x.id < y.id) AS p WHERE c >= {_NEAR}",
    "SELECT 'warning', 'questions', '', count_if(is_question)::DOUBLE FROM g HAVING count_if(is_question) > (SELECT round(20 * (q + 0.05)) FROM habits)",
    "SELECT 'warning', 'lowercase', '', round(avg((casing = 'lower')::INT), 6) FROM g HAVING avg((casing = 'lower')::INT) > (SELECT low + 0.25 FROM habits)",
    "SELECT 'warning', 'emoji', '', round(avg(emoji::INT), 6) FROM g HAVING avg(emoji::INT) > (SELECT em + 0.25 FROM habits)",
]
_HABITS = f"habits AS (SELECT avg((regexp_matches(t, '^\\p{{Ll}}'))::INT) AS low, avg(({G.rx('t', L.EMOJI_GENERATOR)})::INT) AS em, avg((contains(t, '?'))::INT) AS q FROM posts)"


@query(
    f"WITH {G.POSTS}, {_HABITS}, {_FINAL}, gs AS (SELECT id, len(s) AS n, unnest(s) AS w FROM (SELECT id, {G.stems(G.tokens('t'))} AS s FROM g) AS z) "
    + " UNION ALL ".join([_shared("opener1", "opener1", 3), _shared("opener2", "opener2", 3, "WHERE contains(opener2, ' ')"), _shared("topic", "topic", 6), _shared("post_type", "post_type", 6), _shared("language", "lang", 14), _shared("shape", "shape", 9), _shared("lenband", "lenband", 12), *_CHECKS])
)
def validate_final(spark, sf):
    """Errors and warnings about a final set, as rows (severity, rule, subject, value)."""
    g = final_set(spark, sf)
    row = lambda s, rule, subject, value: [F.lit(s).alias("severity"), F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), value.cast("double").alias("value")]

    def shared(rule: str, column: str, limit: int, rows: DataFrame = g) -> DataFrame:
        return rows.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") >= limit).select(*row("warning", rule, F.col(column), F.col("n")))

    key = F.count_distinct(T.dedupe_key("t"))
    one = g.agg(F.count("*").alias("n"), key.alias("k"), F.count_if("advice").alias("advice"), F.stddev_pop(F.ln("length")).alias("spread"), F.count_if("is_question").alias("questions"), F.avg((F.col("casing") == "lower").cast("double")).alias("lower"), F.avg(F.col("emoji").cast("double")).alias("emoji"))
    habits = _habits(spark, sf)
    close = vector_pairs(g.select(F.col("id").cast("long").alias("id"), T.unit(F.col("embedding").cast("array<double>")).alias("v")), _NEAR)
    pairs = set_similarity_join(g.select(F.col("id").cast("long").alias("id"), T.stems(T.tokens("t")).alias("s")), 0.5)
    v = g.select("id", S.first_violation("t").alias("v")).where("v IS NOT NULL")
    parts = [
        shared("opener1", "opener1", 3), shared("opener2", "opener2", 3, g.where(F.col("opener2").contains(" "))), shared("topic", "topic", 6), shared("post_type", "post_type", 6), shared("language", "lang", 14), shared("shape", "shape", 9), shared("lenband", "lenband", 12),
        one.where("n <> 20").select(*row("error", "count", F.lit(""), F.col("n"))),
        v.select(*row("error", "safety", F.concat("v", F.lit(":"), "id"), F.lit(1.0))),
        one.where("n > k").select(*row("error", "duplicates", F.lit(""), F.col("n") - F.col("k"))),
        pairs.select(*row("warning", "lexical_overlap", F.concat("a", F.lit(","), "b"), F.round("similarity", 6))),
        one.where("advice > 2").select(*row("warning", "advice", F.lit(""), F.col("advice"))),
        one.where("spread < 0.45").select(*row("warning", "narrow_lengths", F.lit(""), F.round("spread", 6))),
        *(close.where(c).select(*row(level, "similar_pair", F.concat("a", F.lit(","), "b"), F.round("cosine", 6))) for level, c in (("error", F.col("cosine") >= _HARD), ("warning", F.col("cosine") < _HARD))),
        one.where(F.col("questions") > round(20 * (habits.q + 0.05))).select(*row("warning", "questions", F.lit(""), F.col("questions"))),
        one.where(F.col("lower") > habits.low + 0.25).select(*row("warning", "lowercase", F.lit(""), F.round("lower", 6))),
        one.where(F.col("emoji") > habits.emoji + 0.25).select(*row("warning", "emoji", F.lit(""), F.round("emoji", 6))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _habits(spark: SparkSession, sf: str):
    """Shares of posts that begin in lower case, have emoji, and ask; one row."""
    t = F.col("t")
    return posts(spark, sf).agg(F.avg(t.rlike(r"^\p{Ll}").cast("double")).alias("low"), F.avg(t.rlike(L.EMOJI_GENERATOR).cast("double")).alias("emoji"), F.avg(t.contains("?").cast("double")).alias("q")).first()


def _selectable(spark: SparkSession, sf: str, lexical: bool = False) -> tuple[DataFrame, Aims]:
    """Candidates that may be selected, with features, and the aims taken from the posts."""
    c = table(spark, sf, "candidates").where("text IS NOT NULL AND score >= 5").select(F.col("id").cast("long").alias("id"), T.normalize("text").alias("t"), "score", F.coalesce("formulaic", F.lit(False)).alias("formulaic"), F.coalesce("ai_feel", F.lit(False)).alias("ai_feel"), "post_type", "topic", "seed_id", T.unit(F.col("embedding").cast("array<double>")).alias("v"))
    s = table(spark, sf, "seeds").select(F.col("id").alias("seed_id"), T.dedupe_key("theme").alias("theme_key"))
    rows = c.join(s, "seed_id", "left").select("*", *[x.alias(k) for k, x in T.features("t").items()], T.word_language("t").alias("language"), T.stems(T.tokens("t")).alias("stems"))
    prior = [r.prior for r in length_band_prior(spark, sf).orderBy("band").collect()]  # seven rows
    share = _habits(spark, sf)
    low, emoji = round(20 * share.low), round(20 * share.emoji)
    return rows, Aims(prior, {"casing": {"lower": low, "upper": 20 - low}, "emoji": {True: emoji, False: 20 - emoji}}, round(20 * (share.q + 0.05)), lexical=lexical)


@query(None)
def select_final(spark, sf):
    """Twenty candidates by greedy growth and up to five passes of swaps."""
    return select_diverse(*_selectable(spark, sf))


@query(None)
def select_final_lexical(spark, sf):
    """The same where no vectors are to be had: likeness is that of word stems."""
    return select_diverse(*_selectable(spark, sf, lexical=True))


@query(f"WITH c AS (SELECT id, round, {G.NORM} AS t FROM candidates WHERE text IS NOT NULL), k AS (SELECT id, round, regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g') AS k FROM c) SELECT id FROM k WHERE round > (SELECT min(round) FROM k AS o WHERE o.k = k.k)")
def repeats_of_earlier_rounds(spark, sf):
    """Candidates whose key was there in an earlier round; the first round of a key is a minimum, combined before its shuffle."""
    c = table(spark, sf, "candidates").where("text IS NOT NULL").select("id", "round", T.dedupe_key(T.normalize("text")).alias("k"))
    first = c.groupBy("k").agg(F.min("round").alias("first"))
    return c.join(first, "k").where("round > first").select("id")


@query("SELECT round, status, n, sum(n) OVER (PARTITION BY status ORDER BY round)::BIGINT AS so_far FROM (SELECT round, coalesce(status, '') AS status, count(*) AS n FROM candidates GROUP BY 1, 2) AS x")
def round_totals(spark, sf):
    """Outcomes of each round and up to it."""
    n = table(spark, sf, "candidates").groupBy("round", F.coalesce("status", F.lit("")).alias("status")).agg(F.count("*").alias("n"))
    return n.withColumn("so_far", F.sum("n").over(Window.partitionBy("status").orderBy("round")))  # a row per round and status


@query(f"WITH {G.POSTS}, e AS (SELECT count(*) AS n FROM posts WHERE length(t) BETWEEN 15 AND 420 AND ({_VIOLATION}) IS NULL AND len({G.pick(G.flags())}) = 0 AND NOT {G.unfit_exemplar()}), s AS (SELECT count(*) AS n FROM seeds WHERE kind IN ('incident', 'topic', 'oddity', 'interest') AND coalesce(trim(theme), '') <> '' AND coalesce(trim(subject), '') <> ''), v AS (SELECT count(*) AS n FROM candidates WHERE text IS NOT NULL AND score >= 5) SELECT 'exemplars' AS gate, n, n >= 20 AS passed FROM e UNION ALL SELECT 'seeds', n, n >= 80 FROM s UNION ALL SELECT 'survivors', n, n >= 40 FROM v")
def volume_gates(spark, sf):
    """Whether there is enough to go on: exemplars, valid seeds, candidates kept."""
    from .text_queries import exemplar_pool

    gates = [
        ("exemplars", 20, exemplar_pool(spark, sf)),
        ("seeds", 80, seed_validity(spark, sf).where("outcome = 'valid'")),
        ("survivors", 40, table(spark, sf, "candidates").where("text IS NOT NULL AND score >= 5")),
    ]
    parts = [d.agg(F.count("*").alias("n")).select(F.lit(g).alias("gate"), "n", (F.col("n") >= least).alias("passed")) for g, least, d in gates]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(None)
def blocked_reasons(spark, sf):
    """What keeps each candidate out of the set of the ten best scores, and what it would add to its objective."""
    rows, aims = _selectable(spark, sf)
    return against_set(rows, rows.orderBy(F.desc("score"), "id").limit(10), aims)


@query(None)
def objective_fixed_set(spark, sf):
    """The objective of the twenty best scores."""
    rows, aims = _selectable(spark, sf)
    chosen = [r.asDict() for r in rows.select(*COLUMNS).orderBy(F.desc("score"), "id").limit(20).collect()]
    return spark.createDataFrame([(len(chosen), round(objective(chosen, aims), 6))], "n int, objective double")


@query("SELECT c.id, p.objective, p.hint.lo AS lo, p.hint.hi AS hi, length(c.text) BETWEEN p.hint.lo AND p.hint.hi AND (p.hint.q IS NULL OR p.hint.q = contains(c.text, '?')) AS fits FROM candidates AS c JOIN post_types AS p ON p.name = c.post_type WHERE c.text IS NOT NULL")
def exemplar_fit(spark, sf):
    """Whether a candidate has the length and question form that its type hints at."""
    p = table(spark, sf, "post_types").select(F.col("name").alias("post_type"), "objective", F.col("hint.lo").alias("lo"), F.col("hint.hi").alias("hi"), F.col("hint.q").alias("q"))
    c = table(spark, sf, "candidates").where("text IS NOT NULL").select("id", "text", "post_type")
    fits = F.length("text").between(F.col("lo"), F.col("hi")) & (F.col("q").isNull() | (F.col("q") == F.col("text").contains("?")))
    return c.join(F.broadcast(p), "post_type").select("id", "objective", "lo", "hi", fits.alias("fits"))


@query("SELECT delivery_id, language, n FROM (SELECT delivery_id, language, row_number() OVER (PARTITION BY language ORDER BY md5(delivery_id::VARCHAR), delivery_id) AS n FROM (WITH " + G.POSTS + f" SELECT delivery_id, {G.word_language()} AS language FROM posts) AS x) AS y WHERE n <= 4")
def exemplar_rotation(spark, sf):
    """Four posts of each language in the order of a digest of their id."""
    d = posts(spark, sf).select("delivery_id", T.word_language("t").alias("language"))
    w = Window.partitionBy("language").orderBy(F.md5(F.col("delivery_id").cast("string")), "delivery_id")
    return d.withColumn("n", F.row_number().over(w)).where("n <= 4")


@query("SELECT b.batch_id, b.total_posts, coalesce(p.n, 0) AS n_posts, coalesce(p.n, 0) = b.total_posts AS agrees FROM export_batches AS b LEFT JOIN (SELECT batch_id, count(*) AS n FROM raw_telegram_posts GROUP BY 1) AS p ON p.batch_id = b.batch_id")
def envelope_check(spark, sf):
    n = table(spark, sf, "raw_telegram_posts").groupBy("batch_id").agg(F.count("*").alias("n"))
    return table(spark, sf, "export_batches").join(n, "batch_id", "left").select("batch_id", "total_posts", F.coalesce("n", F.lit(0)).alias("n_posts"), (F.coalesce("n", F.lit(0)) == F.col("total_posts")).alias("agrees"))
