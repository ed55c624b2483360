"""Queries over posts: normalisation, classification, style profile; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import safety as S
from ..functions import text as T
from ..session import table
from . import sqlgen as G

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts with normalised text ``t``; null texts are no posts."""
    return table(spark, sf, "raw_telegram_posts").where("text IS NOT NULL").select("delivery_id", "source", T.normalize("text").alias("t"))


def held(d: DataFrame, keep: list[str], **cols: Column) -> DataFrame:
    """``keep`` and computed columns, behind an outer generator of one row.

    A filter on a computed column is otherwise put below the projection, with the column's expression in each of its
    terms: a text would be normalised once for every pattern.
    """
    one = F.explode_outer(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))).alias("_held")
    return d.select(*keep, one).select(*keep, *[F.col(f"_held.{k}").alias(k) for k in cols])


def _of(select: str, **more) -> str:
    return f"WITH {G.POSTS} SELECT {select} FROM posts"


@query(_of(f"delivery_id, t, length(t) AS n_chars, len({G.words('t')}) AS n_words"))
def normalize_text(spark, sf):
    return posts(spark, sf).select("delivery_id", "t", F.length("t").alias("n_chars"), F.size(T.split_words("t")).alias("n_words"))


@query(_of(f"delivery_id, array_to_string({G.tokens('t')}, ' ') AS words, array_to_string(list_sort({G.stems(G.tokens('t'))}), ' ') AS stems, regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g') AS dedupe_key"))
def tokens_words_stems(spark, sf):
    ws = T.tokens("t")
    return posts(spark, sf).select("delivery_id", F.array_join(ws, " ").alias("words"), F.array_join(F.array_sort(T.stems(ws)), " ").alias("stems"), T.dedupe_key("t").alias("dedupe_key"))


def _flag(name: str, keys: list[str]) -> None:
    cond = dict(G.flags())[keys[0]]

    def run(spark, sf):
        d = held(table(spark, sf, "raw_telegram_posts").where("text IS NOT NULL"), ["delivery_id"], t=T.normalize("text"))
        return d.where(T.flags("t")[keys[0]]).select("delivery_id", "t")

    run.__name__ = name
    QUERIES[name] = run
    ORACLES[name] = f"WITH {G.POSTS} SELECT delivery_id, t FROM posts WHERE {cond}"


for _name, _key in (("contact_info", "contact_information"), ("identification_request", "personal_identification_request"), ("targeted_person", "targeted_person_reference"), ("sensitive_content", "sensitive_content"), ("harassment", "targeted_harassment"), ("advertisement", "advertisement"), ("too_short", "too_short"), ("noise", "noise")):
    _flag(_name, [_key])

_CLASSIFIED = f"{G.POSTS}, found AS (SELECT *, {G.pick(G.flags())} AS r, {G.style()} AS style_score FROM posts), classified AS (SELECT *, CASE WHEN len(r) > 0 THEN 'EXCLUDE' WHEN style_score >= 2 THEN 'SAFE_STYLE_REFERENCE' ELSE 'REVIEW' END AS classification FROM found)"


def classified(spark: SparkSession, sf: str) -> DataFrame:
    d = posts(spark, sf).select("*", T.reasons("t").alias("r"), T.style_score("t").alias("style_score"))
    return d.withColumn("classification", T.classification(F.col("r"), F.col("style_score")))


@query(f"WITH {_CLASSIFIED} SELECT delivery_id, source, t, classification, coalesce(array_to_string(r, ','), '') AS flags, style_score FROM classified")
def classify_posts(spark, sf):
    return classified(spark, sf).select("delivery_id", "source", "t", "classification", F.array_join("r", ",").alias("flags"), "style_score")


@query(f"WITH {_CLASSIFIED} SELECT classification, count(*) AS n FROM classified GROUP BY 1")
def classification_counts(spark, sf):
    return classified(spark, sf).groupBy("classification").agg(F.count("*").alias("n"))


@query(f"WITH {_CLASSIFIED}, flat AS (SELECT delivery_id, unnest(r) AS flag FROM classified) SELECT flag, count(*) AS n, min(delivery_id) AS first_seen FROM flat GROUP BY 1")
def flag_counts(spark, sf):
    return classified(spark, sf).select("delivery_id", F.explode("r").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"), F.min("delivery_id").alias("first_seen"))


@query(f"WITH {_CLASSIFIED} SELECT delivery_id, style_score FROM classified")
def style_score(spark, sf):
    return posts(spark, sf).select("delivery_id", T.style_score("t").alias("style_score"))


@query(f"WITH {_CLASSIFIED} SELECT classification, source, count(*) AS n, sum(style_score) AS style FROM classified GROUP BY 1, 2")
def split_buckets(spark, sf):
    return classified(spark, sf).groupBy("classification", "source").agg(F.count("*").alias("n"), F.sum("style_score").alias("style"))


@query(_of(f"delivery_id, {G.script()} AS script, {G.script('t', 'english_or_latin')} AS raw_script, {G.word_language()} AS language"))
def languages_by_rules(spark, sf):
    return posts(spark, sf).select("delivery_id", T.script("t").alias("script"), T.script("t", "english_or_latin").alias("raw_script"), T.word_language("t").alias("language"))


@query(_of(f"delivery_id, {G.post_format()} AS format, {G.raw_format()} AS raw_format, {G.question_type()} AS question_type"))
def formats(spark, sf):
    return posts(spark, sf).select("delivery_id", T.post_format("t").alias("format"), T.raw_format("t").alias("raw_format"), T.question_type("t").alias("question_type"))


_RUNS = f"len(regexp_extract_all(t, {G.q(L.EMOJI_WIDE)}))"


@query(_of(f"count(*) AS n_posts, count_if({_RUNS} > 0) AS with_emoji, sum({_RUNS}) AS emoji_runs, round(sum({_RUNS}) / count(*), 2) AS per_post"))
def emoji_stats(spark, sf):
    n = T.emoji_runs("t")
    return posts(spark, sf).agg(F.count("*").alias("n_posts"), F.count_if(n > 0).alias("with_emoji"), F.sum(n).alias("emoji_runs"), F.round(F.sum(n) / F.count("*"), 2).alias("per_post"))


@query(_of("count(*) AS n_posts, count_if(contains(t, '?')) AS question_mark, count_if(contains(t, '!')) AS exclamation_mark, count_if(contains(t, '...')) AS ellipsis, count_if(contains(t, '!!')) AS multiple_exclamation, count_if(contains(t, '??')) AS multiple_question, count_if(regexp_matches(t, '^\\p{Ll}')) AS lowercase_start"))
def punctuation_stats(spark, sf):
    t = F.col("t")
    cols = {"question_mark": t.contains("?"), "exclamation_mark": t.contains("!"), "ellipsis": t.contains("..."), "multiple_exclamation": t.contains("!!"), "multiple_question": t.contains("??"), "lowercase_start": t.rlike(r"^\p{Ll}")}
    return posts(spark, sf).agg(F.count("*").alias("n_posts"), *[F.count_if(c).alias(k) for k, c in cols.items()])


@query(_of(f"count(*) AS n_posts, count_if(regexp_matches(lower(t), '[а-яё]')) AS russian, count_if(regexp_matches(lower(t), {G.q(L.KAZAKH_LETTERS)})) AS kazakh, count_if({G.rx('lower(t)', G.whole(L.ENGLISH_MARKS))}) AS english, count_if({G.rx('lower(t)', G.whole(L.FIRST_PERSON))}) AS first_person, count_if({G.rx('lower(t)', G.whole(L.SECOND_PERSON))}) AS second_person"))
def mixing_and_person_stats(spark, sf):
    low = F.lower("t")
    cols = {"russian": low.rlike("[а-яё]"), "kazakh": low.rlike(L.KAZAKH_LETTERS), "english": low.rlike(T.whole(L.ENGLISH_MARKS)), "first_person": low.rlike(T.whole(L.FIRST_PERSON)), "second_person": low.rlike(T.whole(L.SECOND_PERSON))}
    return posts(spark, sf).agg(F.count("*").alias("n_posts"), *[F.count_if(c).alias(k) for k, c in cols.items()])


@query(_of(f"delivery_id, {G.count_words('t', L.POSITIVE)} AS positive, {G.count_words('t', L.NEGATIVE)} AS negative"))
def emotion_counts(spark, sf):
    return posts(spark, sf).select("delivery_id", T.count_words("t", L.POSITIVE).alias("positive"), T.count_words("t", L.NEGATIVE).alias("negative"))


_TOPICS = G.pick([(k, G.rx("lower(t)", G.whole(ws.split()))) for k, ws in L.TOPICS.items()])


@query(f"WITH {G.POSTS}, found AS (SELECT delivery_id, {_TOPICS} AS ts FROM posts), flat AS (SELECT delivery_id, unnest(CASE WHEN len(ts) = 0 THEN ['other'] ELSE ts END) AS topic FROM found) SELECT topic, count(*) AS n, min(delivery_id) AS first_seen FROM flat GROUP BY 1")
def topic_counts(spark, sf):
    return posts(spark, sf).select("delivery_id", F.explode(T.topics("t")).alias("topic")).groupBy("topic").agg(F.count("*").alias("n"), F.min("delivery_id").alias("first_seen"))


@query(f"WITH {G.POSTS}, flat AS (SELECT delivery_id, unnest({G.pick([(w, G.rx('lower(t)', G.whole([w]))) for w in L.CASUAL])}) AS word FROM posts) SELECT word, count(*) AS n, min(delivery_id) AS first_seen FROM flat GROUP BY 1 ORDER BY n DESC, first_seen, word LIMIT 20")
def casual_top20(spark, sf):
    flat = posts(spark, sf).select("delivery_id", F.explode(T.listed("t", L.CASUAL)).alias("word"))
    return flat.groupBy("word").agg(F.count("*").alias("n"), F.min("delivery_id").alias("first_seen")).orderBy(F.desc("n"), "first_seen", "word").limit(20)


@query(_of(f"count(*) AS n_posts, avg(length(t)) AS mean_chars, min(length(t)) AS min_chars, max(length(t)) AS max_chars, median(length(t)) AS median_chars, avg(len({G.words('t')})) AS mean_words, median(len({G.words('t')})) AS median_words"))
def length_stats(spark, sf):
    c, w = F.length("t"), F.size(T.split_words("t"))
    return posts(spark, sf).agg(F.count("*").alias("n_posts"), F.avg(c).alias("mean_chars"), F.min(c).alias("min_chars"), F.max(c).alias("max_chars"), F.median(c).alias("median_chars"), F.avg(w).alias("mean_words"), F.median(w).alias("median_words"))


@query(f"WITH {G.POSTS}, b AS (SELECT 'chars' AS kind, {G.bucket('length(t)', L.LENGTH_BUCKETS)} AS bucket FROM posts UNION ALL SELECT 'words', {G.bucket('len(' + G.words('t') + ')', L.WORD_BUCKETS)} FROM posts) SELECT kind, bucket, count(*) AS n FROM b GROUP BY 1, 2")
def histograms(spark, sf):
    d = posts(spark, sf)
    each = F.explode(F.array(F.struct(F.lit("chars").alias("kind"), T.bucket(F.length("t"), L.LENGTH_BUCKETS).alias("bucket")), F.struct(F.lit("words").alias("kind"), T.bucket(F.size(T.split_words("t")), L.WORD_BUCKETS).alias("bucket"))))
    return d.select(each.alias("x")).groupBy("x.kind", "x.bucket").agg(F.count("*").alias("n"))


@query("SELECT lower(trim(source)) AS source, count(*) AS n, count(text) AS with_text, round(count(*) * 100 / sum(count(*)) OVER (), 1) AS share FROM raw_telegram_posts GROUP BY 1")
def source_counts(spark, sf):
    d = table(spark, sf, "raw_telegram_posts").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("n"), F.count("text").alias("with_text"))
    return d.withColumn("share", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 1))  # a row per source


_FLAGS = {
    "punctuation": {"question_mark": "contains(t, '?')", "exclamation_mark": "contains(t, '!')", "ellipsis": "contains(t, '...')", "multiple_exclamation": "contains(t, '!!')", "multiple_question": "contains(t, '??')", "lowercase_start": "regexp_matches(t, '^\\p{Ll}')"},
    "language_mixing": {"russian": "regexp_matches(lower(t), '[а-яё]')", "kazakh": f"regexp_matches(lower(t), {G.q(L.KAZAKH_LETTERS)})", "english": G.rx("lower(t)", G.whole(L.ENGLISH_MARKS))},
    "personal_language": {"first_person": G.rx("lower(t)", G.whole(L.FIRST_PERSON)), "second_person": G.rx("lower(t)", G.whole(L.SECOND_PERSON))},
    "emotional_style": {"positive": f"{G.count_words('t', L.POSITIVE)} > 0", "negative": f"{G.count_words('t', L.NEGATIVE)} > 0"},
    "emoji": {"posts_with_emoji": f"{_RUNS} > 0"},
    "questions": {"question_posts": "contains(t, '?')"},
}
_VALUES = {"language": G.script(), "format": G.post_format(), "sources": "lower(trim(source))"}
_CASUAL_SQL = G.pick([(w, G.rx("lower(t)", G.whole([w]))) for w in L.CASUAL])
_LENGTHS = {"average_characters": "round(avg(length(t)), 1)", "median_characters": "round(median(length(t)), 1)", "shortest_characters": "min(length(t))", "longest_characters": "max(length(t))", "average_words": f"round(avg(len({G.words('t')})), 1)", "median_words": f"round(median(len({G.words('t')})), 1)"}
_COUNTED = " UNION ALL ".join(
    [f"SELECT '{s}' AS section, '{k}' AS key, count(*) AS n FROM posts WHERE {c} HAVING count(*) > 0" for s, flags in _FLAGS.items() for k, c in flags.items()]
    + [f"SELECT '{s}', {v}, count(*) FROM posts GROUP BY {v}" for s, v in _VALUES.items()]
    + [f"SELECT 'question_types', {G.question_type()}, count(*) FROM posts WHERE {G.question_type()} <> 'not_question' GROUP BY 2"]
    + [f"SELECT 'topics', topic, count(*) FROM (SELECT unnest(CASE WHEN len({_TOPICS}) = 0 THEN ['other'] ELSE {_TOPICS} END) AS topic FROM posts) AS z GROUP BY 2"]
    + [f"SELECT 'casual_language', 'posts_with_casual_words', count(*) FROM posts WHERE len({_CASUAL_SQL}) > 0 HAVING count(*) > 0"]
    + [f"SELECT 'casual_words', word, n FROM (SELECT word, count(*) AS n, min(delivery_id) AS first_seen FROM (SELECT delivery_id, unnest({_CASUAL_SQL}) AS word FROM posts) AS y GROUP BY 1 ORDER BY n DESC, first_seen, word LIMIT 20) AS x"]
)


@query(
    f"WITH {G.POSTS}, n AS (SELECT count(*) AS total FROM posts), c AS ({_COUNTED}) SELECT section, key, n::DOUBLE AS value, round(n * 100.0 / (SELECT total FROM n), 1) AS percentage FROM c "
    "UNION ALL SELECT 'dataset', 'total_posts', total, NULL FROM n "
    f"UNION ALL SELECT 'emoji', 'total_emojis', sum({_RUNS}), NULL FROM posts UNION ALL SELECT 'emoji', 'average_emojis_per_post', round(sum({_RUNS}) / count(*), 2), NULL FROM posts "
    + " ".join(f"UNION ALL SELECT 'length', '{k}', ({e})::DOUBLE, NULL FROM posts" for k, e in _LENGTHS.items())
)
def style_profile(spark, sf):
    """The whole profile as rows ``section, key, value, percentage``: dataset and sources, length, language, format,
    questions and their types, emoji, punctuation, casual words, persons, mixing, topics, emotions.

    Every post gives its pairs of section and key, which are counted in one small shuffle; sums, averages and medians of
    the posts are one further row. The word list of a section is cut to its twenty most frequent, as a top-k report.
    """
    t, low = F.col("t"), F.lower("t")
    d = held(table(spark, sf, "raw_telegram_posts").where("text IS NOT NULL"), ["delivery_id", "source"], t=T.normalize("text"))
    flags = {
        "punctuation": {"question_mark": t.contains("?"), "exclamation_mark": t.contains("!"), "ellipsis": t.contains("..."), "multiple_exclamation": t.contains("!!"), "multiple_question": t.contains("??"), "lowercase_start": t.rlike(r"^\p{Ll}")},
        "language_mixing": {"russian": low.rlike("[а-яё]"), "kazakh": low.rlike(L.KAZAKH_LETTERS), "english": low.rlike(T.whole(L.ENGLISH_MARKS))},
        "personal_language": {"first_person": low.rlike(T.whole(L.FIRST_PERSON)), "second_person": low.rlike(T.whole(L.SECOND_PERSON))},
        "emotional_style": {"positive": low.rlike(T.whole(L.POSITIVE)), "negative": low.rlike(T.whole(L.NEGATIVE))},
        "emoji": {"posts_with_emoji": T.emoji_runs("t") > 0},
        "questions": {"question_posts": t.contains("?")},
    }
    values = {"language": T.script("t"), "format": T.post_format("t"), "sources": F.lower(F.trim("source")), "question_types": F.nullif(T.question_type("t"), F.lit("not_question"))}
    pair = lambda s, k: F.struct(F.lit(s).alias("section"), k.alias("key"))
    found = F.concat(
        F.array(*[pair(s, F.when(c, F.lit(k))) for s, part in flags.items() for k, c in part.items()], *[pair(s, v) for s, v in values.items()], pair("casual_language", F.when(F.size("casual") > 0, F.lit("posts_with_casual_words")))),
        F.transform("topics", lambda x: pair("topics", x)),
        F.transform("casual", lambda x: pair("casual_words", x)),
    )
    # The pairs are a projection of their own: there common parts are computed once, in a generator they are not.
    d = d.select("delivery_id", "source", "t", T.listed("t", L.CASUAL).alias("casual"), T.topics("t").alias("topics")).select("delivery_id", found.alias("found"))
    counts = d.select("delivery_id", F.explode_outer("found").alias("x")).where(F.col("x.key").isNotNull()).groupBy("x.section", "x.key").agg(F.count("*").alias("n"), F.min("delivery_id").alias("first_seen"))
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("n"), "first_seen", "key"))  # sections have few keys
    # Every post has one format, so that section's sum is the number of posts.
    total = F.sum(F.when(F.col("section") == "format", F.col("n"))).over(Window.partitionBy())
    counts = counts.withColumn("place", place).withColumn("total", total).where("section <> 'casual_words' OR place <= 20")
    rows = counts.select("section", "key", F.col("n").cast("double").alias("value"), F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("percentage"))

    c, w, e = F.length("t"), F.size(T.split_words("t")), T.emoji_runs("t")
    one = {("dataset", "total_posts"): F.count("*"), ("emoji", "total_emojis"): F.sum(e), ("emoji", "average_emojis_per_post"): F.round(F.sum(e) / F.count("*"), 2)}
    one |= {("length", k): v for k, v in {"average_characters": F.round(F.avg(c), 1), "median_characters": F.round(F.median(c), 1), "shortest_characters": F.min(c), "longest_characters": F.max(c), "average_words": F.round(F.avg(w), 1), "median_words": F.round(F.median(w), 1)}.items()}
    stats = posts(spark, sf).agg(*[v.cast("double").alias(f"c{i}") for i, v in enumerate(one.values())])
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(k).alias("key"), F.col(f"c{i}").alias("value")) for i, (s, k) in enumerate(one)])
    return rows.unionByName(stats.select(F.explode(each).alias("x")).select("x.section", "x.key", "x.value", F.lit(None).cast("double").alias("percentage")))


_NAME = f"len(list_filter(regexp_extract_all(regexp_replace(t, {G.q(S.SENTENCE_START)}, '\\1', 'g'), {G.q('(' + S.TOKEN + ')')}, 1), lambda w: regexp_matches(w, {G.q(S.TITLE)}) AND NOT list_contains({G.arr(S.ALLOWED_CAPITALS)}, lower(w)))) > 0"
_GIVEN = G.rx("lower(t)", L.LEFT + "(?:" + "|".join(S.GIVEN) + r")[\p{L}\p{N}_]{0,3}" + L.RIGHT)
_VIOLATION = "CASE WHEN regexp_matches(t, '[—–]') THEN 'dash' WHEN len(list_filter(regexp_extract_all(t, " + G.q(S.PHONE) + "), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) >= 9)) > 0 THEN 'phone' " + " ".join(f"WHEN {G.rx('t' if n in S.CASED else 'lower(t)', p)} THEN {G.q(n)}" for n, p in S.RULES) + f" WHEN {G.rx('lower(t)', S.PLACEHOLDER)} THEN 'gender_placeholder' WHEN {_NAME} OR {_GIVEN} THEN 'possible_person_name' END"


@query(f"WITH {G.POSTS} SELECT delivery_id, {_VIOLATION} AS violation FROM posts")
def first_violation(spark, sf):
    return posts(spark, sf).select("delivery_id", S.first_violation("t").alias("violation"))


@query(f"WITH {G.POSTS} SELECT delivery_id, {_NAME} AS probable_name, {_GIVEN} AS given_name, len(list_filter(regexp_extract_all(t, {G.q(S.PHONE)}), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) >= 9)) > 0 AS phone FROM posts")
def names_and_phones(spark, sf):
    return posts(spark, sf).select("delivery_id", S.has_probable_name("t").alias("probable_name"), S.has_given_name("t").alias("given_name"), S.has_phone("t").alias("phone"))


_CLEAN0 = f"regexp_replace(regexp_replace({G.NORM}, ' *[—–] *', ' - ', 'g'), '^ *[0-9]{{1,3}}[.)] +', '')"
_CLEAN = f"trim(regexp_replace(regexp_replace(CASE WHEN length(c) > 2 AND regexp_matches(c, '^[\"«“].*[\"»”]$') THEN trim(substr(c, 2, length(c) - 2)) ELSE c END, {G.q(S.REMOVED)}, '', 'g'), ' +', ' ', 'g'))"


@query(f"WITH x AS (SELECT id, {_CLEAN0} AS c FROM (SELECT id, coalesce(text, '') AS text FROM candidates) AS y) SELECT id, {_CLEAN} AS cleaned FROM x")
def clean_post_text(spark, sf):
    return table(spark, sf, "candidates").select("id", S.clean_text("text").alias("cleaned"))


@query(f"WITH {G.POSTS}, v AS (SELECT delivery_id, t, {_VIOLATION} AS violation, {G.pick(G.flags())} AS r FROM posts) SELECT delivery_id, t, {G.word_language()} AS language FROM v WHERE length(t) BETWEEN 15 AND 420 AND violation IS NULL AND len(r) = 0 AND NOT {G.unfit_exemplar()}")
def exemplar_pool(spark, sf):
    """Posts that may stand as examples: of fitting length, without flags and violations, and about nothing local."""
    d = held(table(spark, sf, "raw_telegram_posts").where("text IS NOT NULL"), ["delivery_id"], t=T.normalize("text"))
    d = held(d.where(F.length("t").between(15, 420)), ["delivery_id", "t"], unfit=T.unfit_exemplar("t"), v=S.first_violation("t"), r=T.reasons("t"), language=T.word_language("t"))
    return d.where(F.col("v").isNull() & (F.size("r") == 0) & ~F.col("unfit")).select("delivery_id", "t", "language")


_CAND = f"c AS (SELECT id, {G.NORM} AS t FROM (SELECT id, coalesce(text, '') AS text FROM candidates) AS y)"


@query(f"WITH {_CAND} SELECT id, {', '.join(f'{v} AS {k}' for k, v in G.features().items())} FROM c")
def post_features(spark, sf):
    d = table(spark, sf, "candidates").select("id", T.normalize(F.coalesce("text", F.lit(""))).alias("t"))
    return d.select("id", *[v.alias(k) for k, v in T.features("t").items()])


@query(f"WITH {G.POSTS}, b AS (SELECT {G.bucket('length(t)', L.LENGTH_BANDS)} AS band, count(*) AS n FROM posts GROUP BY 1) SELECT i.band, coalesce(b.n, 0) AS n, greatest(0.25, coalesce(b.n, 0) / (SELECT max(n) FROM b)) AS prior FROM (SELECT unnest(range(0, 7))::INT AS band) AS i LEFT JOIN b ON i.band = b.band")
def length_band_prior(spark, sf):
    counts = posts(spark, sf).groupBy(T.bucket(F.length("t"), L.LENGTH_BANDS).alias("band")).agg(F.count("*").alias("n"))
    bands = spark.range(len(L.LENGTH_BANDS) + 1).select(F.col("id").cast("int").alias("band"))
    d = bands.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return d.withColumn("prior", F.greatest(F.lit(0.25), F.col("n") / F.max("n").over(Window.partitionBy())))


@query(f"WITH {G.POSTS}, c AS (SELECT {G.word_language()} AS language, count(*) AS n FROM posts GROUP BY 1), w AS (SELECT l.language, coalesce(c.n, 0) AS n, greatest(0.06, coalesce(c.n, 0) / (SELECT sum(n) FROM c)) AS w FROM (SELECT unnest(['ru', 'ru_kz', 'kz', 'ru_en', 'en']) AS language) AS l LEFT JOIN c ON l.language = c.language), k AS (SELECT language, n, CASE language WHEN 'kz' THEN least(w, 0.16) WHEN 'ru' THEN greatest(w, 0.36) ELSE w END AS w FROM w) SELECT language, n, round(w / (SELECT sum(w) FROM k), 6) AS weight FROM k")
def language_weights(spark, sf):
    c = posts(spark, sf).groupBy(T.word_language("t").alias("language")).agg(F.count("*").alias("n"))
    all5 = spark.createDataFrame([(x,) for x in ("ru", "ru_kz", "kz", "ru_en", "en")], "language string")
    d = all5.join(c, "language", "left").select("language", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    every = Window.partitionBy()  # five rows
    w = F.greatest(F.lit(0.06), F.col("n") / F.sum("n").over(every))
    w = F.when(F.col("language") == "kz", F.least(w, F.lit(0.16))).when(F.col("language") == "ru", F.greatest(w, F.lit(0.36))).otherwise(w)
    return d.withColumn("w", w).select("language", "n", F.round(F.col("w") / F.sum("w").over(every), 6).alias("weight"))


@query(_of("round(20 * avg(CAST(regexp_matches(t, '^\\p{Ll}') AS DOUBLE)))::INT AS lower_target, 20 - round(20 * avg(CAST(regexp_matches(t, '^\\p{Ll}') AS DOUBLE)))::INT AS upper_target, round(20 * avg(CAST(contains(t, '?') AS DOUBLE)) + 1)::INT AS question_limit"))
def habit_targets(spark, sf):
    low, ask = F.avg(F.col("t").rlike(r"^\p{Ll}").cast("double")), F.avg(F.col("t").contains("?").cast("double"))
    n = F.round(20 * low).cast("int")
    return posts(spark, sf).agg(n.alias("lower_target"), (20 - n).alias("upper_target"), F.round(20 * ask + 1).cast("int").alias("question_limit"))


@query("SELECT delivery_id, source, substr(text, 1, 500) AS head FROM raw_telegram_posts WHERE trim(text) <> '' ORDER BY delivery_id LIMIT 10")
def head_samples(spark, sf):
    return table(spark, sf, "raw_telegram_posts").where(F.trim("text") != "").orderBy("delivery_id").limit(10).select("delivery_id", "source", F.substring("text", 1, 500).alias("head"))


@query(None)
def random_sample(spark, sf):
    """40 posts without replacement, in hash order of a seed."""
    return posts(spark, sf).orderBy(F.xxhash64(F.lit(42), "delivery_id"), "delivery_id").limit(40)


@query(f"WITH {G.POSTS}, u AS (SELECT t FROM posts UNION ALL SELECT {G.NORM} AS t FROM candidates UNION ALL SELECT {G.NORM} FROM documents) SELECT count(*) AS n, count(DISTINCT t) AS n_distinct, sum(length(t)) AS chars FROM u WHERE t <> ''")
def union_sources(spark, sf):
    parts = [table(spark, sf, n).select(T.normalize("text").alias("t")) for n in ("raw_telegram_posts", "candidates", "documents")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("t <> ''")
    return u.agg(F.count("*").alias("n"), F.count_distinct("t").alias("n_distinct"), F.sum(F.length("t")).alias("chars"))


@query(f"WITH {G.POSTS}, flagged AS (SELECT DISTINCT t FROM posts WHERE len({G.pick(G.flags())}) > 0) SELECT i.id FROM candidates AS i WHERE i.text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM flagged WHERE flagged.t = trim(regexp_replace(replace(i.text, chr(8203), ''), {G.q(L.BLANK + '+')}, ' ', 'g')))")
def anti_flagged(spark, sf):
    c = table(spark, sf, "candidates").where("text IS NOT NULL").select("id", T.normalize("text").alias("t"))
    p = held(table(spark, sf, "raw_telegram_posts").where("text IS NOT NULL"), [], t=T.normalize("text"))
    flagged = held(p, ["t"], r=T.reasons("t")).where(F.size("r") > 0).select("t").distinct()
    return c.join(flagged, "t", "left_anti").select("id")


@query(f"WITH {G.POSTS}, f AS (SELECT delivery_id, list_distinct({G.stems(G.tokens('t'))}) AS s FROM posts), x AS (SELECT delivery_id, unnest(s) AS stem FROM f) SELECT stem, count(*) AS n FROM x WHERE length(stem) >= 5 GROUP BY 1 HAVING count(*) >= 4")
def stem_document_frequency(spark, sf):
    x = posts(spark, sf).select(F.explode(T.stems(T.tokens("t"))).alias("stem")).where(F.length("stem") >= 5)
    return x.groupBy("stem").agg(F.count("*").alias("n")).where("n >= 4")


@query(f"WITH {G.POSTS} " + " UNION ALL ".join(f"SELECT {G.q(k)} AS phrase, count_if({G.rx('lower(t)', p)}) AS n FROM posts" for k, p in L.WARN_PHRASES.items()))
def phrase_warnings(spark, sf):
    low = F.lower("t")
    d = posts(spark, sf).agg(*[F.count_if(low.rlike(p)).alias(f"c{i}") for i, p in enumerate(L.WARN_PHRASES.values())])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("phrase"), F.col(f"c{i}").alias("n")) for i, k in enumerate(L.WARN_PHRASES)]))
    return d.select(pairs.alias("x")).select("x.phrase", "x.n")
