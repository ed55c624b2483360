"""The pN_ queries of the problems tagged llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    from .lookalike import lookalike_pairs

    return lookalike_pairs(table(spark, sf, "raw_telegram_posts")).select(F.col("a").alias("delivery_id_a"), F.col("b").alias("delivery_id_b"))


@query
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    from .neardup import near_duplicates, row_pairs, texts_of

    links, members = near_duplicates(texts_of(table(spark, sf, "raw_telegram_posts"), table(spark, sf, "candidates")), 0.7, 10)
    return row_pairs(links, members).select(F.col("src").alias("src_table"), "id_a", "id_b")

@query
def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    from .neardup import groups, near_duplicates, texts_of

    links, members = near_duplicates(texts_of(table(spark, sf, "raw_telegram_posts"), table(spark, sf, "candidates")), 0.7, 10)
    return groups(links, members).select(F.col("src").alias("src_table"), F.col("id").alias("row_id"), "group_id", "links")


@query
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    from .leakage import leaks

    return leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


@query
def p9_passages(spark: SparkSession, sf: str) -> DataFrame:
    from .leakage import leaked_passages

    return leaked_passages(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


@query
def p9_clean(spark: SparkSession, sf: str) -> DataFrame:
    from .leakage import without_leaks

    return without_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "source", "lang", "n_chars")


@query
def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    from .spam import spam_pages

    return spam_pages(table(spark, sf, "documents")).select("doc_id")


@query
def p10_profiles(spark: SparkSession, sf: str) -> DataFrame:
    from .spam import page_profiles

    return page_profiles(table(spark, sf, "documents"))


@query
def p8_containers_512(spark: SparkSession, sf: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf, "documents"), 512)


@query
def p8_containers_2048(spark: SparkSession, sf: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf, "documents"), 2048)


@query
def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    from ..session import materialize
    from .packing import pack, packing_report, token_counts

    docs = table(spark, sf, "documents")
    counted = materialize(token_counts(docs), "tokens")
    out = [packing_report(pack(docs, c, counted=counted), c).select(F.lit(c).alias("capacity"), "*") for c in (512, 2048)]
    return out[0].unionByName(out[1])


def _abuse(spark: SparkSession, sf: str) -> DataFrame:
    from .abuse import abuse_scores, train
    from .lookalike import source_key

    posts, candidates = table(spark, sf, "raw_telegram_posts"), table(spark, sf, "candidates")
    model = train(spark, posts, table(spark, sf, "review_labels"))
    texts = posts.select(F.lit("raw_telegram_posts").alias("src"), F.col("delivery_id").cast("long").alias("id"), source_key(F.col("source")).alias("grp"), "text")
    texts = texts.unionByName(candidates.select(F.lit("candidates").alias("src"), F.col("id").cast("long").alias("id"), F.lit("").alias("grp"), "text"))
    return abuse_scores(texts, model)


@query
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    from .abuse import THRESHOLD

    return _abuse(spark, sf).where(F.col("score") >= THRESHOLD).select(F.col("src").alias("src_table"), F.col("id").alias("row_id"))


@query
def p3_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _abuse(spark, sf).select(F.col("src").alias("src_table"), F.col("id").alias("row_id"), F.round("score", 4).alias("score"))


@query
def p3_source_rates(spark: SparkSession, sf: str) -> DataFrame:
    from .abuse import rates

    return rates(_abuse(spark, sf).where("src = 'raw_telegram_posts'")).withColumnRenamed("grp", "source")


def _deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_telegram_posts").select(F.col("delivery_id").cast("long").alias("id"), "text")


@query
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    from .pii import occurrences, protected, session_key

    return occurrences(protected(_deliveries(spark, sf), session_key(spark)))


@query
def p5_texts(spark: SparkSession, sf: str) -> DataFrame:
    from .pii import replace_items, session_key

    return replace_items(_deliveries(spark, sf), session_key(spark)).withColumnRenamed("id", "delivery_id")


@query
def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    from .langmix import candidate_languages, wrong_labels

    c = table(spark, sf, "candidates")
    return wrong_labels(c, candidate_languages(c))


@query
def p7_segments(spark: SparkSession, sf: str) -> DataFrame:
    from .langmix import candidate_languages

    found = candidate_languages(table(spark, sf, "candidates"))
    s = found.select("id", "code", "confidence", F.posexplode_outer("segments").alias("n", "s"))
    return s.select("id", "code", "confidence", "n", F.col("s.start").alias("start"), F.col("s.stop").alias("stop"), F.col("s.lang").alias("lang"), F.col("s.confidence").alias("segment_confidence"))


@query
def p6_subset_20(spark: SparkSession, sf: str) -> DataFrame:
    from .subset import varied_subset

    return varied_subset(table(spark, sf, "candidates"), 20)


@query
def p6_subset_200(spark: SparkSession, sf: str) -> DataFrame:
    from .subset import varied_subset

    return varied_subset(table(spark, sf, "candidates"), 200)


# --- what must hold whatever the model finds, with SQL of its own ---


@query
def p3_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows of each source: every delivery has a score, also without text."""
    return p3_source_rates(spark, sf).select("source", "n_rows")


ORACLES["p3_rows"] = r"SELECT coalesce(lower(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '') AS source, count(*) AS n_rows FROM raw_telegram_posts GROUP BY 1"


@query
def p5_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The texts with items, put together again from what stands between the items and the items themselves."""
    from .pii import items

    d = _deliveries(spark, sf)
    spans = items(d).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("s"))
    cut = lambda a, b: F.substring(F.col("text"), a + 1, b - a)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, x: F.struct(x["stop"].alias("at"), F.concat(acc["out"], cut(acc["at"], x["start"]), cut(x["start"], x["stop"])).alias("out"))
    whole = d.join(spans, "id", "left").withColumn("acc", F.aggregate(F.coalesce("s", F.array().cast("array<struct<start:int,stop:int>>")), start, step))
    return whole.select(F.col("id").alias("delivery_id"), F.concat(F.col("acc.out"), cut(F.col("acc.at"), F.length("text"))).alias("text"))


ORACLES["p5_restored"] = "SELECT delivery_id, text FROM raw_telegram_posts"


@query
def p7_covered(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates that got a language: all with a letter."""
    from .langmix import candidate_languages

    return candidate_languages(table(spark, sf, "candidates")).select(F.col("id").cast("int").alias("id"), F.col("code").isNotNull().alias("has_code"))


ORACLES["p7_covered"] = "SELECT id, coalesce(regexp_matches(text, '\\p{L}'), false) AS has_code FROM candidates"


@query
def p8_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Breaches for each capacity: documents without a place, lost or doubled tokens, overfull containers, needless splits."""
    from ..session import materialize
    from .packing import pack, token_counts

    docs = table(spark, sf, "documents")
    counted = materialize(token_counts(docs), "tokens")
    out = None
    for c in (512, 2048):
        p = materialize(pack(docs, c, counted=counted), "packed")
        per = p.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"))
        each = counted.join(per, "doc_id", "left").agg(
            F.count_if(F.col("n").isNull()).alias("without_place"), F.count_if(F.coalesce("n", "n_tokens") != F.col("n_tokens")).alias("other_tokens"), F.count_if(F.col("pieces") > F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / c))).alias("needless_splits")
        )
        full = p.where("n_tokens > 0").groupBy("container").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > c).alias("overfull"))
        row = each.crossJoin(full).select(F.lit(c).alias("capacity"), "without_place", "other_tokens", "needless_splits", "overfull")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


ORACLES["p8_invariants"] = "SELECT c AS capacity, 0::BIGINT AS without_place, 0::BIGINT AS other_tokens, 0::BIGINT AS needless_splits, 0::BIGINT AS overfull FROM (VALUES (512), (2048)) AS v(c)"


@query
def p10_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose profile is no profile: more stuffing, links or repeats than words, or no words where there are letters."""
    p = p10_profiles(spark, sf).join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    bad = (F.greatest("stuffed", "links", "repeated") > F.col("words")) | ((F.col("words") > 0) != F.col("text").rlike(r"[\p{L}\p{N}]"))
    return p.agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))


ORACLES["p10_bounds"] = "SELECT count(*) AS n, 0::BIGINT AS bad FROM documents"


def _subset_oracles() -> None:
    from .subset import subset_sql

    for k in (20, 200):
        ORACLES[f"p6_subset_{k}"] = subset_sql(k, "candidates", duckdb=True)


_subset_oracles()


#: What a reader sees, written apart from ``canonical``: nothing invisible, ordinary forms, composed marks, and one letter
#: for all that look like it.
_BARE = (
    "nfc_normalize(translate(regexp_replace(regexp_replace(text, '([^\\p{So}\\p{Sk}\\x{FE0F}])\\x{200D}+', '\\1', 'g'), '[\\x{00AD}\\x{034F}\\x{061C}\\x{180E}\\x{200B}\\x{200C}\\x{200E}\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{FE00}-\\x{FE0F}\\x{FEFF}]', '', 'g'), "
    "array_to_string(list_transform(range(65281, 65375), lambda c: chr(c::INT)), '') || chr(160) || chr(8239) || chr(8287) || chr(12288) || chr(9) || array_to_string(list_transform(range(8192, 8203), lambda c: chr(c::INT)), '') || chr(8209) || chr(8208), "
    "array_to_string(list_transform(range(33, 127), lambda c: chr(c::INT)), '') || repeat(' ', 16) || '--'))"
)
_ALIKE = "'асеорхуіјѕһԁԛԝАВСЕНКМОРТХУІЈЅёЁїЇΑΒΕΖΗΙΚΜΝΟΡΤΥΧον', 'aceopxyijshdqwABCEHKMOPTXYIJSëËïÏABEZHIKMNOPTYXov'"
_SEEN = f"nfc_normalize(translate({_BARE}, {_ALIKE}))"
#: Words: look-alikes are Cyrillic when their case is changed, if the word has other Cyrillic letters, or none but look-alikes in a Cyrillic text.
_CYRILLIC, _LATIN = "[бвгджзийклмнптфцчшщъыьэюяәғқңөұүБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯӘҒҚҢӨҰҮ]", "[bfgklmnrtuvzDFGLNQRUVWZ]"
_LETTERS = (
    f"list_transform(regexp_extract_all({_BARE}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: translate(lower(CASE WHEN regexp_matches(w, '{_CYRILLIC}') OR NOT regexp_matches(w, '{_LATIN}') AND len(regexp_extract_all(text, '{_CYRILLIC}')) >= len(regexp_extract_all(text, '{_LATIN}')) "
    f"THEN translate(w, 'aceopxyiABCEHKMOPTXYI', 'асеорхуіАВСЕНКМОРТХУІ') ELSE translate(w, {_ALIKE}) END), {_ALIKE}))"
)


def _pair_oracles() -> None:
    """SQL for the pair queries: every pair by joining on what a reader sees, or on every word or gram."""
    source = r"coalesce(lower(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '')"
    posts = f"SELECT delivery_id, {source} AS s, telegram_message_id AS m, text FROM raw_telegram_posts WHERE text IS NOT NULL"
    ORACLES["p1_found"] = (
        f"WITH k AS (SELECT *, trim({_SEEN}, ' ' || chr(10)) AS key FROM ({posts}) AS p WHERE regexp_matches(text, '\\p{{L}}')) "
        "SELECT a.delivery_id AS delivery_id_a, b.delivery_id AS delivery_id_b FROM k AS a JOIN k AS b ON a.key = b.key AND a.delivery_id < b.delivery_id WHERE a.text <> b.text AND (a.s <> b.s OR a.m IS DISTINCT FROM b.m)"
    )
    union = f"SELECT 'raw_telegram_posts' AS src, delivery_id AS id, s || ':' || m AS msg, text FROM ({posts}) AS p UNION ALL SELECT 'candidates', id, id::VARCHAR, text FROM candidates WHERE text IS NOT NULL"
    ORACLES["p4_found"] = (
        f"WITH w AS (SELECT src, id, msg, list_distinct({_LETTERS}) AS ws FROM ({union}) AS u), f AS (SELECT src, id, msg, len(ws) AS n, unnest(ws) AS x FROM w WHERE len(ws) >= 10) "
        "SELECT a.src AS src_table, a.id AS id_a, b.id AS id_b FROM f AS a JOIN f AS b ON a.src = b.src AND a.x = b.x AND a.id < b.id AND a.msg <> b.msg AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) "
        "GROUP BY a.src, a.id, b.id HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.7"
    )
    grams = "unnest(list_transform(range(1, greatest(len(ws) - 10, 1)), lambda i: array_to_string(ws[i:i + 11], ' ')))"
    words = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
    ORACLES["p9_found"] = f"WITH d AS (SELECT doc_id, {grams} AS g FROM (SELECT doc_id, {words} AS ws FROM documents) AS x), i AS (SELECT item_id, {grams} AS g FROM (SELECT item_id, {words} AS ws FROM eval_items) AS y) SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (g)"


_pair_oracles()
