"""Queries with similarity joins and order-sensitive selection, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import safety as S
from ..functions import text as T
from ..operators.similarity_join import greedy_keep, greedy_vectors, round_robin, set_links, set_similarity_join, shared_gram, vector_pairs
from ..operators.set_matches import set_matches
from ..session import materialize, table
from . import sqlgen as G
from .text_queries import _VIOLATION, posts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "candidates").where("text IS NOT NULL").select(F.col("id").cast("long").alias("id"), T.normalize("text").alias("t"))


_C = f"c AS (SELECT id::BIGINT AS id, {G.NORM} AS t FROM candidates WHERE text IS NOT NULL)"
_GRAMS = "list_distinct(list_transform(range(1, greatest(len(ws) - 3, 1)), lambda i: array_to_string(ws[i:i + 4], ' ')))"


@query(f"WITH {G.POSTS}, {_C}, cg AS (SELECT id, unnest({_GRAMS}) AS g FROM (SELECT id, {G.tokens('t')} AS ws FROM c) AS x), pg AS (SELECT DISTINCT unnest({_GRAMS}) AS g FROM (SELECT {G.tokens('t')} AS ws FROM posts) AS y) SELECT DISTINCT id FROM cg WHERE g IN (SELECT g FROM pg)")
def copy_5gram(spark, sf):
    # Tokens are a column of their own: inside the grams' lambda they would be computed for every gram.
    x = candidates(spark, sf).select("id", T.tokens("t").alias("ws"))
    y = posts(spark, sf).select(T.tokens("t").alias("ws"))
    return shared_gram(x.select("id", T.grams(F.col("ws")).alias("g")), y.select(T.grams(F.col("ws")).alias("g")))


def _overlap(x: str, y: str, t: float, more: str) -> str:
    """SQL: pairs of sets at ``t`` by an inverted index."""
    return f"SELECT a.id AS a, b.id AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb FROM {x} AS a JOIN {y} AS b ON a.w = b.w {more} GROUP BY 1, 2 HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*)) >= {t}"


def _flat(name: str, src: str, ident: str, text: str = "t") -> str:
    return f"{name} AS (SELECT id, len(s) AS n, unnest(s) AS w FROM (SELECT {ident} AS id, {G.stems(G.tokens(text))} AS s FROM {src}) AS z)"


@query(f"WITH {G.POSTS}, {_C}, {_flat('cs', 'c', 'id')}, {_flat('ps', 'posts', 'delivery_id')}, p AS ({_overlap('cs', 'ps', 0.55, 'WHERE a.n >= 4')}) SELECT DISTINCT a AS id FROM p")
def copy_jaccard(spark, sf):
    x = candidates(spark, sf).select("id", F.lower("t").alias("low"))
    return set_matches(x, posts(spark, sf).select(F.lower("t").alias("low")), 0.55, 4)


@query(f"WITH {_C}, {_flat('cs', 'c', 'id')} SELECT a, b, round(o / (na + nb - o), 6) AS similarity FROM ({_overlap('cs', 'cs', 0.8, 'AND a.id < b.id')}) AS p")
def near_dup_pairs(spark, sf):
    pairs = set_similarity_join(candidates(spark, sf).select("id", T.stems(T.tokens("t")).alias("s")), 0.8)
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_C} SELECT id, k FROM (SELECT id, regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g') AS k FROM c) AS x QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1")
def exact_dedupe(spark, sf):
    # The first of each key as a minimum: combined before the shuffle, however many copies a key has.
    return candidates(spark, sf).groupBy(T.dedupe_key("t").alias("k")).agg(F.min("id").alias("id")).select("id", "k")


_SEEDS = "s AS (SELECT id::BIGINT AS id, domain, theme, subject, embedding::DOUBLE[] AS v FROM seeds)"


def _seed_vectors(spark, sf):
    return table(spark, sf, "seeds").select("id", T.unit(F.col("embedding").cast("array<double>")).alias("v"))


@query(f"WITH {_SEEDS}, u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM s WHERE v IS NOT NULL) SELECT a.id AS a, b.id AS b, round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 6) AS cosine FROM u AS a JOIN u AS b ON a.id < b.id WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) >= 0.45")
def cosine_pairs(spark, sf):
    return vector_pairs(_seed_vectors(spark, sf), L.SIMILARITY["embedding"]["soft"], digits=6)


@query("SELECT id, domain, turn, lead FROM (SELECT id, domain, row_number() OVER (PARTITION BY domain ORDER BY id) AS turn, min(id) OVER (PARTITION BY domain) AS lead FROM seeds) AS x")
def round_robin_order(spark, sf):
    return round_robin(table(spark, sf, "seeds").select("id", "domain"), "domain", "id")


_ORDERED = "o AS (SELECT id, row_number() OVER (ORDER BY turn, lead) AS rn FROM (SELECT id, row_number() OVER (PARTITION BY domain ORDER BY id) AS turn, min(id) OVER (PARTITION BY domain) AS lead FROM s) AS x)"


def _fold(pairs: str) -> str:
    """SQL: the sequential fold over rows in order, with the neighbours before each."""
    return f"""p AS ({pairs}), nb AS (SELECT x.rn, list(y.rn) AS ys FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) AS e JOIN o AS x ON x.id = e.a JOIN o AS y ON y.id = e.b WHERE y.rn < x.rn GROUP BY x.rn),
r AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL SELECT r.i + 1, CASE WHEN list_has_any(r.kept, coalesce(nb.ys, []::BIGINT[])) THEN r.kept ELSE list_append(r.kept, r.i + 1) END FROM r LEFT JOIN nb ON nb.rn = r.i + 1 WHERE r.i < (SELECT max(rn) FROM o)),
f AS (SELECT unnest(kept) AS rn FROM r WHERE i = (SELECT max(rn) FROM o))"""


def _places(spark, sf):
    d = round_robin(table(spark, sf, "seeds").select(F.col("id").cast("long").alias("id"), "domain"), "domain", "id")
    return d.select("id", F.struct("turn", "lead").alias("place"))


_COS = "SELECT a.id AS a, b.id AS b FROM u AS a JOIN u AS b ON a.id < b.id WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) >= 0.6"


@query(f"WITH RECURSIVE {_SEEDS}, u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM s WHERE v IS NOT NULL), {_ORDERED}, {_fold(_COS)} SELECT o.id FROM f JOIN o ON o.rn = f.rn")
def greedy_semantic_dedupe(spark, sf):
    vectors = _seed_vectors(spark, sf).withColumn("id", F.col("id").cast("long"))
    return greedy_vectors(_places(spark, sf).join(vectors, "id"), L.SIMILARITY["embedding"]["seed"])


_LEX = _overlap("fs", "fs", 0.45, "AND a.id < b.id")


@query(f"WITH RECURSIVE {_SEEDS}, {_flat('fs', 's', 'id', chr(99) + 'oalesce(theme, ' + chr(39) * 2 + ') || ' + chr(39) + ' ' + chr(39) + ' || coalesce(subject, ' + chr(39) * 2 + ')')}, {_ORDERED}, {_fold('SELECT a, b FROM (' + _LEX + ') AS l')} SELECT o.id FROM f JOIN o ON o.rn = f.rn")
def greedy_lexical_dedupe(spark, sf):
    text = F.concat_ws(" ", F.coalesce("theme", F.lit("")), F.coalesce("subject", F.lit("")))
    sets = table(spark, sf, "seeds").select(F.col("id").cast("long").alias("id"), T.stems(T.tokens(text)).alias("s"))
    places = _places(spark, sf)
    links, members, _ = set_links(sets.join(places, "id"), 0.45, first="place")
    # A copy is dropped in any case: its first is kept, or dropped for a kept one before it that is like the copy too.
    copies = members.where("id <> rep").select("id")
    return greedy_keep(places.join(copies, "id", "left_anti"), links.select("a", "b")).where("kept").select("id")


_LOCAL = f"""
WITH RECURSIVE {G.POSTS}, {_C},
cg AS (SELECT id, unnest({_GRAMS}) AS g FROM (SELECT id, {G.tokens('t')} AS ws FROM c) AS x), pg AS (SELECT DISTINCT unnest({_GRAMS}) AS g FROM (SELECT {G.tokens('t')} AS ws FROM posts) AS y),
{_flat('cs', 'c', 'id')}, {_flat('ps', 'posts', 'delivery_id')},
copied AS (SELECT id FROM cg WHERE g IN (SELECT g FROM pg) UNION SELECT a FROM ({_overlap('cs', 'ps', 0.55, 'WHERE a.n >= 4')}) AS z),
first AS (SELECT id, t, regexp_replace(lower(t), '[^a-zа-яёәіңғқөұүһ0-9]', '', 'g') AS k, CASE WHEN length(t) < 10 THEN 'too_short' WHEN length(t) > 550 THEN 'too_long' ELSE coalesce({_VIOLATION}, CASE WHEN id IN (SELECT id FROM copied) THEN 'copies_source' END) END AS reason FROM c),
left_over AS (SELECT id, k FROM first WHERE reason IS NULL),
o AS (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM left_over),
ls AS (SELECT cs.* FROM cs JOIN left_over USING (id)),
{_fold('SELECT a, b FROM (' + _overlap('ls', 'ls', 0.8, 'AND a.id < b.id') + ') AS l UNION SELECT x.id, y.id FROM left_over AS x JOIN left_over AS y ON x.k = y.k AND x.id < y.id')},
kept AS (SELECT o.id, left_over.k FROM f JOIN o ON o.rn = f.rn JOIN left_over ON left_over.id = o.id)
SELECT first.id, CASE WHEN first.reason IS NOT NULL THEN first.reason WHEN kept.id IS NOT NULL THEN 'survivor' WHEN EXISTS (SELECT 1 FROM kept AS k2 WHERE k2.k = first.k AND k2.id < first.id) THEN 'exact_duplicate' ELSE 'lexical_near_duplicate' END AS outcome
FROM first LEFT JOIN kept ON kept.id = first.id"""


@query(_LOCAL)
def local_clean(spark, sf):
    """The first reason against each candidate; among the rest, copies and near copies of earlier survivors."""
    c = candidates(spark, sf)
    copied = copy_5gram(spark, sf).unionByName(copy_jaccard(spark, sf)).distinct().withColumn("copied", F.lit(True))
    reason = F.when(F.length("t") < 10, "too_short").when(F.length("t") > 550, "too_long").otherwise(F.coalesce(S.first_violation("t"), F.when(F.col("copied"), F.lit("copies_source"))))
    first = materialize(c.join(copied, "id", "left").select("id", T.dedupe_key("t").alias("k"), T.stems(T.tokens("t")).alias("s"), reason.alias("reason")), "local-clean")
    rest = first.where("reason IS NULL")
    links, members, _ = set_links(rest.select("id", "s"), 0.8)
    # A copy of a word set is dropped in any case: its first is kept, or dropped for a kept one before it that is like the
    # copy too. Those that are left with one key have different word sets, so they are few.
    alone = materialize(rest.select("id", "k").join(members.where("id <> rep").select("id"), "id", "left_anti"), "local-alone")
    same = alone.select(F.col("id").alias("a"), "k").join(alone.select(F.col("id").alias("b"), "k"), "k").where("a < b").select("a", "b")
    state = greedy_keep(alone.select("id", F.col("id").alias("place")), same.union(links.select("a", "b")))
    kept = state.where("kept").join(rest.select("id", "k"), "id").groupBy("k").agg(F.min("id").alias("kept_id"))
    out = first.join(state, "id", "left").join(kept, "k", "left")
    return out.select("id", F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("kept"), "survivor").when(F.col("kept_id") < F.col("id"), "exact_duplicate").otherwise("lexical_near_duplicate").alias("outcome"))
