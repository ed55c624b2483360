"""Problem 6: a varied subset of given size.

Method: multi-attribute grid round-robin, in SQL only. Records are binned by type, topic and language into cells and
ranked within their cell by score; the order is by rank, then cell, and the first k are kept. Cells of one rank stand
in the order of their turn: a record's turn is its rank within its type, topic and language, each times the number of
values, so that after n records each value has had about its share.

Similar texts share keys of word minima (three keys of three minima each); a record's rank is at least its rank among
the records with one of its keys, so the second of a group of similar texts comes no sooner than a second record of a
cell. All window functions rank up to k only: Spark limits each group before its shuffle, so a cell or key with a third
of all rows costs k rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_WORD = "[a-zа-яёәіңғқөұүһ0-9]+"


def subset_sql(k: int, source: str, duckdb: bool = False) -> str:
    """The query over relation ``source``; the two dialects differ in the names of a few functions."""
    if duckdb:
        words = f"list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{_WORD}'))"
        each, least, size, digest = "list_transform(ws, lambda w: {f})", "list_min", "len", "sha1(w)"
        apply = lambda f: each.format(f=f)
    else:
        words = f"array_distinct(regexp_extract_all(lower(coalesce(text, '')), '{_WORD}', 0))"
        least, size, digest = "array_min", "size", "sha1(w)"
        apply = lambda f: f"transform(ws, w -> {f})"

    def part(i: int) -> str:
        h, at = ("md5(w)", 1 + 8 * i) if i < 4 else (digest, 1 + 8 * (i - 4))
        return f"{least}({apply(f'substr({h}, {at}, 8)')})"

    minima = ", ".join(f"coalesce({part(i)}, cast(id AS varchar(20))) AS m{i}" for i in range(9))
    keys = ", ".join(f"concat(m{3 * i}, m{3 * i + 1}, m{3 * i + 2}) AS k{i}" for i in range(3))
    best = "score DESC NULLS LAST, id"
    attribute = lambda c: f"coalesce(nullif(lower(trim({c})), ''), '-')"
    ranked = "binned"
    steps = []
    for name, group in (("r0", "k0"), ("r1", "k1"), ("r2", "k2"), ("r3", "a, b, c")):
        steps.append(f"{name}_all AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {best}) AS {name} FROM {ranked}), {name}_top AS (SELECT * FROM {name}_all WHERE {name} <= {k})")
        ranked = f"{name}_top"
    steps.append(f"cells AS (SELECT *, greatest(r0, r1, r2, r3) AS cell_rank FROM {ranked})")
    ranked = "cells"
    for name, group in (("ra", "a"), ("rb", "b"), ("rc", "c")):
        steps.append(f"{name}_all AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY cell_rank, {best}) AS {name} FROM {ranked}), {name}_top AS (SELECT * FROM {name}_all WHERE {name} <= {k})")
        ranked = f"{name}_top"
    return f"""
WITH split AS (SELECT id, {attribute("post_type")} AS a, {attribute("topic")} AS b, {attribute("language")} AS c, score, {words} AS ws FROM {source} WHERE id IS NOT NULL),
minima AS (SELECT id, a, b, c, score, {minima} FROM split),
binned AS (SELECT id, a, b, c, score, {keys} FROM minima),
{", ".join(steps)},
wide AS (SELECT count(DISTINCT a) AS na, count(DISTINCT b) AS nb, count(DISTINCT c) AS nc FROM rc_top)
SELECT id, a AS post_type, b AS topic, c AS language, score, cell_rank
FROM (SELECT *, greatest(ra * (SELECT na FROM wide), rb * (SELECT nb FROM wide), rc * (SELECT nc FROM wide)) AS turn FROM rc_top) AS turns
ORDER BY cell_rank, turn, a, b, c, score DESC NULLS LAST, id LIMIT {k}"""


def varied_subset(candidates: DataFrame, k: int) -> DataFrame:
    """``k`` records (all, if there are fewer): ``id, post_type, topic, language, score, cell_rank``.

    Null and blank attributes are one value (``-``). Null scores rank last. Texts without words (null, blank) are alike to
    none. Ties go to the smaller id; rows without an id are left out; repeated ids are records each. An empty table gives
    no rows. Further columns are not read.
    """
    return candidates.sparkSession.sql(subset_sql(k, "{src}"), src=candidates)
