import random

import numpy as np
import pytest

from weftline.llm.neardup import _pairs_of, groups, near_duplicates, plan_bands, row_pairs


def texts(n=60, seed=0):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("абвгдежз") for _ in range(5))
    out = []
    for _ in range(n):
        base = [word() for _ in range(rnd.randrange(12, 30))]
        out.append(" ".join(base))
        for _ in range(rnd.randrange(4)):
            edited = [w for w in base if rnd.random() > 0.06] + [word()] * (rnd.random() < 0.5)
            rnd.shuffle(edited)
            out.append(" ".join(edited))
    return out + ["короткий текст"] * 3 + [None, "", out[0], out[0].upper()]


def brute(rows, t, least):
    sets = {i: frozenset((x or "").lower().split()) for i, _, x in rows}
    msg = {i: m for i, m, _ in rows}
    ids = [i for i in sets if len(sets[i]) >= least]
    j = lambda a, b: len(a & b) / len(a | b)
    return {(a, b) for a in ids for b in ids if a < b and msg[a] != msg[b] and j(sets[a], sets[b]) >= t}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_pairs_against_brute_force(spark, hot):
    rows = [(i, i // 2 if i % 9 == 0 else 1000 + i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([("s", *r) for r in rows], "src string, id long, msg long, text string")
    links, members = near_duplicates(df, 0.7, 10, hot=hot)
    got = [(r.id_a, r.id_b) for r in row_pairs(links, members, block=2).collect()]
    want = brute(rows, 0.7, 10)
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(set(got)) >= 0.98 * len(want) > 0
    # groups are the connected parts of those pairs
    parent = {r.id: r.id for r in members.collect()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    cls = {}
    for r in members.collect():
        cls.setdefault(r.cls, []).append(r.id)
    for a, b in [*got, *((m[0], x) for m in cls.values() for x in m)]:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert {r.id: r.group_id for r in groups(links, members).collect()} == {i: root(i) for i in parent}


def test_sources_stay_apart_and_empty_tables(spark):
    t = texts(1)[0]
    df = spark.createDataFrame([("a", 1, 1, t), ("b", 1, 2, t), ("a", 2, 3, t)], "src string, id long, msg long, text string")
    links, members = near_duplicates(df, 0.7, 10)
    assert [(r.src, r.id_a, r.id_b) for r in row_pairs(links, members).collect()] == [("a", 1, 2)]
    links, members = near_duplicates(df.limit(0), 0.7, 10)
    assert row_pairs(links, members).count() == 0 and groups(links, members).count() == 0


def test_plan_reaches_the_recall():
    p = plan_bands(0.7, 0.99)
    assert 1 - (1 - 0.7**p.rows) ** p.bands >= 0.99


def test_pairs_of_equal_hashes_and_allowed_sizes_in_portions():
    rng = np.random.default_rng(3)
    h, n = rng.integers(0, 4, 60).astype(np.uint32), np.where(rng.random(60) < 0.2, 255, rng.integers(10, 60, 60)).astype(np.int16)
    order = np.lexsort((n, h))
    h, n = h[order], n[order]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if h[i] == h[j] and n[i] >= 0.7 * n[j]}
    got = [(int(a), int(b)) for x, y in _pairs_of(h, n, 0.7, step=5) for a, b in zip(x, y)]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_phrase_that_all_texts_share(spark):
    """Texts with half of their words in common: most of their bands are hot, and their links are still found."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    phrase, rows = [word() for _ in range(12)], []
    for i in range(400):
        own = [word() for _ in range(12)]
        rows.append(" ".join(phrase + own))
        if i % 4 == 0:
            rows.append(" ".join(phrase + own[:9] + [word()]))
    rows = [(i, i, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame([("s", *r) for r in rows], "src string, id long, msg long, text string")
    links, members = near_duplicates(df, 0.7, 10, hot=20)
    got, want = {(r.id_a, r.id_b) for r in row_pairs(links, members).collect()}, brute(rows, 0.7, 10)
    assert got <= want and len(got) >= 0.98 * len(want) >= 90
