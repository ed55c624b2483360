import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.leakage import leaked_passages, leaks, without_leaks
from weftline.llm.packing import fill, pack, patterns
from weftline.llm.spam import automaton, covered_words, profile, spam_pages


def test_leaks_against_brute_force(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(30))) for i in range(6)] + [(90, None), (91, ""), (92, "too short")]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(40)]
    for i, n in enumerate([8, 11, 12, 13, 30]):
        w = items[i][1].split()
        docs.append((100 + i, "Так, **" + "**, ".join(w[:n]).upper() + " <b>конец</b> " + docs[i][1]))
    docs += [(200, None), (201, ""), (202, docs[44][1])]
    run = lambda t: {tuple(t[k : k + 12]) for k in range(len(t) - 11)}
    split = lambda t: "".join(c.lower() if c.isalnum() else " " for c in (t or "").replace("<b>", " ").replace("</b>", " ")).split()
    want = {(d, i) for d, t in docs for i, x in items if run(split(t)) & run(split(x))}
    d, x = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for how in ({}, {"block_words": 40, "shard_words": 50}):
        assert {(r.doc_id, r.item_id) for r in leaks(d, x, **how).collect()} == want
    m = {(r.doc_id, r.item_id): r.n_words for r in leaked_passages(d, x).collect() if r.doc_id in (102, 103, 104)}
    assert m[102, 2] == 12 and m[103, 3] == 13 and m[104, 4] == 30
    assert without_leaks(d, x).count() == len(docs) - len({a for a, _ in want})
    assert leaks(d.limit(0), x).count() == 0 and leaks(d, x.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=24))
def test_automaton_counts_every_substring(words):
    seq, k = [], -1
    for w in words:
        seq.append(w if w >= 0 else k)
        k -= w < 0
    length, link, count, end, _ = automaton(seq)
    for s in range(1, len(length)):
        sub = seq[end[s] - length[s] + 1 : end[s] + 1]
        assert count[s] == sum(seq[i : i + len(sub)] == sub for i in range(len(seq)))
    distinct = {tuple(seq[i:j]) for i in range(len(seq)) for j in range(i + 1, len(seq) + 1) if min(seq[i:j]) >= 0}
    assert sum(length[s] - length[link[s]] for s in range(1, len(length))) == len(distinct)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=20), st.integers(2, 4), st.integers(0, 25))
def test_coverage_by_heavy_repeats(words, least, mass):
    seq, k = [], -1
    for w in words:
        seq.append(w if w >= 0 else k)
        k -= w < 0
    chars = [1 + w % 3 if w >= 0 else 5 for w in seq]
    want = [False] * len(seq)
    for i in range(len(seq)):
        for j in range(i + 1, len(seq) + 1):
            sub = seq[i:j]
            n = sum(seq[x : x + len(sub)] == sub for x in range(len(seq)))
            if min(sub) >= 0 and n >= least and sum(chars[i:j]) * n >= mass:
                want[i:j] = [True] * (j - i)
    assert covered_words(seq, chars, least, mass) == want


SPAM = [
    "купить срочно дешёво | аренда комнат | купить | срочно | дешёво | купить | аренда комнат | срочно",
    "#tag1 #tag2 #tag3 #tag4 #tag5 #tag6 #tag7 #tag8",
    "https://a.example/x\nhttps://b.example/y\nwww.c.example/z\nhttp://d.test/q",
    "[buy now](a.example/x) [cheap](b.example/y) [online](c.example/z) [buy now](d.example/w)",
    "Реферат и скидки тут, лучшие скидки реферат. Скидки и реферат тут, лучшие реферат ответы. Ответы и скидки тут, лучшие ответы реферат.",
    "арт. aaa / reviews / cheap\nарт. bbb / cheap / online\nарт. ccc / reviews / cheap",
]
FINE = [
    "Вчера я видел как он забыл свой зонт в читалке, и мы долго смеялись над этим.",
    "we talked about the exam, and i think it was fine. see https://a.example/x for the notes that he made.",
    "Мен бүгін ұйықтап қалдым, сосын досым маған телефон соқты және бәрі жақсы болды.",
    "я ходил в клуб, клуб был закрыт, и мы пошли домой, а потом снова в клуб. #пятница",
    "",
    "скучно",
]


def test_spam_and_sentences(spark):
    rows = [(i, t) for i, t in enumerate(SPAM + FINE)] + [(98, None), (99, "word " * 40_000)]
    got = {r.doc_id for r in spam_pages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {*range(len(SPAM)), 99}
    assert profile("") == (0, 0, 0, 0)
    assert spam_pages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 20))
def test_fill_is_the_best_sum(counts, room):
    best = {0}
    for w, c in counts.items():
        best = {s + w * k for s in best for k in range(c + 1) if s + w * k <= room}
    got = fill(sorted(counts, reverse=True), counts, room)
    assert sum(w * n for w, n in got.items()) == max(best) and all(n <= counts[w] for w, n in got.items())


def test_patterns_place_everything():
    h = {3: 7, 5: 2, 8: 1}
    used = {}
    for p, times in patterns(h, 8):
        assert sum(w * n for w, n in p.items()) <= 8
        for w, n in p.items():
            used[w] = used.get(w, 0) + n * times
    assert used == h and patterns({}, 8) == []


@pytest.mark.parametrize("group", [3, 50_000])
def test_containers_hold_every_token_once(spark, group):
    rnd = random.Random(5)
    sizes = [rnd.randrange(0, 40) for _ in range(150)] + [7] * 50 + [100, 64, 32, 33]
    counted = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens int")
    rows = pack(counted.selectExpr("doc_id", "'' AS text"), 32, counted=counted, group=group).collect()
    load, parts = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append((r.start_token, r.n_tokens))
        if r.n_tokens:
            load[r.container] = load.get(r.container, 0) + r.n_tokens
    assert max(load.values()) <= 32
    for d, n in enumerate(sizes):
        p = sorted(parts[d])
        assert sum(k for _, k in p) == n and len(p) == max(1, -(-n // 32))
        assert all(a + k == b for (a, k), (b, _) in zip(p, p[1:]))
    assert len(load) <= -(-sum(sizes) // 32) + 1
    assert pack(counted.limit(0).selectExpr("doc_id", "'' AS text"), 32, counted=counted.limit(0)).count() == 0


def test_texts_are_counted(spark):
    d = spark.createDataFrame([(1, "привет мир"), (2, None), (3, ""), (4, "a <|endoftext|> b")], "doc_id long, text string")
    r = {x.doc_id: x for x in pack(d, 512).collect()}
    assert r[1].n_tokens > 0 and r[2].container == r[3].container == 0 and r[4].n_tokens > 3
