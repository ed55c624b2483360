import numpy as np
import pytest

from weftline.llm.leakage import Items, Shard, _matches, _pairs


@pytest.mark.parametrize("seed", range(6))
def test_all_suffixes_are_in_order(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, 3, rng.integers(0, 40)) for _ in range(8)] + [np.tile([1, 2], 30)] * 3
    words, sizes = np.concatenate(docs).astype(np.uint64), np.array([len(d) for d in docs])
    s = Shard(words, sizes)
    texts = [tuple(words[i : s.ends[i]].tolist()) for i in s.suffixes]
    assert sorted(s.suffixes.tolist()) == list(range(len(words))) and texts == sorted(texts)


@pytest.mark.parametrize("seed", range(4))
def test_matches_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, 4, 30) for _ in range(6)] + [np.tile([1, 2, 3], 12)] * 2
    items = [docs[0][3:20], docs[6][:20], rng.integers(0, 4, 25), rng.integers(4, 9, 9)]
    words, sizes = np.concatenate(docs).astype(np.uint64), np.array([len(d) for d in docs])
    q, n = np.concatenate(items).astype(np.uint64), np.array([len(i) for i in items])
    own, shard, depth = Items(np.repeat(np.arange(len(items)), n), q, np.repeat(np.cumsum(n), n)), Shard(words, sizes), 4
    begin, q0 = np.cumsum(sizes) - sizes, np.cumsum(n) - n
    want = set()
    for i, x in enumerate(items):
        for d, y in enumerate(docs):
            for a in range(len(x)):
                for b in range(len(y)):
                    k = 0
                    while a + k < len(x) and b + k < len(y) and x[a + k] == y[b + k]:
                        k += 1
                    if k >= depth and not (a and b and x[a - 1] == y[b - 1]):
                        want.add((int(q0[i] + a), int(begin[d] + b), k))
    got = list(zip(*(x.tolist() for x in _matches(own, shard, depth, step=3))))
    assert len(got) == len(set(got)) and set(got) == want
    of_q, of_d = np.repeat(np.arange(len(items)), n), np.repeat(np.arange(len(docs)), sizes)
    d, i = _pairs(own, shard, np.arange(len(docs)) * 10, depth)
    assert set(zip(d.tolist(), i.tolist())) == {(int(of_d[p]) * 10, int(of_q[a])) for a, p, _ in want}


def test_a_hot_passage_is_one_range():
    """A run that stands 2,000 times in the item and in the document gives one pair, without 4,000,000 hits."""
    run = np.arange(12)
    words = np.tile(run, 2_000).astype(np.uint64)
    shard = Shard(words, np.array([len(words)]))
    own = Items(np.zeros(len(words), np.int64), words, np.full(len(words), len(words)))
    d, i = _pairs(own, shard, np.array([7]), 12)
    assert d.tolist() == [7] and i.tolist() == [0]
