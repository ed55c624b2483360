import numpy as np
import pyarrow as pa

from weftline.llm import abuse


def test_the_best_run_inside_a_clause_counts():
    """The score is that of the best of all runs, wherever it stands: with random weights, against brute force."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(1, 16, 60)]
    keys = np.unique(abuse._encode(pa.array(texts), 22)[1])
    model = abuse.Model(keys, rng.normal(-0.5, 1.5, len(keys)), -3.0, 22)
    want = []
    for t in texts:
        w = t.split()
        runs = [t] + [" ".join(w[i:j]) for i in range(len(w)) for j in range(i + abuse.PART, len(w) + 1)]
        clause, key, owner = abuse._encode(pa.array(runs), 22)
        z = np.bincount(clause, model.weights[np.searchsorted(keys, key)], len(owner))
        z[1:] -= abuse.MARGIN
        want.append(1 / (1 + np.exp(-(max(z.max(), 0.0) + model.bias))))
    assert np.allclose(abuse.score_texts(model, pa.array(texts)), want)


def test_harmful_words_between_harmless_ones_without_a_stop():
    harmful, before, behind = "ты просто мразь", "мама думает что это экзамен и", "потом завтра будет дождь и ветер"
    rows = [(harmful, 2.0), (before, -1.0), (behind, -1.0)]
    parts = [(np.unique(abuse._encode(pa.array([t]), 22)[1]), w) for t, w in rows]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_index=True)
    model = abuse.Model(keys, np.concatenate([np.full(len(k), w) for k, w in parts])[at], -3.0, 22)
    s = abuse.score_texts(model, pa.array([f"{before} {harmful} {behind}", f"{before} {behind}"]))
    assert s[0] >= 0.5 > s[1]
