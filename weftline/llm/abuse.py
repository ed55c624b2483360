"""Problem 3: abusive, hateful or sexual content.

Method: logistic regression over hashed word n-grams and skip-grams, fitted with FTRL-proximal (per-coordinate rates,
L1 for sparse weights). The weights that are not zero are a few thousand pairs of key and weight; their number is
bounded by the features of the bounded training sample, so they can be broadcast whatever the corpus holds.

A text is scored by its clauses: each clause, each pair of neighbouring clauses, and the best run of words inside a clause
gets a probability, and the text has the highest. Before that the text takes its canonical form and disguises are undone: digits and signs for
letters, letters set apart, letters repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .abuse_seeds import examples
from .canonical import canonical_sql, duckdb_batches

#: Corpus sentences and human verdicts used for fitting, at most.
SAMPLE = 5_000
VERDICTS = 5_000
THRESHOLD = 0.5

# Signs that stand for letters in disguised words.
LEET_CYRILLIC = str.maketrans({"0": "о", "@": "а", "3": "е", "4": "ч", "1": "и", "$": "с", "6": "б", "7": "т", "u": "и", "n": "п", "k": "к", "m": "м", "t": "т", "b": "в", "h": "н", "r": "г", "z": "з", "!": "и"})
LEET_LATIN = str.maketrans({"0": "o", "@": "a", "3": "e", "4": "a", "1": "i", "$": "s", "5": "s", "7": "t", "!": "i"})
_CYR = re.compile(r"[Ѐ-ӿ]")
_LAT = re.compile(r"[a-z]")
_APART = re.compile(r"(?<![^\W_])[^\W_](?:([.\-_*·])[^\W_@](?:\1[^\W_@])+|(?: [^\W\d_@]){3,})(?![^\W_])")
_JOINTS = re.compile(r"(?<=[^\W_])([.\-_*·]) \1(?=[^\W_])")
_TWO_APART = re.compile(r"(?<![^\W_])([^\W_])[.\-_*·]([^\W_])(?![^\W_])")
_MAIL = re.compile(r"\S+@\S+\.\S+")
_SIGNS = re.compile(r"[@$]*[^\W_@$!]*(?:[^\W\d_][@$0-9!]+|[@$0-9][^\W\d_])[\w@$!]*")
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")


_MASKED = re.compile(r"[^\W\d_]*(?:[^\W\d_][*#]+[^\W\d_])[\w*#]*")
_LISTED: dict[int, list[str]] = {}


def _listed() -> dict[int, list[str]]:
    """Words of the harmful examples by their length."""
    if not _LISTED:
        for w in sorted({w for t, y in examples() if y for w in re.findall(r"[^\W\d_]{3,}", t)}):
            _LISTED.setdefault(len(w), []).append(w)
    return _LISTED


def joined(m: re.Match) -> str:
    """Letters that stood apart as one word; a word of one letter beside a listed word stays by itself."""
    w = re.sub(r"[.\-_*· ]", "", m[0])
    if " " in m[0] and w not in _listed().get(len(w), ()):
        short = _listed().get(len(w) - 1, ())
        return f"{w[:-1]} {w[-1]}" if w[:-1] in short else f"{w[0]} {w[1:]}" if w[1:] in short else w
    return w


def unmask(word: str) -> str:
    """The listed word that a word with stars for letters stands for, if there is one."""
    shape = re.compile("".join("." if c in "*#" else re.escape(c) for c in word))
    return next((w for w in _listed().get(len(word), ()) if shape.fullmatch(w)), word)


def undisguise(text: str) -> str:
    """Lower-case text with letters for signs, letters joined that stood apart, and no letter three times in a row."""
    text = _MAIL.sub(" ", text)
    text = _JOINTS.sub(" ", text)
    text, runs = _APART.subn(joined, text)
    if runs:
        text = _TWO_APART.sub(r"\1\2", text)

    def word(m: re.Match) -> str:
        w = m[0]
        tail = ""
        while w and w[-1] in "!":
            w, tail = w[:-1], "!"
        letters = re.sub(r"[^\w]|[\d_]", "", w)
        if len(letters) < 2 or re.fullmatch(r"\d+[^\W\d_]{0,3}", w):
            return m[0]
        return w.translate(LEET_CYRILLIC if _CYR.search(w) else LEET_LATIN) + tail

    text = _SIGNS.sub(word, text)
    if "*" in text or "#" in text:
        text = _MASKED.sub(lambda m: unmask(m[0]), text)
    return _REPEAT.sub(r"\1", text)


_TRIPLES = "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyzабвгдежзийклмнопрстуфхцчшщъыьэюяёәіңғқөұүһ")
#: Rows that may hold a disguise; the others are left as they are.
_ODD = rf"{_TRIPLES}|\p{{L}}[@$0-9!*#]+\p{{L}}|\p{{L}}[@$0-9]|[@$0-9]\p{{L}}|[\p{{L}}][.\-_*·][\p{{L}}][.\-_*·][\p{{L}}]|(^|[^\p{{L}}])\p{{L}} \p{{L}} \p{{L}} \p{{L}}($|[^\p{{L}}])"
#: Clauses end at sentence ends, lines, commas and dashes.
_CLAUSE = r"[.!?…;:,\n]+|\s[-–—]\s"
_FIRST = f"SELECT * EXCLUDE (canonical), lower(canonical) AS t, regexp_matches(lower(canonical), '{_ODD}') AS odd FROM (%s)"
_SECOND = f"SELECT k, list_transform(list_filter(regexp_split_to_array(t, '{_CLAUSE}'), lambda c: regexp_matches(c, '[\\p{{L}}]')), lambda c: list_transform(regexp_extract_all(c, '[\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: [hash(w), hash(w[1:5])])) AS cs FROM batch"


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


#: (first, gap, family): word pairs with up to two words between them.
_GRAMS = ((1, 1), (2, 2), (3, 3))


def clause_features(words: np.ndarray, stems: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word, hashed feature) for all n-grams and skip-grams inside their clause."""
    n = len(words)
    at = np.arange(n)
    pos, last, key = [at, at], [at, at], [_mix(words + np.uint64(11)), _mix(stems + np.uint64(13))]
    with np.errstate(over="ignore"):
        for gap, family in _GRAMS:
            ok = at + gap < ends
            a = at[ok]
            for base, salt in ((words, 100), (stems, 200)):
                pos.append(a)
                last.append(a + gap)
                key.append(_mix(_mix(base[a] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt + family)) ^ base[a + gap]))
    return np.concatenate(pos), np.concatenate(last), np.concatenate(key) >> np.uint64(64 - bits)


@dataclass
class Model:
    keys: np.ndarray  # sorted
    weights: np.ndarray
    bias: float
    bits: int


def _clauses(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words and stems of all clauses, the clause of each word, and the text of each clause."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
    batch = pa.table({"k": pa.array(np.arange(len(texts))), "t": texts})
    con.register("batch", batch)
    cs = con.sql(_SECOND).to_arrow_table().column(1).combine_chunks()
    if isinstance(cs, pa.ChunkedArray):
        cs = cs.chunk(0) if cs.num_chunks else pa.array([], cs.type)
    per_text = np.nan_to_num(cs.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    inner = cs.flatten()
    per_clause = inner.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = inner.flatten().flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, 2)
    return flat[:, 0], flat[:, 1], np.repeat(np.arange(len(per_clause)), per_clause), np.repeat(np.arange(len(texts)), per_text)


def clean(texts: pa.Array, odd: np.ndarray) -> pa.Array:
    """Disguises undone in the odd rows."""
    at = np.flatnonzero(odd)
    if not len(at):
        return texts
    out = texts.to_pylist()
    for i in at:
        out[i] = undisguise(out[i])
    return pa.array(out, pa.string())


def _encode(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(clause of each feature, feature, text of each clause)."""
    words, stems, clause, owner = _clauses(texts)
    ends = np.searchsorted(clause, clause, "right") if len(clause) else clause
    pos, _, key = clause_features(words, stems, ends, bits)
    return clause[pos], key, owner


#: Words that a part of a clause must have to be scored by itself, and how much surer it must be (log odds).
PART, MARGIN = 3, 2.5


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    """The highest probability of a clause, of two neighbours, or of a run of words of a clause, for each text.

    Sentences may stand side by side without a stop; so every run of ``PART`` words and more counts too. No feature
    spans more than ``PART`` + 1 words: all that begin before a run end before its last word or at it, so a run's sum is
    what ends up to its last word without what begins before its first, and the best is found in one pass.
    Texts without words have the probability of the bias.
    """
    words, stems, clause, owner = _clauses(texts)
    best = np.full(len(texts), 0.0)
    if len(owner) and len(words) and len(model.keys):
        stop = np.searchsorted(clause, np.arange(len(owner)), "right")
        start = np.searchsorted(clause, np.arange(len(owner)), "left")
        first, last, key = clause_features(words, stems, stop[clause], model.bits)
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        w = np.where(model.keys[at] == key, model.weights[at], 0.0)
        by_first = np.concatenate([[0.0], np.cumsum(np.bincount(first, w, len(words)))])
        by_last = np.concatenate([[0.0], np.cumsum(np.bincount(last, w, len(words)))])
        z = by_first[stop] - by_first[start]
        i = np.arange(len(words))
        before = by_first[i] - by_first[start[clause]]  # of the clause, begins before word i
        upto = by_last[i + 1] - by_last[start[clause]]  # of the clause, ends at word i or before
        # The least ``before`` of a clause so far: a step down per clause starts it anew.
        step = clause * (np.ptp(before) + 1.0)
        least = np.minimum.accumulate(before - step) + step
        part = z.copy()
        j = np.flatnonzero(i + 1 - start[clause] >= PART)
        np.maximum.at(part, clause[j], upto[j] - least[j - PART + 1] - MARGIN)
        np.maximum.at(best, owner, part)
        pair = owner[1:] == owner[:-1]
        np.maximum.at(best, owner[1:][pair], (z[1:] + z[:-1])[pair])
    return 1 / (1 + np.exp(-(best + model.bias)))


def fit(samples: list[tuple[np.ndarray, int, float]], bits: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.3, l2: float = 0.5, epochs: int = 6, bias: float = -3.0, batch: int = 128) -> Model:
    """FTRL-proximal over (features, label, weight) in small batches; the bias is fixed so that unknown words speak for harmless."""
    samples = [x for x in samples if len(x[0])]
    if not samples:
        return Model(np.array([], np.uint64), np.array([]), bias, bits)
    sizes = np.array([len(x) for x, _, _ in samples])
    keys, index = np.unique(np.concatenate([x for x, _, _ in samples]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    y = np.array([v for _, v, _ in samples], float)
    weight = np.array([w for _, _, w in samples], float)
    z, n = np.zeros(len(keys)), np.zeros(len(keys))

    def weights(f: np.ndarray) -> np.ndarray:
        zf = z[f]
        return np.where(np.abs(zf) <= l1, 0.0, -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            feats = np.concatenate([index[starts[i] : starts[i + 1]] for i in rows])
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            total = np.bincount(owner, weights(feats), len(rows)) + bias
            g = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - y[rows]) * weight[rows]
            f, inv = np.unique(feats, return_inverse=True)
            gf = np.bincount(inv, g[owner], len(f))
            g2 = np.bincount(inv, g[owner] ** 2, len(f))
            w = weights(f)
            z[f] += gf - (np.sqrt(n[f] + g2) - np.sqrt(n[f])) / alpha * w
            n[f] += g2
    w = weights(np.arange(len(keys)))
    kept = w != 0
    return Model(keys[kept], w[kept], bias, bits)


def _by_clause(texts: list[str], bits: int) -> list[list[np.ndarray]]:
    """Features of the clauses of each text."""
    clause, key, owner = _encode(pa.array(texts, pa.string()), bits)
    order = np.argsort(clause, kind="stable")
    cuts = np.searchsorted(clause[order], np.arange(len(owner) + 1))
    out: list[list[np.ndarray]] = [[] for _ in texts]
    key = key[order]
    for c, t in enumerate(owner):
        out[t].append(np.unique(key[cuts[c] : cuts[c + 1]]))
    return out


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in duckdb_batches(_FIRST % canonical_sql("batch", "text", "y"), batches):
        yield pa.RecordBatch.from_arrays([b.column(0), clean(b.column(1), b.column(2).to_numpy(zero_copy_only=False).astype(bool))], names=["y", "t"])


def train(spark: SparkSession, posts: DataFrame | None, labels: DataFrame | None, sample: int = SAMPLE, bits: int = 22) -> Model:
    """Fit on the seed sentences, at most ``sample`` corpus texts, and at most ``VERDICTS`` reviewed messages.

    A reviewer marks messages, not clauses. The first fit spreads the mark of a message over its clauses, with the corpus
    clauses and those of messages found ok as harmless; what fills ordinary messages too gets no weight so. Each further
    fit takes the most suspicious clause of a marked message for harmful, if it is not plainly harmless (some verdicts are
    wrong), and corpus clauses for harmless, or for harmful if the fit before is sure of them.
    """
    from .lookalike import source_key

    sampled: list[str] = []
    judged: list[tuple[int, str]] = []
    if posts is not None:
        part = posts.where(F.col("text").isNotNull()).orderBy(F.xxhash64("source", "telegram_message_id", "text"), "text").limit(sample).select(F.lit(0).alias("y"), "text")
        sampled = [r.t for r in part.mapInArrow(_normal, "y int, t string").collect()]
    if posts is not None and labels is not None:
        v = labels.where(F.col("verdict").isNotNull()).select(F.lower("source").alias("s"), F.col("telegram_message_id").alias("m"), (F.col("verdict") != "ok").cast("int").alias("y")).distinct()
        v = v.orderBy(F.xxhash64("s", "m")).limit(VERDICTS)
        joined = posts.where(F.col("text").isNotNull()).select(source_key(F.col("source")).alias("s"), F.col("telegram_message_id").alias("m"), "text").join(F.broadcast(v), ["s", "m"]).groupBy("s", "m", "y").agg(F.min("text").alias("text")).select("y", "text")
        judged = [(r.y, r.t) for r in joined.mapInArrow(_normal, "y int, t string").collect()]
    return fit_all(sampled, judged, bits)


#: Fits; how much a marked message counts in the first; from what log odds on its first clause, any further clause, and a
#: clause that nobody judged are taken for harmful.
ROUNDS, SPREAD, LIKELY, FURTHER, SURE = 4, 1.0, -1.5, 1.0, 1.0


def fit_all(sampled: list[str], judged: list[tuple[int, str]], bits: int = 22) -> Model:
    """The fits of ``train`` on normalised texts."""
    seeds = examples()
    rows = [(np.unique(np.concatenate(fs)), y, 1.0) for fs, (_, y) in zip(_by_clause([t for t, _ in seeds], bits), seeds) if fs]
    corpus = [f for fs in _by_clause(sampled, bits) for f in fs] if sampled else []
    if corpus:  # the same sentences beside ordinary clauses without a stop between them
        rng = np.random.default_rng(11)
        rows += [(np.unique(np.concatenate([f, corpus[k]])), y, w) for (f, y, w), k in zip(rows, rng.integers(0, len(corpus), len(rows)))]
    clauses = _by_clause([t for _, t in judged], bits) if judged else []
    ok = [fs for (y, _), fs in zip(judged, clauses) if not y]
    marked = [fs for (y, _), fs in zip(judged, clauses) if y and fs]
    extra = [(f, 0, 0.3) for f in corpus] + [(f, 0, 0.5) for fs in ok for f in fs] + [(f, 1, SPREAD / len(fs)) for fs in marked for f in fs]
    model = fit(rows + extra, bits, epochs=2)

    def suspicion(f: np.ndarray) -> float:
        if not len(model.keys):
            return model.bias
        at = np.minimum(np.searchsorted(model.keys, f), len(model.keys) - 1)
        return float(np.where(model.keys[at] == f, model.weights[at], 0.0).sum()) + model.bias

    for last in range(ROUNDS - 2, -1, -1):
        extra = []
        for f in corpus:
            s = suspicion(f)
            if s < 0 or s > SURE:
                extra.append((f, int(s > 0), 1.0 if s < 0 else 0.5))
        for fs in ok:
            extra += [(f, 0, 0.5) for f in fs if suspicion(f) < 1.0]
        for fs in marked:
            scores = [suspicion(f) for f in fs]
            if max(scores) > LIKELY:
                extra += [(f, 1, 1.0) for f, s in zip(fs, scores) if s == max(scores) or s > FURTHER]
        model = fit(rows + extra, bits, epochs=2 if last else 4)
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in duckdb_batches(_FIRST % canonical_sql("batch", "text", "src, id, grp"), batches):
            texts = clean(b.column(3), b.column(4).to_numpy(zero_copy_only=False).astype(bool))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(score_texts(model.value, texts))], names=["src", "id", "grp", "score"])

    return run


def abuse_scores(texts: DataFrame, model: Model) -> DataFrame:
    """``src string, id long, grp string, score double`` for every row of ``src, id, grp, text``.

    Null and blank texts have the score of the bias, which is under every sensible threshold.
    """
    spark = texts.sparkSession
    t = texts.select("src", "id", "grp", F.coalesce("text", F.lit("")).alias("text"))
    return t.mapInArrow(_score(spark.sparkContext.broadcast(model)), "src string, id long, grp string, score double")


def rates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows, rows at the threshold or above, and their rate for each group; partial sums before the shuffle."""
    hit = F.col("score") >= threshold
    return scores.groupBy("grp").agg(F.count("*").alias("n_rows"), F.sum(hit.cast("long")).alias("n_flagged"), F.round(F.avg(hit.cast("double")), 6).alias("rate"))
