"""Problem 7: missing or wrong language labels, and mixed texts.

Method: multilingual mixture inference. Each language has a model of character n-grams (1 to 5, with word ends), fitted
on all texts whose label and assigned language agree on one language; Russian and Kazakh also have models of their
romanised and of their simplified spelling, since the language is that of the words whatever letters they are typed in.
A word's likelihood under a language is that of the best of its spellings. For a text, dynamic programming cuts the
words into segments; expectation-maximisation estimates the proportions of the languages over the segments; and the
language set with the highest penalised likelihood is chosen among one and two languages.

Counts are gathered in one pass as fixed-size arrays (one per model and task) and summed, so training covers all rows and
what reaches the driver has a fixed size: models * buckets * 4 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canonical import canonical_sql, duckdb_batches

CODES = ("ru", "kz", "en", "ru_kz", "ru_en")
LANGS = ("ru", "kz", "en")
#: Spelling models: language and how its texts are respelt for fitting.
MODELS = (("ru", ""), ("kz", ""), ("en", ""), ("ru", "latin"), ("kz", "latin"), ("kz", "plain"))
BUCKETS = 1 << 17
# Common romanisations.
RU_LATIN = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya"}
KZ_LATIN = {**RU_LATIN, "ә": "a", "і": "i", "ң": "n", "ғ": "g", "қ": "k", "ө": "o", "ұ": "u", "ү": "u", "һ": "h"}
# How Kazakh is typed without its own letters.
KZ_PLAIN = {"ә": "а", "і": "и", "ң": "н", "ғ": "г", "қ": "к", "ө": "о", "ұ": "у", "ү": "у", "һ": "х"}
_RESPELL = {("ru", "latin"): str.maketrans(RU_LATIN), ("kz", "latin"): str.maketrans(KZ_LATIN), ("kz", "plain"): str.maketrans(KZ_PLAIN)}

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_STOP = re.compile(r"[.!?…\n;:]|\s[-–—]\s")


@dataclass
class Settings:
    """Nats. ``switch``: to begin another segment; ``inside``: the same where no stop stands between the words;
    ``pair``: for a second language; ``clause``: least words and least gain of a segment in the lesser language;
    ``label``, ``assigned``: prior of the row's own codes."""

    switch: float = 5.0
    inside: float = 9.0
    pair: float = 12.0
    words: int = 3
    gain: float = 12.0
    label: float = 3.0
    assigned: float = 1.5
    cap: float = 9.0
    fields: tuple[str, ...] = field(default=("language", "assigned_language"))


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word of each n-gram, bucket): character n-grams of 1 to 5 of each word between marks of its ends."""
    text = "".join(f"^{w}$" for w in words)
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    end = np.repeat(np.cumsum(size), size)
    at = np.arange(len(cp))
    h = np.zeros(len(cp), np.uint64)
    who, what = [], []
    with np.errstate(over="ignore"):
        for n in range(1, 6):
            nxt = at + n - 1
            ok = nxt < end
            h[ok] = (h[ok] ^ cp[nxt[ok]]) * np.uint64(0x9E3779B97F4A7C15)
            h[ok] ^= h[ok] >> np.uint64(29)
            if n >= 2:
                who.append(owner[ok])
                what.append(((h[ok] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(47)).astype(np.int64))
    return np.concatenate(who), np.concatenate(what)


@dataclass
class Model:
    table: np.ndarray  # models x BUCKETS, log probability relative to the mean of all models

    def score(self, words: list[str]) -> np.ndarray:
        """words x languages: log likelihood by character n-grams, best spelling of each language, averaged overlaps."""
        if not words:
            return np.zeros((0, len(LANGS)))
        unique = sorted(set(words))
        who, what = word_grams(unique)
        per = np.stack([np.bincount(who, self.table[m][what], len(unique)) for m in range(len(MODELS))], 1)
        # Four overlapping n-gram lengths tell the same letters: a share of their sum is one likelihood.
        per *= 0.4
        langs = np.stack([np.max(per[:, [i for i, (g, _) in enumerate(MODELS) if g == lang]], 1) for lang in LANGS], 1)
        place = {w: i for i, w in enumerate(unique)}
        return langs[[place[w] for w in words]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(MODELS), BUCKETS), np.int64)
    any_row = False
    for b in duckdb_batches(f"SELECT lang, lower(canonical) AS t FROM ({canonical_sql('batch', 'text', 'lang')})", batches):
        langs = b.column(0).to_pylist()
        texts = b.column(1).to_pylist()
        for m, (lang, how) in enumerate(MODELS):
            words = [w for g, t in zip(langs, texts) if g == lang for w in _WORD.findall(t)]
            if not words:
                continue
            any_row = True
            if how:
                words = [w.translate(_RESPELL[lang, how]) for w in words]
                words = [w for w in words if w]
            if words:
                unique, n = np.unique(np.array(words, object), return_counts=True)
                who, what = word_grams(list(unique))
                total[m] += np.bincount(what, n[who], BUCKETS).astype(np.int64)
    if any_row:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(MODELS), dtype=np.int32)), pa.array([total[m].astype("<i8").tobytes() for m in range(len(MODELS))], pa.binary())], names=["m", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for m, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x = np.frombuffer(c, "<i8")
            total[m] = total[m] + x if m in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["m", "counts"])


def train(texts: DataFrame, tasks: int = 32) -> Model:
    """Fit on all rows of ``text, lang`` whose ``lang`` is one of the three languages."""
    known = texts.where(F.col("lang").isin(*LANGS) & F.col("text").isNotNull()).select("lang", "text")
    schema = "m int, counts binary"
    tasks = max(tasks, 2 * texts.sparkSession.sparkContext.defaultParallelism)
    parts = known.coalesce(tasks).mapInArrow(_count, schema)  # one array per model and task
    rows = parts.repartition(len(MODELS), "m").mapInArrow(_add, schema).collect()
    counts = np.zeros((len(MODELS), BUCKETS))
    for r in rows:
        counts[r.m] += np.frombuffer(r.counts, "<i8")
    return from_counts(counts)


def from_counts(counts: np.ndarray) -> Model:
    """Smoothed log probabilities; a bucket's value is relative to all models' mean, and bounded."""
    p = (counts + 0.02) / (counts.sum(1, keepdims=True) + 0.02 * BUCKETS)
    log = np.log(p)
    # A model without any text knows nothing: it must not win by being flat.
    empty = counts.sum(1) == 0
    log[empty] = log[~empty].min(0) if (~empty).any() else 0.0
    return Model((log - log.mean(0)).astype(np.float32))


def _segments(ll: np.ndarray, stops: np.ndarray, s: Settings) -> np.ndarray:
    """The language of each word: the best path where beginning another language costs more within a sentence."""
    rows = ll.tolist()
    if not rows:
        return np.zeros(0, int)
    best, back = rows[0], []
    states = range(len(best))
    for row, stop in zip(rows[1:], stops[1:]):
        top = max(states, key=best.__getitem__)
        jump = best[top] - (s.switch if stop else s.inside)
        back.append([top if best[j] < jump else j for j in states])
        best = [max(best[j], jump) + row[j] for j in states]
    at = max(states, key=best.__getitem__)
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1])


def _mixture(seg: np.ndarray, langs: tuple[int, ...], rounds: int = 12) -> tuple[float, np.ndarray]:
    """EM for the proportions of ``langs`` over segments (rows: likelihoods); the likelihood and the proportions."""
    x = seg[:, langs]
    if len(langs) == 1:
        return float(x.sum()), np.ones(1)
    pi = np.full(len(langs), 1 / len(langs))
    for _ in range(rounds):
        z = x + np.log(pi)
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        pi = np.maximum(z.mean(0), 1e-6)
        pi /= pi.sum()
    z = x + np.log(pi)
    top = z.max(1)
    return float((top + np.log(np.exp(z - top[:, None]).sum(1))).sum()), pi


_SETS = {"ru": (0,), "kz": (1,), "en": (2,), "ru_kz": (0, 1), "ru_en": (0, 2)}


def infer(text: str, ll: np.ndarray, spans: list[tuple[int, int]], s: Settings, hints: tuple[str | None, str | None] = (None, None)) -> tuple[str | None, float, list[tuple[int, int, str, float]]]:
    """Code, confidence and segments (start, end, language, confidence) of one text; no words: (None, 0, [])."""
    if not spans:
        return None, 0.0, []
    ll = np.clip(ll - ll.max(1, keepdims=True), -s.cap, 0)
    stops = np.array([False] + [bool(_STOP.search(text, a[1], b[0])) for a, b in zip(spans, spans[1:])])
    path = _segments(ll, stops, s)
    cuts = [0, *(int(i) for i in np.flatnonzero(path[1:] != path[:-1]) + 1), len(path)]
    seg = np.stack([ll[a:b].sum(0) for a, b in zip(cuts, cuts[1:])])
    sizes = np.diff(cuts)
    scores = {}
    for code, langs in _SETS.items():
        if len(langs) == 2:  # a clause in each language: words enough, and clearly not the other's
            gain = seg[:, langs[0]] - seg[:, langs[1]]
            long = sizes >= s.words
            if not (long & (gain >= s.gain)).any() or not (long & (-gain >= s.gain)).any():
                scores[code] = -np.inf
                continue
        value, _ = _mixture(seg, langs)
        value -= s.pair if len(langs) == 2 else 0.0
        for hint, weight in zip(hints, (s.label, s.assigned)):
            value += weight if hint == code else 0.0
        scores[code] = value
    code = max(scores, key=scores.get)
    v = np.array([x for x in scores.values() if np.isfinite(x)])
    conf = float(1 / np.exp(v - v.max()).sum())
    langs = _SETS[code]
    out = []
    for a, b, likelihood in zip(cuts, cuts[1:], seg):
        x = likelihood[list(langs)]
        j = int(np.argmax(x))
        y = likelihood - likelihood.max()
        part = (spans[a][0], spans[b - 1][1], LANGS[langs[j]], float(np.exp(y[langs[j]]) / np.exp(y).sum()))
        if out and out[-1][2] == part[2]:
            part = (out[-1][0], part[1], part[2], min(out[-1][3], part[3]))
            out.pop()
        out.append(part)
    return code, conf, out


_SCHEMA = "id long, code string, confidence double, segments array<struct<start:int,stop:int,lang:string,confidence:double>>"
_SEGMENT = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())]))


def _tag(model, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in duckdb_batches(f"SELECT id, label, assigned, coalesce(canonical, '') AS t FROM ({canonical_sql('batch', 'text', 'id, label, assigned')})", batches):
            texts = b.column(3).to_pylist()
            found = [[(m.start(), m.end()) for m in _WORD.finditer(t)] for t in texts]
            ll = model.value.score([t[a:e].lower() for t, f in zip(texts, found) for a, e in f])
            at, rows = 0, []
            for t, f, h in zip(texts, found, zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                rows.append(infer(t, ll[at : at + len(f)], f, settings, h))
                at += len(f)
            segs = [[{"start": a, "stop": e, "lang": g, "confidence": round(c, 4)} for a, e, g, c in r[2]] for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([round(r[1], 4) for r in rows]), pa.array(segs, _SEGMENT)], names=["id", "code", "confidence", "segments"])

    return run


def languages(texts: DataFrame, model: Model, settings: Settings | None = None) -> DataFrame:
    """``id, code, confidence, segments`` for every row of ``id long, text, label, assigned``.

    ``segments`` places count characters of the canonical text. Texts without words (null, empty, signs only) have a null
    code, confidence 0 and no segments. ``label`` and ``assigned`` may be null or anything; they weigh as priors only.
    """
    spark = texts.sparkSession
    return texts.select("id", "label", "assigned", "text").mapInArrow(_tag(spark.sparkContext.broadcast(model), settings or Settings()), _SCHEMA)


def candidate_languages(candidates: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Languages of a candidates table, fitted on the table's own agreeing labels."""
    agree = candidates.select("text", F.when(F.col("language") == F.col("assigned_language"), F.col("language")).alias("lang"))
    model = train(agree)
    t = candidates.select(F.col("id").cast("long").alias("id"), F.col("language").alias("label"), F.col("assigned_language").alias("assigned"), "text")
    return languages(t, model)


def wrong_labels(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """``id int, lang`` of rows whose label is missing, not a code, or not the language found."""
    joined = candidates.select(F.col("id").cast("long").alias("id"), "language").join(found.select("id", "code"), "id")
    bad = F.col("language").isNull() | ~F.col("language").isin(*CODES) | (F.col("language") != F.col("code"))
    return joined.where(F.col("code").isNotNull() & bad).select(F.col("id").cast("int").alias("id"), F.col("code").alias("lang"))
