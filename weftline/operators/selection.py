"""Selecting a small set under soft aims and hard caps: greedy growth and swaps, with the table distributed.

The state is the chosen rows (a few dozen). Each step scores all rows against it in one pass, in Arrow batches, and keeps
the best row of each task; no step gathers the table. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..session import materialize

#: Attributes that coverage counts, and the columns they are in.
ATTRIBUTES = {"type": "post_type", "topic": "topic", "lang": "language", "lenband": "lenband", "opener": "opener1", "ending": "ending", "shape": "shape"}
COLUMNS = ["id", "score", "formulaic", "ai_feel", "post_type", "topic", "language", "lenband", "is_question", "advice", "patterns", "opener1", "opener2", "ending", "casing", "shape", "tells", "emoji", "seed_id", "theme_key", "v", "stems"]


@dataclass
class Aims:
    """Parameters of the objective; ``lexical`` compares by word stems instead of vectors, with limits of its own."""

    prior: list[float]
    targets: dict[str, dict]
    question_limit: int
    soft: float = L.SIMILARITY["embedding"]["soft"]
    hard: float = L.SIMILARITY["embedding"]["hard"]
    lexical: bool = False

    def __post_init__(self) -> None:
        if self.lexical:
            self.soft, self.hard = L.SIMILARITY["lexical"]["soft"], L.SIMILARITY["lexical"]["hard"]


def target_bonus(count: int, target: int) -> float:
    """One at nothing, falling by 0.4 towards the target; past the target 0.3 less for each."""
    return 1.0 - 0.4 * count / max(target, 1) if count < target else -0.3 * (count - target)


def likeness(a: dict, b: dict, aims: Aims) -> float:
    """The cosine of two rows; the Jaccard similarity of their stems, if the aims say so or one has no vector."""
    if not aims.lexical and a["v"] is not None and b["v"] is not None:
        return float(np.dot(a["v"], b["v"]))
    x, y = set(a["stems"] or ()), set(b["stems"] or ())
    return len(x & y) / len(x | y) if x and y else 0.0


def worth(r: dict, aims: Aims) -> float:
    """What a row is worth by itself."""
    w = L.WEIGHTS
    q = min(1.0, max(0.0, ((r["score"] or 0.0) - 4) / 6))
    return w["quality"] * q + w["length"] * aims.prior[r["lenband"]] - w["tell"] * min(r["tells"], 3) - (w["formulaic"] if r["formulaic"] else 0.0) - (w["ai_feel"] if r["ai_feel"] else 0.0)


def overlap(a: dict, b: dict, aims: Aims) -> float:
    """The penalty for two rows with similar meaning."""
    s = likeness(a, b, aims)
    return L.WEIGHTS["sim"] * (s - aims.soft) / max(aims.hard - aims.soft, 1e-6) if s > aims.soft else 0.0


def spread(rows: list[dict], aims: Aims) -> float:
    """What the rows' variety is worth: coverage, habits, and the excess of questions, advice and stock phrases."""
    w, out = L.WEIGHTS, 0.0
    for name, weight in L.COVERAGE.items():
        out += weight * sum(math.sqrt(n) for n in Counter(r[ATTRIBUTES[name]] for r in rows).values())
    for name, weight in L.TARGET_WEIGHTS.items():
        counts = Counter(r[name] for r in rows)
        out += weight * sum(target_bonus(counts.get(v, 0), t) for v, t in aims.targets[name].items())
    out -= w["question"] * max(0, sum(r["is_question"] for r in rows) - aims.question_limit)
    out -= w["advice"] * max(0, sum(r["advice"] for r in rows) - 2)
    repeats = Counter(p for r in rows for p in r["patterns"].split(",") if p)
    return out - w["pattern"] * sum(n - 1 for n in repeats.values())


def objective(rows: list[dict], aims: Aims) -> float:
    if not rows:
        return 0.0
    pairs = sum(overlap(a, b, aims) for i, a in enumerate(rows) for b in rows[i + 1 :])
    return sum(worth(r, aims) for r in rows) + spread(rows, aims) - pairs


def gain(rows: list[dict], new: dict, aims: Aims, before: float) -> float:
    """What ``new`` adds to the objective; ``before`` is the spread of ``rows`` (0 for none)."""
    return worth(new, aims) + spread([*rows, new], aims) - before - sum(overlap(r, new, aims) for r in rows)


def blocked(rows: list[dict], new: dict, aims: Aims) -> str | None:
    """Why ``new`` cannot join; the first of the caps in their order."""
    same = lambda c: sum(r[c] == new[c] for r in rows)
    if any(likeness(r, new, aims) >= aims.hard for r in rows):
        return "same_meaning"
    if new["seed_id"] is not None and same("seed_id"):
        return "same_seed"
    if new["theme_key"] and same("theme_key"):
        return "same_theme"
    caps = L.HARD_CAPS
    if same("topic") >= caps["topic"]:
        return "topic_cap"
    if same("post_type") >= caps["type"]:
        return "type_cap"
    if new["advice"] and sum(r["advice"] for r in rows) >= caps["advice"]:
        return "advice_cap"
    if same("opener1") >= caps["opener1"] or " " in new["opener2"] and same("opener2") >= caps["opener2"]:
        return "opener_cap"
    return None


def _best(sets: list[list[dict]], taken: set[int], aims: Aims):
    """Arrow pass: the best row of a task for each of several sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = [spread(s, aims) if s else 0.0 for s in sets]
        best: dict[int, tuple[float, int]] = {}
        for b in batches:
            for r in b.to_pylist():
                if r["id"] in taken:
                    continue
                for k, s in enumerate(sets):
                    if not blocked(s, r, aims):
                        key = (-gain(s, r, aims, before[k]), r["id"])
                        if k not in best or key < best[k]:
                            best[k] = key
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([-g for g, _ in best.values()]), pa.array([i for _, i in best.values()])], names=["k", "gain", "id"])

    return run


def _tops(rows: DataFrame, sets: list[list[dict]], taken: set[int], aims: Aims) -> dict[int, tuple[float, int]]:
    """For each set, gain and id of the best row that may join; a row per set and task reaches the driver at most."""
    out: dict[int, tuple[float, int]] = {}
    found = rows.mapInArrow(_best(sets, taken, aims), "k int, gain double, id long").groupBy("k").agg(F.min(F.struct(-F.col("gain"), F.col("id"))).alias("x")).collect()
    for r in found:
        out[r.k] = (-r.x[0], r.x[1])
    return out


def select_diverse(rows: DataFrame, aims: Aims, k: int = 20, passes: int = 5) -> DataFrame:
    """``position, id, objective`` of up to ``k`` rows with the columns ``COLUMNS``: greedy, then up to ``passes`` of swaps.

    A pass replaces the row at each position by the best other one, if that raises the objective. One job finds the best
    for all positions that are left; up to the first that changes, its answers hold, as the set is the same.
    """
    rows = materialize(rows.select(*COLUMNS), "select")
    chosen: list[dict] = []

    def fetch(i: int) -> dict:
        return rows.where(F.col("id") == i).first().asDict()

    def ids() -> set[int]:
        return {r["id"] for r in chosen}

    while len(chosen) < k:
        got = _tops(rows, [chosen], ids(), aims).get(0)
        if got is None:
            break
        chosen.append(fetch(got[1]))
    for _ in range(passes if len(chosen) == k else 0):
        changed, at = False, 0
        while at < k:
            sets = [chosen[:p] + chosen[p + 1 :] for p in range(at, k)]
            got, now, nxt = _tops(rows, sets, ids(), aims), objective(chosen, aims), k
            for n, rest in enumerate(sets):
                if n in got and objective(rest, aims) + got[n][0] > now + 1e-9:
                    chosen[at + n] = fetch(got[n][1])
                    changed, nxt = True, at + n + 1
                    break
            at = nxt
        if not changed:
            break
    value = objective(chosen, aims)
    return rows.sparkSession.createDataFrame([(i, int(r["id"]), round(value, 6)) for i, r in enumerate(chosen)], "position int, id long, objective double")


def _against(chosen: list[dict], aims: Aims):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ids = spread(chosen, aims) if chosen else 0.0, {r["id"] for r in chosen}
        for b in batches:
            rows = [r for r in b.to_pylist() if r["id"] not in ids]
            gains = [round(gain(chosen, r, aims, before), 6) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["id"] for r in rows], pa.int64()), pa.array([blocked(chosen, r, aims) for r in rows], pa.string()), pa.array(gains, pa.float64())], names=["id", "blocked", "gain"])

    return run


def against_set(rows: DataFrame, chosen: DataFrame, aims: Aims) -> DataFrame:
    """``id, blocked, gain`` of every row outside a small chosen set."""
    members = [r.asDict() for r in chosen.select(*COLUMNS).collect()]
    return rows.select(*COLUMNS).mapInArrow(_against(members, aims), "id long, blocked string, gain double")
