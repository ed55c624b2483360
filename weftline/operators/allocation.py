"""Planning: slots, chunks, seeds for types, languages and rotation by deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slots(counts: dict[str, int], scale: float) -> list[tuple[str, int]]:
    """Scaled counts, two at least."""
    return [(k, max(2, round(n * scale))) for k, n in counts.items()]


def chunks(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """``chunk``: consecutive runs of ``size`` rows of each group."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return rows.withColumn("chunk", F.floor(n / size).cast("int"))


def draw(weights: dict[str, float], key: Column) -> Column:
    """A value drawn by cumulative weights at a hash of ``key`` in [0, 1)."""
    u = F.pmod(F.xxhash64(key), F.lit(1_000_003)) / 1_000_003
    total, acc, out = sum(weights.values()), 0.0, None
    for value, w in weights.items():
        acc += w / total
        out = F.when(u < acc, value) if out is None else out.when(u < acc, value)
    return out.otherwise(list(weights)[-1])


def type_seed_pairs(types: DataFrame, seeds: DataFrame) -> DataFrame:
    """``name, id, tier``: seeds a type may use; tier 1 within its affinity, 2 where it has no such seed."""
    kinds = types.select("name", "affinity", F.explode("kinds").alias("kind"))
    pairs = seeds.select("id", "domain", "kind").join(F.broadcast(kinds), "kind")  # a row per type and kind
    near = (F.size("affinity") == 0) | F.array_contains("affinity", F.col("domain"))
    tiered = pairs.select("name", "id", F.when(F.coalesce(near, F.lit(False)), 1).otherwise(2).alias("tier"))
    best = tiered.groupBy("name").agg(F.min("tier").alias("best"))
    return tiered.join(F.broadcast(best), "name").where("tier = best").select("name", "id", "tier")


def assign_seeds(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``name, id``: each seed to one type at most, each type up to its slots (``name, n``).

    Rounds of proposals: every open type proposes its next seeds in hash order, a seed takes the type with the fewest
    choices, then the name. Deterministic, and spread over all tasks; a round shuffles the open pairs only.
    """
    from ..session import materialize

    choice = pairs.groupBy("name").agg(F.count("*").alias("choices"))
    open_ = materialize(pairs.join(choice, "name").select("name", "id", "choices"), "assign")
    taken = None
    need = wanted
    while True:  # each round but the last assigns a seed at least
        order = F.row_number().over(Window.partitionBy("name").orderBy(F.xxhash64("name", "id"), "id"))
        offers = open_.withColumn("r", order).join(F.broadcast(need), "name").where("r <= n")
        won = offers.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("choices", "name"))).where("k = 1").select("name", "id")
        won = materialize(won, "assign")
        if won.limit(1).count() == 0:
            break
        taken = won if taken is None else taken.unionByName(won)
        got = won.groupBy("name").agg(F.count("*").alias("got"))
        need = materialize(need.join(got, "name", "left").select("name", (F.col("n") - F.coalesce("got", F.lit(0))).alias("n")).where("n > 0"), "assign-need")
        open_ = materialize(open_.join(won.select("id"), "id", "left_anti").join(F.broadcast(need.select("name")), "name").select("name", "id", "choices"), "assign")
    return taken if taken is not None else pairs.select("name", "id").limit(0)
