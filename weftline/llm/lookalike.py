"""Problem 1, pairs: deliveries of different messages whose texts look the same but differ as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.delivery_index import source_key
from ..session import materialize
from .canonical import with_canonical

#: Rows of one string on either side of a pair of cells, and strings of a form on one side of a part.
BLOCK = 20_000
#: Forms with several strings that may be broadcast (20 bytes each); beyond it they are joined by shuffle.
BROADCAST_FORMS = 500_000


def lookalike_pairs(df: DataFrame, row_id: str = "delivery_id", source: str = "source", message: str = "telegram_message_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Pairs (``a`` < ``b``) of rows of different messages with equal ``form_key`` and different strings.

    Null texts and texts without any letter take no part. Rows of one message never pair. Equal strings never
    pair, nor are their rows compared: the strings of a form are paired first, then their rows, in cells of ``block``
    rows, so no task holds the whole group. An empty table gives no rows.
    """
    d = df.select(F.col(row_id).cast("long").alias("id"), source_key(F.col(source)).alias("s"), F.col(message).cast("long").alias("m"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    keyed = with_canonical(d, "text").where(F.col("canonical").rlike(r"\p{L}")).select("id", F.xxhash64("s", "m").alias("msg"), "s", "m", F.xxhash64("text").alias("h"), F.col("form_key").alias("k"))
    keyed = materialize(keyed, "lookalike")
    several = keyed.groupBy("k").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("k")
    several = materialize(several, "lookalike-forms")
    rows = keyed.join(F.broadcast(several) if several.count() <= BROADCAST_FORMS else several, "k")
    strings = materialize(rows.groupBy("k", "h").agg(F.ceil(F.count("*") / block).cast("int").alias("cells")), "lookalike-strings")
    rows = rows.join(F.broadcast(strings) if strings.count() <= BROADCAST_FORMS else strings, ["k", "h"]).withColumn("g", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")).drop("cells")
    right = rows.select("k", *[F.col(c).alias(f"{c}_b") for c in ("h", "g", "id", "msg", "s", "m")])
    same_message = F.expr("msg = msg_b AND s = s_b AND m <=> m_b")
    met = string_pairs(strings, block).join(rows, ["k", "h", "g"]).join(right, ["k", "h_b", "g_b"]).where(~same_message)
    return met.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b"))


def string_pairs(strings: DataFrame, block: int) -> DataFrame:
    """``k, h, g, h_b, g_b``: the pairs of different strings of a form, once for each pair of their cells of rows.

    ``strings``: ``k, h, cells``. A form with more than ``block`` strings is split into parts that meet all its strings.
    """
    parts = strings.groupBy("k").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    each = strings.join(parts, "k")
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    x = each.select("k", "h", "cells", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int").alias("part"))
    y = each.select("k", F.col("h").alias("h_b"), F.col("cells").alias("cells_b"), numbers("parts").alias("part"))
    pairs = x.join(y, ["k", "part"]).where("h < h_b")
    return pairs.withColumn("g", numbers("cells")).withColumn("g_b", numbers("cells_b")).select("k", "h", "g", "h_b", "g_b")
