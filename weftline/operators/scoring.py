"""Model responses and evaluations: parsing, validity, joining with a second pass, keeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ITEMS = "posts array<struct<n:int,text:string,skip:boolean>>"
EVALUATIONS = "evaluations array<struct<index:int,score:double,keep:boolean,formulaic:boolean,ai_feel:boolean,topic:string,reason:string>>"


def parse_items(responses: DataFrame, json: str = "json", size: str = "size") -> DataFrame:
    """``batch_id, pos, n, text, outcome`` of the items of each response: kept, skipped or malformed."""
    x = responses.select("batch_id", size, F.posexplode_outer(F.from_json(json, ITEMS)["posts"]).alias("pos", "i"))
    text = F.coalesce(F.trim("i.text"), F.lit(""))
    bad = F.col("i.n").isNull() | ~F.col("i.n").between(1, F.col(size))
    return x.select("batch_id", "pos", F.col("i.n").alias("n"), text.alias("text"), F.when(bad, "malformed").when(F.coalesce("i.skip", F.lit(False)), "skipped").when(text == "", "malformed").otherwise("kept").alias("outcome"))


def parse_evaluations(responses: DataFrame, json: str = "json", size: str = "size") -> DataFrame:
    """Valid evaluations of each response; of several for one index the last counts."""
    x = responses.select("batch_id", size, F.posexplode(F.from_json(json, EVALUATIONS)["evaluations"]).alias("pos", "e"))
    ok = x.where(F.col("e.index").between(1, F.col(size)) & F.col("e.score").isNotNull())
    last = ok.groupBy("batch_id", F.col("e.index").alias("index")).agg(F.max_by("e", "pos").alias("e"))
    return last.select("batch_id", "index", F.col("e.score").alias("score"), F.coalesce("e.keep", F.lit(False)).alias("keep"))


def valid(index: Column, score: Column, size: int = 20) -> Column:
    return index.between(1, size) & score.isNotNull()


def latest_scores(evaluations: DataFrame, size: int = 20) -> DataFrame:
    """One row per candidate: the first pass with a valid evaluation, and in it the latest received.

    A window limited to its first row, so the rows of a much evaluated candidate are cut before the shuffle.
    """
    ok = evaluations.where(valid(F.col("item_index"), F.col("score"), size))
    w = Window.partitionBy("candidate_id").orderBy(F.col("pass_no").asc_nulls_last(), F.col("received_at").desc_nulls_last(), F.col("eval_id").desc())
    return ok.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def keep_rule(keep: Column, score: Column, least: float = 5.0) -> Column:
    """Both the verdict and the score must speak for a candidate; nulls speak against it."""
    return F.coalesce(keep & (score >= least), F.lit(False))
