"""Export documents: reading and writing envelopes of posts, bucket documents, reports and audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT = "exported_at string, total_posts long, posts array<struct<source:string,telegram_message_id:long,date:string,text:string>>"


def read_export(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """``pos, source, message_id, date, text`` of the posts of export documents, in their order.

    A document that isn't JSON raises; a missing path raises if ``required`` and is empty otherwise.
    """
    try:
        docs = spark.read.schema(EXPORT).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except Exception as e:
        if required or "PATH_NOT_FOUND" not in str(e):
            raise
        docs = spark.createDataFrame([], EXPORT)
    p = docs.select("exported_at", F.posexplode("posts").alias("pos", "p"))
    return p.select("pos", "p.source", F.col("p.telegram_message_id").alias("message_id"), "p.date", "p.text")


def envelopes(posts: DataFrame) -> DataFrame:
    """One document per export batch, posts in their order in the batch.

    The array of a batch is bounded by the size of an export batch; batches are documents of their own, so nothing is
    gathered across them.
    """
    x = posts.groupBy("batch_id").agg(F.date_format(F.min("exported_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("exported_at"), F.count("*").alias("total_posts"), F.sort_array(F.collect_list(F.struct("pos", "source", "telegram_message_id", "date", "text"))).alias("p"))
    strip = F.transform("p", lambda s: F.struct(s["source"].alias("source"), s["telegram_message_id"].alias("telegram_message_id"), s["date"].alias("date"), s["text"].alias("text")))
    return x.select("batch_id", "exported_at", "total_posts", strip.alias("posts"))


def write_export(posts: DataFrame, path: str) -> None:
    """Export documents as JSON lines, one per batch; committed atomically by Spark."""
    envelopes(posts).drop("batch_id").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_buckets(classified: DataFrame, path: str) -> None:
    """Classified posts, a folder per class."""
    classified.write.mode("overwrite").partitionBy("classification").json(path)


def write_audit(rows: DataFrame, path: str) -> None:
    """Every candidate with its outcome; to be called in a ``finally``."""
    rows.write.mode("overwrite").parquet(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """A profile as JSON lines (``section, key, value, percentage``), in place of an earlier one once it is whole."""
    profile.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)  # one row per section and key


def audited(rows: DataFrame, path: str, run):
    """``run(rows)``; every candidate with its outcome is written to ``path`` whether it ends or fails."""
    try:
        return run(rows)
    finally:
        write_audit(rows, path)


def report(counts: DataFrame, section: str, key: str, n: str = "n") -> DataFrame:
    """``section, key, n`` rows for a printed report."""
    return counts.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.col(n).alias("n"))
