"""Queries through sources, sinks and streams, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path, table
from ..sources.exports import envelopes, write_buckets, write_export
from ..streaming.classify import classified_stream, run_available
from .text_queries import _CLASSIFIED, classified

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("SELECT batch_id, count(*) AS total_posts, count(text) AS with_text, sum(length(text)) AS n_chars FROM raw_telegram_posts GROUP BY 1")
def export_envelopes(spark, sf):
    e = envelopes(table(spark, sf, "raw_telegram_posts"))
    texts = F.transform("posts", lambda p: p["text"])
    return e.select("batch_id", "total_posts", F.size(F.filter(texts, lambda t: t.isNotNull())).cast("long").alias("with_text"), F.aggregate(texts, F.lit(0).cast("long"), lambda s, t: s + F.coalesce(F.length(t), F.lit(0))).alias("n_chars"))


@query("SELECT lower(trim(source)) AS source, count(*) AS n, count(DISTINCT telegram_message_id) AS messages, coalesce(sum(length(text)), 0) AS n_chars FROM raw_telegram_posts GROUP BY 1")
def json_round_trip(spark, sf):
    path = scratch_path(spark, "export")
    write_export(table(spark, sf, "raw_telegram_posts"), path)
    p = spark.read.schema("exported_at string, total_posts long, posts array<struct<source:string,telegram_message_id:long,date:string,text:string>>").json(path).select(F.explode("posts").alias("p"))
    return p.groupBy(F.lower(F.trim("p.source")).alias("source")).agg(F.count("*").alias("n"), F.count_distinct("p.telegram_message_id").alias("messages"), F.coalesce(F.sum(F.length("p.text")), F.lit(0)).alias("n_chars"))


@query(f"WITH {_CLASSIFIED} SELECT classification, count(*) AS n, sum(length(t)) AS n_chars FROM classified GROUP BY 1")
def bucket_files(spark, sf):
    path = scratch_path(spark, "buckets")
    write_buckets(classified(spark, sf).select("classification", "source", "t", "style_score"), path)
    d = spark.read.schema("source string, t string, style_score int, classification string").json(path)
    return d.groupBy("classification").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("n_chars"))


@query(f"WITH {_CLASSIFIED} SELECT delivery_id, source, classification FROM classified")
def stream_classify(spark, sf):
    source = table(spark, sf, "raw_telegram_posts")
    # The table is a folder of files, or one file; a stream needs a folder.
    path = f"{sf.rstrip('/')}/raw_telegram_posts.parquet"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(source.schema)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        stream = reader.parquet(path)
    else:
        stream = reader.option("pathGlobFilter", "raw_telegram_posts.parquet").parquet(sf)
    return run_available(spark, classified_stream(stream), scratch_path(spark, "stream"))
