"""The classifier as a stream, and first deliveries of a stream of messages; extensions, the batch form is the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.delivery_index import source_key


def classified_stream(posts: DataFrame) -> DataFrame:
    """Posts of a stream (or table) with their class; map-only, so any output mode will do."""
    t = posts.where("text IS NOT NULL").select("delivery_id", "source", T.normalize("text").alias("t"))
    r = t.select("*", T.reasons("t").alias("r"), T.style_score("t").alias("style_score"))
    return r.select("delivery_id", "source", T.classification(F.col("r"), F.col("style_score")).alias("classification"))


def first_of_stream(posts: DataFrame, delay: str = "7 days") -> DataFrame:
    """One delivery of each message of a stream within ``delay`` of its export; state is bounded by the watermark."""
    keyed = posts.where("telegram_message_id IS NOT NULL").withColumn("s", source_key(F.col("source")))
    return keyed.withWatermark("exported_at", delay).dropDuplicatesWithinWatermark(["s", "telegram_message_id"])


def run_available(spark: SparkSession, stream: DataFrame, out: str) -> DataFrame:
    """Run a stream over what there is, into parquet under the folder ``out``; gives the written table."""
    q = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")
