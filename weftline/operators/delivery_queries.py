"""Queries of problem 2 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .delivery_index import first_deliveries, surplus_deliveries


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return surplus_deliveries(table(spark, sf, "raw_telegram_posts"))


def p2_first(spark: SparkSession, sf: str) -> DataFrame:
    kept = first_deliveries(table(spark, sf, "raw_telegram_posts"))
    return kept.select("delivery_id", F.col("telegram_message_id"), "text")


_NUMBERED = r"""
SELECT delivery_id, telegram_message_id, text,
       row_number() OVER (PARTITION BY coalesce(lower(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), ''), telegram_message_id
                          ORDER BY exported_at NULLS LAST, delivery_id) AS n
FROM raw_telegram_posts"""

QUERIES = {"p2_found": p2_found, "p2_first": p2_first}
ORACLES = {
    "p2_found": f"SELECT delivery_id FROM ({_NUMBERED}) WHERE n > 1 AND telegram_message_id IS NOT NULL",
    "p2_first": f"SELECT delivery_id, telegram_message_id, text FROM ({_NUMBERED}) WHERE n = 1 OR telegram_message_id IS NULL",
}
