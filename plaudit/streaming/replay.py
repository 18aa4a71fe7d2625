"""The merge of reviews with items again, from the cold archive, as a batch.

What the stream did in the order of arrival is done here in the order of event time: a review takes the latest version of its
item that is not after it, and the first version if none is that early. Reviews whose product has no item are left out, as
they would wait. The archive keeps topic and partition but no offsets, so of two versions of an item with one time, those of
the higher partition count as later, and in one partition the larger text counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.config import LakeConfig, StreamConfig
from plaudit.operators.asof import as_of
from plaudit.streaming.changes import events, parse_changes
from plaudit.streaming.merge import arrival, merged_rows
from plaudit.streaming.messages import MESSAGE


def archived_messages(spark: SparkSession, lake: LakeConfig) -> DataFrame:
    """The archive in the shape of messages; a topic's files are found by its folder."""
    kept = {"topic": "topic", "partition": "CAST(partition AS INT)", "value": "CAST(value AS BINARY)"}
    lines = spark.read.text(lake.archive)
    return lines.selectExpr(*[f"{kept.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {f.name}"
                              for f in MESSAGE.fields])


def replayed_pairs(messages: DataFrame, config: StreamConfig) -> DataFrame:
    """(review, item) pairs as JSON text."""
    def of(topic: str) -> DataFrame:
        rows = events(parse_changes(messages.where(F.col("topic") == topic), config))
        return rows.select("parent_asin", "ts_ms", arrival().alias("rank"), "payload")

    reviews = of(config.reviews_topic).select("parent_asin", "ts_ms", F.col("payload").alias("review"))
    items = of(config.items_topic).groupBy("parent_asin", "ts_ms", "rank").agg(F.max("payload").alias("item"))
    return as_of(reviews, items, "parent_asin", "ts_ms", "rank").select("review", "version.item")


def replay_merge(spark: SparkSession, lake: LakeConfig, config: StreamConfig) -> DataFrame:
    """Typed merged rows plus ``reason``, as the stream makes them."""
    return merged_rows(replayed_pairs(archived_messages(spark, lake), config))
