"""The star-schema test tables seen as reviews, items, raw lines and change messages.

The projections are SQL expressions that Spark and an ANSI engine read alike, so that a check in
another engine starts from the same input. Some rows are made faulty by rules on their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.config import StreamConfig
from plaudit.contracts import METADATA, REVIEWS
from plaudit.session import freeing_shuffles
from plaudit.streaming.messages import MESSAGE

_STARS = "(1 + CAST(l_quantity AS INT) % 5)"
_TEXT = (
    "concat_ws('-', l_returnflag, l_linestatus, CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
    "CAST(CAST(l_quantity AS INT) AS STRING), CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING))"
)
_PRODUCT = "concat(CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))"
_SHIPPED = "CAST(l_shipdate AS TIMESTAMP)"
_COLOR = "split_part(p_name, ' ', 1)"
_MATERIAL = "split_part(p_name, ' ', 2)"

# Some prices have three decimals.
_PRICE = "CAST(CASE WHEN p_size = 6 THEN FLOOR(p_retailprice) + 0.125 ELSE p_retailprice END AS FLOAT)"

REVIEW_COLUMNS = {
    "rating": f"CAST({_STARS} AS FLOAT)",
    "review_title": "o_orderpriority",
    "review_text": _TEXT,
    "product_id": _PRODUCT,
    "parent_product_id": "CAST(l_partkey AS STRING)",
    "user_id": "CAST(o_custkey AS STRING)",
    "timestamp": _SHIPPED,
    "helpful_vote": "l_linenumber",
    "verified_purchase": "l_returnflag <> 'R'",
}
ITEM_COLUMNS = {
    "category": "p_type",
    "parent_product_id": "CAST(p_partkey AS STRING)",
    "product_title": "p_name",
    "price": _PRICE,
    "store": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END",
    "brand": "p_brand",
    "material": f"CASE WHEN p_size % 3 = 0 THEN {_MATERIAL} END",
    "style": "CAST(NULL AS STRING)",
    "color": f"CASE WHEN p_size % 2 = 0 THEN {_COLOR} END",
}

# Raw review line. Faults: no closing brace where the discount is 0, a null title where the tax is
# 0, a vote beyond 32 bits where it is 0.08, a quoted rating on line 7, a time beyond the calendar
# where the discount is 0.09, and beyond the text form's years where it is 0.08. A null time is no fault.
REVIEW_LINE = f"""concat(
    '{{"rating":', CASE WHEN l_linenumber = 7 THEN concat('"', CAST({_STARS} AS STRING), '"')
                        WHEN l_linenumber = 6 THEN concat(CAST({_STARS} AS STRING), '.0')
                        ELSE CAST({_STARS} AS STRING) END,
    ',"title":', CASE WHEN l_tax = 0 THEN 'null' ELSE concat('"', o_orderpriority, '"') END,
    ',"text":"', {_TEXT}, '","images":', CASE WHEN l_linenumber = 1 THEN '[]' ELSE concat(
        '[{{"small_image_url":"s/', {_PRODUCT}, '","large_image_url":"l/', {_PRODUCT},
        '","medium_image_url":"m/', {_PRODUCT}, '"}},{{"small_image_url":"s2/', {_PRODUCT},
        '","medium_image_url":null}}]') END,
    ',"asin":"', {_PRODUCT}, '","parent_asin":"', CAST(l_partkey AS STRING),
    '","user_id":"', CAST(o_custkey AS STRING),
    '","timestamp":', CASE WHEN l_discount = 0.1 THEN 'null'
        WHEN l_discount = 0.09 THEN '9223372036854775807' WHEN l_discount = 0.08 THEN '1000000000000000'
        WHEN l_discount = 0.05 THEN concat('"', CAST(epoch_ms({_SHIPPED}) AS STRING), '"')
        ELSE CAST(epoch_ms({_SHIPPED}) + 789 AS STRING) END,
    ',"helpful_vote":', CASE WHEN l_tax = 0.08 THEN '3000000000' ELSE CAST(l_linenumber AS STRING) END,
    ',"verified_purchase":', CASE WHEN l_returnflag <> 'R' THEN 'true' ELSE 'false' END,
    CASE WHEN l_discount = 0 THEN '' ELSE '}}' END)"""

# Raw item line. Faults: a text price where the size is 3, one out of range where it is 7, a null category
# where it is 4.
ITEM_LINE = f"""concat(
    '{{"main_category":', CASE WHEN p_size = 4 THEN 'null' ELSE concat('"', p_type, '"') END,
    ',"title":"', p_name, '","average_rating":4.1,"rating_number":12,"features":["a","b"],"price":',
    CASE WHEN p_size = 3 THEN '"from 14.99"' WHEN p_size = 5 THEN 'null' WHEN p_size = 7 THEN '1e30'
         ELSE CAST({_PRICE} AS STRING) END,
    ',"images":[{{"thumb":"t/', CAST(p_partkey AS STRING), '","large":"l/', CAST(p_partkey AS STRING),
    '","hi_res":', CASE WHEN p_size % 5 = 0 THEN 'null' ELSE concat('"h/', CAST(p_partkey AS STRING), '"') END,
    '}},{{"thumb":["x"],"large":"l2/', CAST(p_partkey AS STRING), '"}}]',
    ',"store":', CASE WHEN p_size % 10 = 0 THEN 'null' ELSE concat('"', p_brand, '"') END,
    CASE WHEN p_size = 2 THEN '' ELSE concat(
        ',"details":{{"', CASE WHEN p_size = 1 THEN 'brand' ELSE 'Brand' END, '":"', p_brand,
        '","Color":"', {_COLOR}, '","Weight":{{"kg":', CAST(p_size AS STRING), '}}}}') END,
    ',"parent_asin":"', CAST(p_partkey AS STRING), '"}}')"""

# Change envelopes. A review arrives at the step of its line number. An item arrives at an early
# step and, renamed, at a late one; the items of size 50 never arrive, those of size 49 are deleted
# at the end (a delete event, then a message without a value). An update tells the item before it.
# Faults of the after-images: a quoted rating on line 7, a null title where the tax is 0, a time beyond
# the calendar where the discount is 0.09; a price that is no number where the size is 8, and one out of range
# where it is 7.
REVIEW_STEP = "l_linenumber"
REVIEW_CHANGE = f"""concat(
    '{{"before":null,"after":{{"created":"2024-01-01 00:00:00","rating":',
    CASE WHEN l_linenumber = 7 THEN concat('"', CAST({_STARS} AS STRING), '"') ELSE CAST({_STARS} AS STRING) END,
    ',"title":', CASE WHEN l_tax = 0 THEN 'null' ELSE concat('"', o_orderpriority, '"') END,
    ',"text":"', {_TEXT}, '","small_image_urls":[],"asin":"', {_PRODUCT},
    '","parent_asin":"', CAST(l_partkey AS STRING), '","user_id":"', CAST(o_custkey AS STRING),
    '","timestamp":"', CASE WHEN l_discount = 0.09 THEN '9223372036854775807'
        ELSE CAST(epoch_ms({_SHIPPED}) AS STRING) END, '","helpful_vote":', CAST(l_linenumber AS STRING),
    ',"verified_purchase":', CASE WHEN l_returnflag <> 'R' THEN 'true' ELSE 'false' END,
    '}},"source":{{"schema":"public","table":"raw_reviews"}},"op":"c","ts_ms":', CAST(l_linenumber AS STRING), '}}')"""
ITEM_STEPS = {"v1": "p_size % 3 + 1", "v2": "p_size % 3 + 5", "gone": "9", "tombstone": "10"}


def item_change(version: str) -> str:
    step = ITEM_STEPS[version]
    if version == "tombstone":
        return "CAST(NULL AS STRING)"
    after, before, op = "null", "null", "d"
    if version != "gone":
        op = "c" if version == "v1" else "u"
        title = "p_name" if version == "v1" else "concat(p_name, ' v2')"
        before = "null" if version == "v1" else """{"title":"', p_name, '"}"""
        after = f"""{{"created":"2024-01-01 00:00:00","main_category":"', p_type, '","title":"', {title},
            '","price":', CASE WHEN p_size = 8 THEN '"NaN"' WHEN p_size = 7 THEN '1e30' ELSE CAST({_PRICE} AS STRING) END,
            ',"store":', CASE WHEN p_size % 10 = 0 THEN 'null'
            ELSE concat('"', p_brand, '"') END, ',"brand":"', p_brand,
            '","material":null,"style":null,"color":"', {_COLOR}, '","parent_asin":"',
            CAST(p_partkey AS STRING), '"}}"""
    return f"""concat('{{"before":{before},"after":{after},"source":{{"schema":"public","table":"raw_item_metadata"}}',
        ',"op":"{op}","ts_ms":', CAST({step} AS STRING), '}}')"""


def item_rows(version: str) -> str:
    """Which items send this change."""
    return "p_size = 49" if version in ("gone", "tombstone") else "p_size <> 50"


def spark_sql(expression: str) -> str:
    return expression.replace("epoch_ms(", "unix_millis(")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(expressions: dict[str, str]) -> list:
    return [F.expr(spark_sql(e)).alias(name) for name, e in expressions.items()]


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select(*_columns(REVIEW_COLUMNS)).select(*REVIEWS.fieldNames())


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*_columns(ITEM_COLUMNS)).select(*METADATA.fieldNames())


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select(*_columns({"value": REVIEW_LINE}))


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*_columns({"value": ITEM_LINE}))


def change_messages(spark: SparkSession, sf_dir: str, config: StreamConfig) -> DataFrame:
    """All change messages with the step at which each arrives."""
    def messages(rows: DataFrame, topic: str, key: str, value: str, step: str) -> DataFrame:
        return rows.select(
            F.lit(topic).alias("topic"),
            F.expr(f"CAST({key} % 3 AS INT)").alias("partition"),
            F.expr(f"CAST({key} * 16 + {step} AS BIGINT)").alias("offset"),
            F.expr(spark_sql(value)).cast("binary").alias("value"),
            F.expr(f"timestamp_millis({step})").alias("timestamp"),
            F.expr(step).alias("step"),
        )

    stream = messages(_sales(spark, sf_dir), config.reviews_topic, "l_orderkey", REVIEW_CHANGE, REVIEW_STEP)
    part = table(spark, sf_dir, "part")
    for version, step in ITEM_STEPS.items():
        rows = part.where(item_rows(version))
        stream = stream.unionByName(
            messages(rows, config.items_topic, "p_partkey", item_change(version), step))
    return stream


def deliver(messages: DataFrame, folder: str, delivery: str) -> None:
    """Add message files of bounded length to an offline feed, as a file of one row group is read by one task."""
    with freeing_shuffles(messages.sparkSession):
        messages.select(*MESSAGE.fieldNames()).write.mode("overwrite").option("maxRecordsPerFile", 250_000).parquet(
            f"{folder}/{delivery}", compression="zstd")
