"""Table contracts: explicit schemas, keys, and translation from and to Avro record schemas."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType


_TYPES = {
    "STRING": T.StringType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "BINARY": T.BinaryType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def table(columns: str) -> StructType:
    """Schema from ``name TYPE [NOT NULL], ...``; unlike the built-in DDL parser it needs no session."""
    fields = []
    for column in columns.split(", "):
        name, kind, *required = column.split(" ", 2)
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return StructType(fields)


# Column names, types and nullability of every table.
REVIEWS = table(
    "rating FLOAT NOT NULL, review_title STRING NOT NULL, review_text STRING NOT NULL, "
    "product_id STRING NOT NULL, parent_product_id STRING NOT NULL, user_id STRING NOT NULL, "
    "timestamp TIMESTAMP, helpful_vote INT, verified_purchase BOOLEAN"
)
METADATA = table(
    "category STRING NOT NULL, parent_product_id STRING NOT NULL, product_title STRING NOT NULL, "
    "price FLOAT, store STRING, brand STRING, material STRING, style STRING, color STRING"
)
MERGE = StructType(REVIEWS.fields + [f for f in METADATA.fields if f.name != "parent_product_id"])
# Largest magnitude of a number; sums of what is allowed stay exact. Numbers must be finite everywhere.
LIMITS = {"price": 1e12}
IDS = table("review_id STRING, time_id STRING, store_id STRING, category_id STRING")
MERGE_DATA = StructType(IDS.fields + MERGE.fields)

# Columns of parsed tables beside the contract's, and of the canonical table beside its own; the last are folder names.
PARSED = table("value STRING, reason STRING, status STRING")
SLICE = table("source STRING")

# Tables of the landing job.
LANDED = {"streaming": MERGE_DATA, "merge_data": MERGE_DATA, "merged_rejects": table("value STRING, reason STRING")}

RAW_REVIEWS = table(
    "created STRING, rating DOUBLE, title STRING, text STRING, small_image_urls ARRAY<STRING>, "
    "medium_image_urls ARRAY<STRING>, large_image_urls ARRAY<STRING>, asin STRING, "
    "parent_asin STRING, user_id STRING, timestamp STRING, helpful_vote BIGINT, "
    "verified_purchase BOOLEAN"
)
RAW_ITEMS = table(
    "created STRING, main_category STRING, title STRING, price DOUBLE, "
    "hi_res_images ARRAY<STRING>, large_images ARRAY<STRING>, thumb_images ARRAY<STRING>, "
    "store STRING, brand STRING, material STRING, style STRING, color STRING, parent_asin STRING"
)

SILVER = {
    "dim_time": table(
        "time_id STRING, review_date TIMESTAMP, year INT, month INT, day INT, quarter INT"
    ),
    "dim_reviews": table("review_id STRING, review_title STRING, review_text STRING"),
    "dim_products": table(
        "product_id STRING, parent_product_id STRING, store STRING, category STRING, "
        "product_title STRING, price DOUBLE, brand STRING, material STRING"
    ),
    "fact_reviews": table(
        "review_id STRING, user_id STRING, time_id STRING, product_id STRING, rating DOUBLE, "
        "verified_purchase BOOLEAN, helpful_vote BIGINT"
    ),
}
GOLD = {
    "mart_users": table(
        "user_id STRING, total_reviews BIGINT, avg_rating DOUBLE, total_helpful_votes BIGINT, "
        "total_buy_products BIGINT, top_category STRING, first_review_date TIMESTAMP, "
        "last_review_date TIMESTAMP"
    ),
    "mart_parent_products": table(
        "parent_product_id STRING, total_reviews BIGINT, avg_rating DOUBLE, "
        "total_helpful_votes BIGINT, total_sell_products BIGINT"
    ),
    "mart_categories": table(
        "category_id STRING, category_name STRING, total_products BIGINT, "
        "total_helpful_votes BIGINT, total_reviews BIGINT, avg_rating DOUBLE, "
        "verified_purchases BIGINT"
    ),
    "mart_store_performance": table(
        "store_id STRING, store_name STRING, total_reviews BIGINT, avg_rating DOUBLE, "
        "total_sell_products BIGINT, total_revenue DOUBLE"
    ),
    "mart_reviews": table(
        "review_id STRING, user_id STRING, product_id STRING, rating DOUBLE, "
        "verified_purchase BOOLEAN, helpful_vote BIGINT"
    ),
}
PRIMARY_KEYS = {
    "dim_time": "time_id",
    "dim_reviews": "review_id",
    "dim_products": "product_id",
    "fact_reviews": "review_id",
    "mart_users": "user_id",
    "mart_parent_products": "parent_product_id",
    "mart_categories": "category_id",
    "mart_store_performance": "store_id",
    "mart_reviews": "review_id",
}
# child table, column, parent table
FOREIGN_KEYS = [
    ("fact_reviews", "review_id", "dim_reviews"),
    ("fact_reviews", "product_id", "dim_products"),
    ("fact_reviews", "time_id", "dim_time"),
]

# Raw key behind each review and item column; item attributes are nested in raw lines, and plain
# columns in change rows.
REVIEW_KEYS = {
    "rating": "rating",
    "review_title": "title",
    "review_text": "text",
    "product_id": "asin",
    "parent_product_id": "parent_asin",
    "user_id": "user_id",
    "timestamp": "timestamp",
    "helpful_vote": "helpful_vote",
    "verified_purchase": "verified_purchase",
}
ITEM_KEYS = {
    "category": "main_category",
    "product_title": "title",
    "price": "price",
    "store": "store",
}
DETAIL_KEYS = ("brand", "material", "style", "color")

_AVRO_TO_SPARK = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}
_SPARK_TO_AVRO = {type(spark): avro for avro, spark in _AVRO_TO_SPARK.items()}
_TIMESTAMP_LOGICAL = ("timestamp-millis", "timestamp-micros")


def _avro_type(avro) -> tuple[T.DataType, bool]:
    """Spark type and nullability of an Avro type."""
    if isinstance(avro, list):
        branches = [b for b in avro if b != "null"]
        if len(branches) != 1:
            raise ValueError(f"only unions of null and one type are supported: {avro}")
        return _avro_type(branches[0])[0], "null" in avro
    if isinstance(avro, str):
        return _AVRO_TO_SPARK[avro], False
    if avro.get("logicalType") in _TIMESTAMP_LOGICAL:
        return T.TimestampType(), False
    kind = avro["type"]
    if kind == "array":
        return T.ArrayType(*_avro_type(avro["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *_avro_type(avro["values"])), False
    if kind == "record":
        return avro_to_struct(avro, timestamp_fields=()), False
    return _avro_type(kind)


def avro_to_struct(schema: dict, timestamp_fields: tuple[str, ...] = ("timestamp",)) -> StructType:
    """Table schema of an Avro record; fields that carry time as text become timestamps."""
    fields = []
    for field in schema["fields"]:
        name = field["name"]
        if name in timestamp_fields:
            fields.append(T.StructField(name, T.TimestampType(), True))
        else:
            fields.append(T.StructField(name, *_avro_type(field["type"])))
    return StructType(fields)


def struct_to_avro(struct: StructType, name: str) -> dict:
    """Avro record of a flat table schema; timestamps travel as text."""
    fields = []
    for field in struct.fields:
        avro = "string" if isinstance(field.dataType, T.TimestampType) else _SPARK_TO_AVRO[type(field.dataType)]
        if field.nullable:
            fields.append({"name": field.name, "type": ["null", avro], "default": None})
        else:
            fields.append({"name": field.name, "type": avro})
    return {"type": "record", "name": name, "fields": fields}
