"""Marts from stored partial aggregates: a new slice of reviews is read once, and history is not read again.

Each slice leaves four small tables, one row per group. They can be added up: sums, counts, earliest and latest times, and, for
the distinct counts, the (group, product) pairs themselves, which are exact where a sketch would not be. The marts are made of
all slices' rows; compaction adds rows of one group up, so that their number does not grow with the number of slices.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plaudit.config import LakeConfig
from plaudit.contracts import GOLD
from plaudit.functions.identifiers import name_id
from plaudit.operators.checks import conform
from plaudit.operators.slices import commit_batch, compact, live, read_slices
from plaudit.plans.gold import exact_price, user_categories, users_of

KEYS = {
    "users": ["user_id", "category"],
    "products": ["parent_product_id"],
    "categories": ["category", "parent_product_id"],
    "stores": ["store", "parent_product_id"],
}
# How each column of a partial aggregate is added up.
_ADDED = {"first_at": F.min, "last_at": F.max}

STREAM = "slices"


def _measures(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), F.count("rating").alias("rated"),
        F.sum("helpful_vote").alias("votes"), F.count_if("verified_purchase").alias("bought"))


def partials(rows: DataFrame) -> dict[str, DataFrame]:
    """The partial aggregates of a slice of reviews."""
    stores = rows.where(F.col("store").isNotNull()).groupBy(*KEYS["stores"]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), F.count("rating").alias("rated"),
        F.sum(exact_price()).alias("revenue"))
    return {
        "users": user_categories(rows),
        "products": _measures(rows, KEYS["products"]),
        "categories": _measures(rows, KEYS["categories"]),
        "stores": stores,
    }


def added(name: str, rows: DataFrame) -> DataFrame:
    """One row per group again."""
    keys = KEYS[name]
    total = rows.groupBy(*keys).agg(*[_ADDED.get(c, F.sum)(c).alias(c) for c in rows.columns if c not in keys])
    return total.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in rows.schema])


def _config(config: LakeConfig) -> LakeConfig:
    return replace(config, root=config.path("gold", "partials"))


def add_slice(config: LakeConfig, number: int, rows: DataFrame) -> bool:
    """Store the partial aggregates of a slice; false if this slice is there already. All four tables become visible together."""
    return commit_batch(rows.sparkSession, _config(config), STREAM, number, lambda: partials(rows))


def fold(spark: SparkSession, config: LakeConfig, schemas: dict[str, StructType]) -> None:
    """Close all slices there are and add them up."""
    compact(spark, _config(config), schemas, combine=added)


def stored(spark: SparkSession, config: LakeConfig, schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """The tables of all slices, from one look at the manifest, each with one row per group."""
    now = live(spark, _config(config))
    return {name: added(name, read_slices(spark, _config(config), name, schemas[name], now)) for name in KEYS}


def schemas_of(rows: DataFrame) -> dict[str, StructType]:
    """Schemas of the partial aggregates, as the types of the reviews make them."""
    return {name: part.schema for name, part in partials(rows.limit(0)).items()}


def _whole_stars() -> Column:
    return F.round(F.try_divide(F.sum("stars"), F.sum("rated")))


def marts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts of partial aggregates that have one row per group."""
    products = tables["products"].select(
        "parent_product_id", F.col("n").alias("total_reviews"),
        F.round(F.try_divide("stars", "rated")).alias("avg_rating"), F.col("votes").alias("total_helpful_votes"),
        F.col("bought").alias("total_sell_products"))
    categories = tables["categories"].groupBy("category").agg(
        F.count("parent_product_id").alias("total_products"), F.sum("votes").alias("total_helpful_votes"),
        F.sum("n").alias("total_reviews"), _whole_stars().alias("avg_rating"), F.sum("bought").alias("verified_purchases"))
    stores = tables["stores"].groupBy("store").agg(
        F.sum("n").alias("total_reviews"), _whole_stars().alias("avg_rating"),
        F.count("parent_product_id").alias("total_sell_products"),
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"))
    return {
        "mart_users": users_of(tables["users"]),
        "mart_parent_products": conform(products, GOLD["mart_parent_products"]),
        "mart_categories": conform(categories.select(
            "*", name_id("category", F.col("category")).alias("category_id"), F.col("category").alias("category_name")),
            GOLD["mart_categories"]),
        "mart_store_performance": conform(stores.select(
            "*", name_id("store", F.col("store")).alias("store_id"), F.col("store").alias("store_name")),
            GOLD["mart_store_performance"]),
    }
