"""Join of reviews with items, ids, and the canonical table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.contracts import MERGE, MERGE_DATA
from plaudit.functions.identifiers import content_digest, name_id, uuid7_from

# Hashes of repeated ids that are worth a join of their own; with more of them all rows are ranked in one shuffle.
FEW_COPIES = 500_000
# Rows that are ranked in one shuffle of all their columns.
PART_ROWS = 50_000_000


def merge_reviews(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Inner join on the parent product; duplicate items fan out, orphans on either side drop.

    No hint: the adaptive planner broadcasts the items when their measured size allows it, and
    otherwise splits the partitions of hot products.
    """
    return reviews.join(items, "parent_product_id", "inner").select(*MERGE.fieldNames())


def lanes_of(reviews: DataFrame, items: DataFrame, lanes: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``lane``: a review is in one, by a hash of what it says, an item in all. Joined by product and lane
    they give the same rows, and a hot product is spread over all lanes, also where no shuffle could split it."""
    lane = F.pmod(F.xxhash64("user_id", "product_id", "review_text"), F.lit(lanes)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    return reviews.withColumn("lane", lane), items.withColumn("lane", every)


def add_ids(merged: DataFrame) -> DataFrame:
    """Review and time ids from the row's content, store and category ids from their names."""
    content = [
        F.unix_millis("timestamp") if name == "timestamp" else F.col(name)
        for name in MERGE.fieldNames()
    ]
    return (
        merged.withColumn("_digest", content_digest(*content))
        .withColumns({
            "review_id": uuid7_from(F.col("timestamp"), F.col("_digest")),
            "time_id": uuid7_from(F.col("timestamp"), F.md5(F.concat(F.lit("time:"), F.col("_digest")))),
            "store_id": name_id("store", F.col("store")),
            "category_id": name_id("category", F.col("category")),
        })
        .select(*MERGE_DATA.fieldNames(), *[c for c in merged.columns if c not in MERGE.fieldNames()])
    )


def union_sources(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """All rows of both paths in the canonical schema, tagged with where they came from."""
    def tagged(rows: DataFrame, source: str) -> DataFrame:
        return rows.select(*MERGE_DATA.fieldNames()).withColumn("source", F.lit(source))

    return tagged(batch, "batch").unionByName(tagged(stream, "stream"))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter sits directly on the window, so every map task keeps one row per key before
    the shuffle and a key with many copies does not gather in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def dedup_reviews(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per review id; ids depend on content only, so copies differ in ``source`` alone.

    Where ids were made of the content, copies agree in every column that went into it. Columns named as ``within`` then
    change no row, but rows that a join has dealt by them are ranked where they are, without another shuffle.
    """
    return keep_first(rows, [*within, "review_id"], [F.col("source")])


def without_copies(rows: DataFrame) -> DataFrame:
    """The same where few ids repeat: hashes of ids are counted, and only rows of repeated ones are ranked by their ids.

    ``rows`` is read twice, so it should be a stored table; the columns of rows that have no copy are not shuffled unless
    so many ids repeat that Spark will not broadcast them. Two ids with one hash are told apart before that. A row
    without an id is no copy of another.
    """
    return reduce(DataFrame.unionByName, without_copies_in_parts(rows))


def without_copies_in_parts(rows: DataFrame) -> list[DataFrame]:
    """The same in parts by hash of the id, to be written one after another: where all columns are shuffled, the shuffle
    of one part is all that lies on disk."""
    known = F.col("review_id").isNotNull()
    marked = rows.withColumn("_h", F.when(known, F.xxhash64("review_id")))
    counts = marked.where(known).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where("_n > 1").select("_h")
    if repeated.limit(FEW_COPIES + 1).count() > FEW_COPIES:  # by hash, all columns would be shuffled for each of the joins
        n_parts = max(1, -(-rows.count() // PART_ROWS))
        parts = [dedup_reviews(rows.where(known & (F.pmod(F.xxhash64("review_id"), F.lit(n_parts)) == k)))
                 for k in range(n_parts)]
        return [parts[0].unionByName(rows.where(~known)), *parts[1:]]
    ids = marked.join(repeated, "_h", "left_semi").groupBy("review_id").agg(F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").select("review_id")
    return [rows.join(ids, "review_id", "left_anti").unionByName(
        dedup_reviews(rows.join(ids, "review_id", "left_semi"))).select(*rows.columns)]


def latest_items(items: DataFrame, version: Column) -> DataFrame:
    """The newest version of each item, for a join that must not fan out."""
    return keep_first(items, ["parent_product_id"], [version.desc()])
