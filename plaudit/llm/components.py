"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.rows import checkpointed


def _large(links: DataFrame) -> DataFrame:
    """Joins the larger neighbours of each node to its smallest neighbour."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v) but the roots themselves; a root is its component's smallest
    node. Each round is stored, so lineage stays short."""
    links = checkpointed(_small(links))
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        links = checkpointed(_small(_large(links)))
