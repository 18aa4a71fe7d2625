"""As-of join: each fact takes the version of its key that was in force at its time.

The versions of a key are laid out as timelines, rows of at most ``steps`` versions one after another in time. A key with many
versions has many timelines, each for a range of times, so neither a much changed key nor a much used one comes together in
one task: versions are range-partitioned by key and time, and a key's facts are split by the adaptive join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.operators.sinks import write_table
from plaudit.config import LakeConfig
from plaudit.session import scratch_path
from plaudit.sources.lake import read_table

STEPS = 64


def timelines(versions: DataFrame, key: str, at: str, order: str, steps: int = STEPS) -> DataFrame:
    """Key, ``since`` and ``until`` (null: without end), and ``line``, the versions of that time in order.

    (key, at, order) must be unique, and ``at`` not null. The first timeline of a key reaches back to the beginning of time.
    The versions are stored in order first, because the cuts must be the same each time they are looked at.
    """
    spark = versions.sparkSession
    path = scratch_path(spark, "versions")
    by = [key, at, order]
    place = F.monotonically_increasing_id()
    write_table(versions.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_cut", F.floor(place / steps)),
                path, LakeConfig(root=path))
    placed = read_table(spark, path)
    begins = placed.groupBy(key, "_cut").agg(F.min(at).alias("_since"))
    in_time = Window.partitionBy(key).orderBy("_since", "_cut")  # one narrow row for each timeline
    ranges = begins.select(
        key, "_cut", F.when(F.row_number().over(in_time) > 1, F.col("_since")).alias("since"),
        F.lead("_since").over(in_time).alias("until"))
    step = F.struct(F.col(at).alias("at"), F.col(order).alias("order"), F.struct(
        *[c for c in versions.columns if c not in by]).alias("version"))
    lines = placed.groupBy(key, "_cut").agg(F.sort_array(F.collect_list(step)).alias("line"))
    return lines.join(ranges, [key, "_cut"]).drop("_cut")


def in_force(line: Column, at: Column) -> Column:
    """The last version that is not after ``at``; when all are, the first."""
    before = F.filter(line, lambda step: step["at"] <= at)
    return F.coalesce(F.get(before, F.size(before) - 1), F.get(line, F.lit(0)))["version"]


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, order: str, steps: int = STEPS) -> DataFrame:
    """All facts whose key has a version, with ``version``: the last one not after their time, or else the first one.

    No hint is given: timelines are broadcast if their measured size allows it, and otherwise the partitions of keys with
    many facts are split at run time.
    """
    lines = timelines(versions, key, at, order, steps)
    time = F.col(at)
    within = (F.col("since").isNull() | (time >= F.col("since"))) & (F.col("until").isNull() | (time < F.col("until")))
    rows = facts.join(lines.withColumnRenamed(key, "_key"), (F.col(key) == F.col("_key")) & within)
    return rows.select(*facts.columns, in_force(F.col("line"), time).alias("version"))
