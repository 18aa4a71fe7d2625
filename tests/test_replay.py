"""The as-of join against a plain look-up, the replay against the stream's model, and where hot products go."""

import random
from bisect import bisect_right
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_plans import plan
from test_streaming import CONFIG, item, review, sequential

from plaudit.config import LakeConfig
from plaudit.operators.asof import as_of, timelines
from plaudit.operators.validate import accepted
from plaudit.contracts import MERGE
from plaudit.session import scratch_path, tune
from plaudit.streaming import jobs, replay
from plaudit.streaming.merge import merged_rows
from plaudit.streaming.messages import MESSAGE


def looked_up(facts, versions):
    by = defaultdict(list)
    for key, at, order, name in sorted(versions):
        by[key].append((at, order, name))
    return Counter((key, at, f, by[key][max(0, bisect_right([v[0] for v in by[key]], at) - 1)][2])
                   for key, at, f in facts if key in by)


@pytest.mark.parametrize("steps", [1, 3, 64])
def test_as_of(spark, steps):
    """Ties in time, versions after all facts, keys on one side only, null keys, and one key with many versions."""
    rng = random.Random(steps)
    keys = ["hot"] * 3 + [f"k{n}" for n in range(9)]
    versions = {(rng.choice(keys), rng.randrange(40), rng.randrange(3)) for _ in range(150)} | {("only", 1, 1)}
    versions = [(*v, f"v{n}") for n, v in enumerate(sorted(versions))]
    facts = [(rng.choice(keys + ["none"]), rng.randrange(-3, 44), f"f{n % 200}") for n in range(400)]
    got = as_of(spark.createDataFrame([*facts, (None, 1, "f")], "key string, at long, fact string"),
                spark.createDataFrame(versions, "key string, at long, order long, name string"), "key", "at", "order", steps)
    assert Counter((r.key, r.at, r.fact, r.version.name) for r in got.collect()) == looked_up(facts, versions)


def test_timelines_are_bounded(spark):
    """A third of all versions are of one key, some at one time."""
    rows = [("hot", n // 3, n % 3, "x") for n in range(300)] + [(f"k{n}", n, 0, "x") for n in range(600)]
    lines = timelines(spark.createDataFrame(rows, "key string, at long, order long, name string").repartition(3),
                      "key", "at", "order", 16).collect()
    assert max(len(r.line) for r in lines) <= 16 and sum(len(r.line) for r in lines) == 900
    hot = sorted((r for r in lines if r.key == "hot"), key=lambda r: r.line[0])
    assert len(hot) >= 300 // 16 and hot[0].since is None and hot[-1].until is None
    assert all(a.until == b.since for a, b in zip(hot, hot[1:]))


def as_names(pairs):
    return sorted((r.review_title, r.product_title) for r in accepted(merged_rows(pairs), MERGE).collect())


def interleaved(n):
    rng, messages = random.Random(n), []
    for k in range(n):
        key, ts = ("hot" if rng.random() < 1 / 3 else f"P{rng.randrange(25)}"), rng.randrange(n // 3)
        messages.append(item(key, f"m{k}", ts) if rng.random() < 0.2 else review(key, f"r{k}", ts))
    return messages


def test_replay_of_messages(spark):
    """With offsets, versions with one time stand in the order of arrival, as in the stream."""
    messages = interleaved(500)
    pairs = replay.replayed_pairs(spark.createDataFrame(messages, MESSAGE), CONFIG)
    assert as_names(pairs) == sequential([messages])


def test_replay_of_the_archive(spark):
    """Deletes, tombstones and broken messages are no events; the same events give the same rows."""
    ts = iter(range(1000))
    messages = [item(k, f"m{n}", next(ts)) if n % 5 == 0 else review(k, f"r{n}", next(ts))
                for n in range(200) for k in [f"P{n % 7}"]]
    noise = [(CONFIG.items_topic, 0, 1, None, None), (CONFIG.reviews_topic, 1, 2, b"junk", None),
             (CONFIG.items_topic, 0, 1, b'{"op":"d","before":{},"after":null,"ts_ms":3}', None)]
    config = LakeConfig(root=scratch_path(spark, "replay-test"))
    spark.createDataFrame(messages + noise, MESSAGE).write.parquet(f"{config.root}/feed/0")
    jobs.start_archive(spark, config, CONFIG, f"{config.root}/feed").awaitTermination()
    assert as_names(replay.replayed_pairs(replay.archived_messages(spark, config), CONFIG)) == sequential([messages])


def test_hot_product_is_split(spark):
    """A third of all reviews, and of all versions, are of one product: no task reads all of it."""
    session = tune(spark.newSession())
    for key, value in {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1",
                       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}.items():
        session.conf.set(key, value)
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500))
    facts = session.range(0, 60_000, 1, 8).select(
        key.alias("key"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("f"))
    versions = session.range(0, 3000, 1, 4).select(
        key.alias("key"), (F.col("id") % 900).alias("at"), F.col("id").alias("order"), F.lit("v").alias("name"))
    joined = as_of(facts, versions, "key", "at", "order")
    per_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count_if(F.col("key") == "hot").alias("n")).collect()
    assert sum(r.n for r in per_task) == 20_000
    assert max(r.n for r in per_task) < 10_000
    assert joined.count() == 60_000
    joined.collect()
    assert "skew=true" in plan(joined)
