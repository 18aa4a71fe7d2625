"""Physical plans and skew: what runs where."""

import re

import pytest
from pyspark.sql import functions as F

from plaudit.config import LakeConfig
from plaudit.contracts import PRIMARY_KEYS
from plaudit.operators import checks, enrich
from plaudit.operators.sinks import write_merge_data
from plaudit.plans import gold, partials, registry, silver
from plaudit.session import scratch_path, tune
from plaudit.sources import lake


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    config = LakeConfig(root=scratch_path(spark, "plans"))
    write_merge_data(registry.merge_data(spark, sf_dir), config, "batch", 0)
    return lake.read_merge_data(spark, config)


MARTS = {**{n: getattr(gold, n) for n in (
    "mart_users", "mart_parent_products", "mart_categories", "mart_store_performance", "mart_reviews")},
    **{n: getattr(silver, n) for n in ("dim_time", "dim_reviews", "dim_products", "fact_reviews")}}


@pytest.mark.parametrize("name", MARTS)
def test_one_pruned_scan_no_join_no_python(stored, name):
    text = plan(MARTS[name](stored))
    assert text.count("FileScan") == 1
    assert "Join" not in text and "Python" not in text
    if name != "dim_reviews":
        assert "review_text" not in re.search(r"ReadSchema: (\S+)", text).group(1)


@pytest.mark.parametrize("name", ["mart_users", "mart_parent_products", "mart_categories", "mart_store_performance",
                                  "dim_products"])
def test_rows_are_hash_aggregated_before_the_first_shuffle(stored, name):
    lines = plan(MARTS[name](stored)).splitlines()
    first_shuffle = max(i for i, line in enumerate(lines) if "Exchange" in line)
    below = "\n".join(lines[first_shuffle:])
    assert "HashAggregate" in below and "SortAggregate" not in below


def test_dedup_ranks_before_the_shuffle(stored):
    text = plan(enrich.dedup_reviews(stored))
    assert text.count("WindowGroupLimit") == 2


def test_dedup_ranks_both_paths_where_the_join_has_dealt_them(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = registry.QUERIES["dedup_reviews"](spark, sf_dir)
        assert not re.search(r"Exchange hashpartitioning\([^)]*review_id", plan(rows))
        either = enrich.dedup_reviews(registry.union_batch_stream(spark, sf_dir))
        assert rows.count() == either.count() > 0 and rows.exceptAll(either).isEmpty()
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_no_python_workers_in_results(spark, sf_dir, name):
    if name in ("stream_merge", "stream_to_lake", "historical_store_mart", "cdc_archive", "cdc_rejects",
                "path_routing", "catalog_sql", "merge_rejects", "raw_tables_landed", "key_report_both_paths", "replay_merge",
                "merge_after_relayout", "expired_reviews", "landing_dedup", "compacted_merge_data",
                "current_items", "catalog_years"):
        pytest.skip("writes first; what it returns is a file scan")
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(("name", "scans", "shuffles"), [("pk_violations", 6, 10), ("fk_orphans", 4, 2)])
def test_key_reports_read_and_shuffle_little(spark, sf_dir, name, scans, shuffles):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert text.count("FileScan") <= scans
    assert text.count("Exchange hashpartitioning") <= shuffles
    assert "Join" not in text


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.unset(key)


def test_bucketed_join_has_no_shuffle(no_broadcast, sf_dir):
    text = plan(registry.merge_bucketed(no_broadcast, sf_dir))
    assert "SortMergeJoin [parent_product_id" in text and "Exchange" not in text and "SelectedBucketsCount: 16 out of 16" in text


def test_years_are_partitions(spark, sf_dir):
    text = plan(registry.catalog_years(spark, sf_dir))
    filters = re.search(r"PartitionFilters: \[(.*?)\],", text).group(1)
    assert "review_year" in filters and "1995" in filters and "1996" in filters


def test_publish_shuffles_ids_and_copies_alone(spark, stored):
    """No row that has no copy is sorted or moved: its side of the join is the scan itself."""
    once = stored.where("source = 'batch'")
    text = plan(enrich.without_copies(once))
    assert text.count("LeftAnti") == 1 and "BroadcastHashJoin [review_id" in text
    kept = enrich.without_copies(once.unionByName(once.where("helpful_vote = 1").withColumn("source", F.lit("stream"))))
    assert kept.count() == once.count() and {r.source for r in kept.select("source").distinct().collect()} == {"batch"}
    twice = once.unionByName(once)
    assert enrich.without_copies(twice).count() == once.count()


def test_a_key_of_several_tables_is_counted_once(stored):
    """Three tables with the key review_id, and one with time_id: two rows a review."""
    others = {n: stored for n, key in PRIMARY_KEYS.items() if key not in ("review_id", "time_id")}
    report = checks.derived_key_report(stored, others)
    generated = report._jdf.queryExecution().analyzed().toString()
    (pairs,) = re.findall(r"explode\(map\((.*?)\)\)", generated)
    assert re.sub(r"#\d+", "", pairs) == "time_id, time_id, review_id, review_id"
    assert {r.table_name: r.repeated_keys for r in report.collect()}["mart_reviews"] == 0


def test_marts_of_partials_do_not_read_reviews(spark, sf_dir, stored):
    config = LakeConfig(root=scratch_path(spark, "partials-test"))
    schemas = partials.schemas_of(stored)
    for number, part in enumerate(["helpful_vote < 3", "helpful_vote >= 3"]):
        assert partials.add_slice(config, number, stored.where(part))
    assert not partials.add_slice(config, 1, stored)  # a slice counts once
    marts = partials.marts(partials.stored(spark, config, schemas))
    for name, rows in marts.items():
        assert all("/partials/" in f for f in rows.inputFiles()) and "merge_data" not in plan(rows)
        assert rows.exceptAll(getattr(gold, name)(stored)).count() == 0 and rows.count() == getattr(gold, name)(stored).count()
    partials.fold(spark, config, schemas)
    folded = partials.marts(partials.stored(spark, config, schemas))
    assert all(folded[name].exceptAll(marts[name]).count() == 0 for name in marts)


def test_json_is_parsed_once(spark, sf_dir):
    for name in ("silver_reviews", "silver_metadata", "raw_reviews_flatten", "raw_items_flatten", "wire_roundtrip"):  # one parse for each schema version
        assert plan(registry.QUERIES[name](spark, sf_dir)).count("from_json") == 1, name


@pytest.fixture(scope="module")
def skewed(spark):
    """Reviews of which a third are of one product, and their items, too big to broadcast."""
    session = tune(spark.newSession())
    for key, value in {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }.items():
        session.conf.set(key, value)
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500))
    reviews = session.range(0, 60_000, 1, 8).select(
        (F.col("id") % 5).cast("float").alias("rating"), F.sha2(F.col("id").cast("string"), 256).alias("review_title"),
        F.lit("x").alias("review_text"), F.lit("a").alias("product_id"), key.alias("parent_product_id"),
        F.col("id").cast("string").alias("user_id"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("int").alias("helpful_vote"), F.lit(True).alias("verified_purchase"))
    items = reviews.select("parent_product_id").distinct().select(
        F.lit("c").alias("category"), "parent_product_id", F.lit("t").alias("product_title"),
        F.lit(1.0).cast("float").alias("price"), F.lit("s").alias("store"),
        *[F.lit(None).cast("string").alias(c) for c in ("brand", "material", "style", "color")])
    path = scratch_path(spark, "skew")
    items.write.parquet(path)
    return enrich.merge_reviews(reviews, session.read.parquet(path))


def test_hot_product_join_is_split(skewed):
    assert len(skewed.collect()) == 60_000
    assert "skew=true" in plan(skewed)


def test_hot_product_join_is_split_before_grouping_by_it(skewed):
    mart = gold.mart_parent_products(skewed)
    assert {r.parent_product_id: r.total_reviews for r in mart.collect()}["hot"] == 20_000
    assert "skew=true" in plan(mart)
