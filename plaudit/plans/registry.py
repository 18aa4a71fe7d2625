"""Every published query by name, over a folder of star-schema Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.config import LakeConfig, StreamConfig
from plaudit.contracts import GOLD, MERGE, METADATA, RAW_ITEMS, RAW_REVIEWS, REVIEWS, SILVER
from plaudit.functions import times
from plaudit.functions.identifiers import uuid7_random
from plaudit.operators import checks, enrich, ingest, upsert
from plaudit.operators.sinks import write_merge_data, write_table
from plaudit.operators.validate import accepted, rejected
from plaudit.plans import batch, gold, partials, silver
from plaudit.session import freeing_shuffles, in_utc, measured_session, scratch_path
from plaudit.sources import lake, starschema
from plaudit.sources.lines import is_item_file, read_lines
from plaudit.streaming import changes, codec, jobs, replay, versions

LOADED_AT = "2024-01-01 00:00:00"
STREAMS = StreamConfig(trigger=None, state_buckets=256, state_partitions=8)

Query = Callable[[SparkSession, str], DataFrame]


def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.merge_reviews(starschema.reviews(spark, sf_dir), starschema.items(spark, sf_dir))


def merge_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.add_ids(merge(spark, sf_dir))


def _on_merge_data(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(merge_data(spark, sf_dir))


# --- raw lines -------------------------------------------------------------------------------

def silver_reviews(spark, sf_dir):
    return accepted(ingest.parse_reviews(starschema.review_lines(spark, sf_dir)), REVIEWS)


def silver_metadata(spark, sf_dir):
    return accepted(ingest.parse_items(starschema.item_lines(spark, sf_dir)), METADATA)


def quarantine_reviews(spark, sf_dir):
    return rejected(ingest.parse_reviews(starschema.review_lines(spark, sf_dir)))


def quarantine_metadata(spark, sf_dir):
    return rejected(ingest.parse_items(starschema.item_lines(spark, sf_dir)))


def ingest_counts(spark, sf_dir):
    def counted(parsed, entity):
        return parsed.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome")).agg(
            F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("n_lines"))

    reviews = ingest.parse_reviews(starschema.review_lines(spark, sf_dir))
    items = ingest.parse_items(starschema.item_lines(spark, sf_dir))
    return counted(reviews, "reviews").unionByName(counted(items, "metadata"))


def _listed(rows: DataFrame) -> DataFrame:
    """Arrays as text, which every engine prints alike."""
    lists = [name for name, kind in rows.dtypes if kind.startswith("array")]
    return rows.withColumns({name: F.array_join(name, " ") for name in lists})


def raw_reviews_flatten(spark, sf_dir):
    lines = starschema.review_lines(spark, sf_dir)
    return _listed(accepted(ingest.flatten_reviews(lines, F.lit(LOADED_AT)), RAW_REVIEWS))


def raw_tables_landed(spark, sf_dir):
    """The flattened raw tables as a job lands them, read back: rows and what they hold, by outcome."""
    config = LakeConfig(root=scratch_path(spark, "raw-tables"))
    _write_raw(spark, sf_dir, config.root)
    batch.land_raw(spark, config)

    def counted(name, number, images):
        rows = lake.read_table(spark, config.raw_table(name))
        return rows.groupBy("status").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count(number).alias("n_numbers"), F.sum(F.size(images)).alias("n_images"))

    return counted("raw_reviews", "rating", "small_image_urls").unionByName(
        counted("raw_item_metadata", "price", "large_images"))


def raw_items_flatten(spark, sf_dir):
    lines = starschema.item_lines(spark, sf_dir)
    return _listed(accepted(ingest.flatten_items(lines, F.lit(LOADED_AT)), RAW_ITEMS))


def _write_raw(spark, sf_dir, root):
    """Raw files as they arrive: packed, and of bounded length, as a packed file is read by one task."""
    for kind, lines in {"reviews": starschema.review_lines, "metadata": starschema.item_lines}.items():
        with freeing_shuffles(spark):
            lines(spark, sf_dir).write.option("maxRecordsPerFile", 250_000).text(
                f"{root}/bronze/raw/{kind}", compression="gzip")


def path_routing(spark, sf_dir):
    """Lines per entity of a folder tree that holds both kinds of files."""
    root = scratch_path(spark, "routing")
    _write_raw(spark, sf_dir, root)
    entity = F.when(is_item_file(F.col("path")), "metadata").otherwise("reviews")
    lines = read_lines(spark, f"{root}/bronze/raw")
    return lines.groupBy(entity.alias("entity")).agg(F.count(F.lit(1)).alias("n_lines"))


def merge_from_lines(spark, sf_dir):
    spark = measured_session(spark)
    return enrich.merge_reviews(silver_reviews(spark, sf_dir), silver_metadata(spark, sf_dir))


def historical_store_mart(spark, sf_dir):
    """The whole historical job: raw files, lake tables, marts; the store mart as published."""
    config = LakeConfig(root=scratch_path(spark, "historical"))
    _write_raw(spark, sf_dir, config.root)
    batch.run_historical(spark, config)
    return lake.read_table(spark, config.gold("mart_store_performance"))


# --- canonical table ---------------------------------------------------------------------------

def union_batch_stream(spark, sf_dir):
    rows = merge_data(spark, sf_dir)
    return enrich.union_sources(rows, rows)


def dedup_reviews(spark, sf_dir):
    """Ids are made here, of content that has the product, by which the join has dealt the rows of both paths."""
    return enrich.dedup_reviews(union_batch_stream(spark, sf_dir), within=["parent_product_id"])


def merge_bucketed(spark, sf_dir):
    """The join over tables stored in buckets of product and lane: no shuffle, and no bucket has all of a hot product."""
    path, lanes = scratch_path(spark, "bucketed"), 4
    sides = enrich.lanes_of(starschema.reviews(spark, sf_dir), starschema.items(spark, sf_dir), lanes)
    tables = []
    for kind, rows in zip(("reviews", "items"), sides):
        name = f"{kind}_{path[-32:]}"
        lake.write_bucketed(rows, name, f"{path}/{kind}", ["parent_product_id", "lane"], 16)
        tables.append(spark.table(name))
    reviews, items = tables
    joined = reviews.join(items, ["parent_product_id", "lane"]).select(*MERGE.fieldNames())
    joined.schema  # resolved with its buckets; the entries can go, the files stay
    for kind in ("reviews", "items"):
        spark.sql(f"DROP TABLE {kind}_{path[-32:]}")
    return joined


def latest_items(spark, sf_dir):
    """Two versions per item; the newer one wins."""
    items = starschema.items(spark, sf_dir)
    newer = items.withColumn("product_title", F.concat("product_title", F.lit(" v2")))
    versions = items.withColumn("version", F.lit(1)).unionByName(newer.withColumn("version", F.lit(2)))
    return enrich.latest_items(versions, F.col("version"))


def merge_fans_out(spark, sf_dir):
    """Items listed twice: each review appears with both."""
    items = starschema.items(spark, sf_dir)
    return enrich.merge_reviews(starschema.reviews(spark, sf_dir), items.unionByName(items))


def uuid7_ids(spark, sf_dir):
    """Random ids: how many, how many differ, how many have version 7 and the right variant.

    They are stored before they are counted: a task that is repeated would draw other ids.
    """
    path = scratch_path(spark, "uuid7")
    write_table(starschema.reviews(spark, sf_dir).select(uuid7_random().alias("id")), path, LakeConfig(path))
    per_id = lake.read_table(spark, path).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    shape = F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return per_id.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), F.count_if(shape).alias("n_well_formed"))


def review_preview(spark, sf_dir):
    """First 20 reviews with their ids."""
    columns = ["review_id", "store_id", "category_id"]
    return merge_data(spark, sf_dir).select(*columns).orderBy(*columns).limit(20)


# --- checks ------------------------------------------------------------------------------------

def _stored(spark, sf_dir):
    """The canonical table as a lake table, so that each check reads only the columns it needs."""
    config = LakeConfig(root=scratch_path(spark, "stored"))
    with freeing_shuffles(spark):
        write_merge_data(merge_data(spark, sf_dir), config, "batch", 0)
    return lake.read_merge_data(spark, config)


def pk_violations(spark, sf_dir):
    rows = _stored(spark, sf_dir)
    grouped = {**gold.gold_tables(rows), "dim_products": silver.dim_products(rows)}
    return checks.derived_key_report(rows, {n: t for n, t in grouped.items() if n != "mart_reviews"})


def fk_orphans(spark, sf_dir):
    return checks.foreign_key_report(silver.silver_tables(_stored(spark, sf_dir)))


def key_report_both_paths(spark, sf_dir):
    """Keys of the published tables when the same reviews came by both paths."""
    config = LakeConfig(root=scratch_path(spark, "both"))
    rows = merge_data(spark, sf_dir)
    for source in ("batch", "stream"):
        with freeing_shuffles(spark):
            write_merge_data(rows, config, source, 0)
    batch.publish(spark, config)
    batch.build_silver(spark, config)
    batch.build_gold(spark, config)
    paths = {**{n: config.silver(n) for n in SILVER}, **{n: config.gold(n) for n in GOLD}}
    return checks.primary_key_report({n: lake.read_table(spark, path) for n, path in paths.items()})


def natural_key_duplicates(spark, sf_dir):
    return checks.pk_violations(starschema.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphan_products(spark, sf_dir):
    """Reviewed products that no valid item line describes."""
    spark = measured_session(spark)
    return checks.fk_orphans(starschema.reviews(spark, sf_dir), silver_metadata(spark, sf_dir),
                             "parent_product_id")


# --- aggregates behind the marts -----------------------------------------------------------------

def user_category_counts(spark, sf_dir):
    rows = gold.user_categories(merge(spark, sf_dir))
    return rows.select("user_id", "category", F.col("n").alias("category_count"))


_MART_KEYS = {"mart_users": "user_id", "mart_parent_products": "parent_product_id", "mart_categories": "category_name",
              "mart_store_performance": "store_name"}
_MART_VALUES = {
    "total_reviews": "BIGINT", "avg_rating": "DOUBLE", "total_helpful_votes": "BIGINT", "total_buy_products": "BIGINT",
    "total_sell_products": "BIGINT", "total_products": "BIGINT", "verified_purchases": "BIGINT", "total_revenue": "DOUBLE",
    "top_category": "STRING", "first_review_date": "TIMESTAMP", "last_review_date": "TIMESTAMP",
}


def marts_incremental(spark, sf_dir):
    """Rows of four marts, made of the partial aggregates of three slices, two of them added up before the third came."""
    config = LakeConfig(root=scratch_path(spark, "partials"))
    rows = _stored(spark, sf_dir)
    schemas = partials.schemas_of(rows)
    for number, part in enumerate(["verified_purchase", "helpful_vote > 3", "helpful_vote <= 3"]):
        own = rows.where(part if number == 0 else f"NOT verified_purchase AND {part}")
        partials.add_slice(config, number, own)
        if number == 1:
            partials.fold(spark, config, schemas)
    marts = partials.marts(partials.stored(spark, config, schemas))
    return reduce(DataFrame.unionByName, [
        mart.select(F.lit(name).alias("mart"), F.col(_MART_KEYS[name]).alias("key"), *[
            (F.col(c) if c in mart.columns else F.lit(None)).cast(kind).alias(c) for c, kind in _MART_VALUES.items()])
        for name, mart in marts.items()])


def verified_counts(spark, sf_dir):
    """Verified purchases per user, product and category in one pass; keys without one count zero."""
    keys = ("user_id", "parent_product_id", "category")
    kinds = F.create_map(*[c for key in keys for c in (F.lit(key), F.col(key))])
    rows = merge(spark, sf_dir).select("verified_purchase", F.explode(kinds).alias("key_kind", "key"))
    return rows.groupBy("key_kind", "key").agg(F.count_if("verified_purchase").alias("verified"))


def distinct_products(spark, sf_dir):
    return merge(spark, sf_dir).groupBy("category").agg(
        F.count_distinct("parent_product_id").alias("total_products"))


def top_stores(spark, sf_dir):
    return gold.top_stores(gold.mart_store_performance(merge(spark, sf_dir)), 10)


def _by_catalog(spark, sf_dir, sql: str) -> DataFrame:
    """SQL over the canonical table, laid out by year, through the catalog, which keeps the entry: it has the partitions."""
    path = scratch_path(spark, "catalog")
    columns = ["category", "timestamp", "user_id", "helpful_vote", "verified_purchase"]
    lake.write_by_year(merge(spark, sf_dir).select(*columns), path, LakeConfig(root=path))
    name = "merge_data_" + path[-32:]
    lake.register_table(spark, name, path)
    return spark.sql(sql.format(table=name))


def catalog_sql(spark, sf_dir):
    """Free SQL over the canonical table through the catalog."""
    return _by_catalog(spark, sf_dir, """
        SELECT category, review_year, count(*) AS total_reviews,
               count(DISTINCT user_id) AS total_users, max(helpful_vote) AS most_votes
        FROM {table} WHERE verified_purchase GROUP BY category, review_year""")


def catalog_years(spark, sf_dir):
    """SQL over some years of it, which opens the files of these years alone."""
    return _by_catalog(spark, sf_dir, """
        SELECT review_year, category, count(*) AS total_reviews, count_if(verified_purchase) AS bought
        FROM {table} WHERE review_year BETWEEN 1995 AND 1996 GROUP BY review_year, category""")


# --- scalar functions ----------------------------------------------------------------------------

def epoch_millis_ts(spark, sf_dir):
    """Event times through epoch milliseconds, floored to the second, and through text and back."""
    events = starschema.table(spark, sf_dir, "events")
    at = times.from_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    return events.select(
        "event_id", at.alias("at"), times.to_text(at).alias("at_text"),
        times.from_text(times.to_text(at)).alias("back"),
        *[part.alias(name) for name, part in times.calendar(at).items()])


def event_props(spark, sf_dir):
    """JSON property of each event as a number."""
    events = starschema.table(spark, sf_dir, "events")
    return events.select("event_id", "event_type",
                         F.from_json("props", "k INT").getField("k").alias("k"))


def wire_roundtrip(spark, sf_dir):
    """Merged rows framed, carried as text, unframed and parsed; frames of another schema come back with a reason."""
    rows = merge(spark, sf_dir)
    messages = codec.encode(rows, STREAMS).unionByName(
        codec.encode(rows.where("helpful_vote = 7"), replace(STREAMS, schema_id=99)))
    return codec.decode(messages, STREAMS).select(*MERGE.fieldNames(), "reason")


def _other_versions() -> dict[int, dict]:
    """Records as others write them: before some fields were there, with one field more, and one that cannot be read."""
    current = codec.record_schema()
    fields = {f["name"]: f for f in current["fields"]}
    older = [fields[n] for n in fields if n not in ("rating", "helpful_vote", "brand")]
    newer = [f for n, f in fields.items() if n != "verified_purchase"]
    return {
        1: current,
        2: {**current, "fields": [{"name": "rating", "type": "int"}, *older]},
        3: {**current, "fields": [*newer, {"name": "helpful_share", "type": "double"}]},
        4: {**current, "fields": [f for n, f in fields.items() if n != "review_title"]},
    }


def wire_versions(spark, sf_dir):
    """Frames of four schema versions, which a table of schemas tells, and of an unknown one, read by the current schema."""
    config = LakeConfig(root=scratch_path(spark, "versions"))
    for schema_id, schema in _other_versions().items():
        versions.register_schema(spark, config, STREAMS.merged_topic, schema_id, schema)
    known = versions.read_schemas(spark, config, STREAMS.merged_topic)
    rows = merge(spark, sf_dir).withColumn("helpful_share", F.col("helpful_vote") / 7)
    parts = {1: "helpful_vote <= 2", 2: "helpful_vote IN (3, 4)", 3: "helpful_vote = 5", 4: "helpful_vote = 6",
             99: "helpful_vote = 7"}
    messages = reduce(DataFrame.unionByName, [
        codec.encode(rows.where(part), replace(STREAMS, schema_id=schema_id), known.get(schema_id))
        for schema_id, part in parts.items()])
    return codec.decode(messages, STREAMS, known).select(*MERGE.fieldNames(), "reason")


# --- change streams --------------------------------------------------------------------------------

def cdc_envelope_parse(spark, sf_dir):
    rows = changes.parse_changes(starschema.change_messages(spark, sf_dir, STREAMS), STREAMS)
    return rows.select("topic", "op", "source_table", "has_before", "parent_asin", "ts_ms", "partition", "offset",
                       "reason")


def cdc_rejects(spark, sf_dir):
    """Deletes and messages without a value, as the streaming query writes them."""
    config = LakeConfig(root=scratch_path(spark, "rejects"))
    feed = f"{config.root}/feed"
    starschema.deliver(starschema.change_messages(spark, sf_dir, STREAMS), feed, "all")
    jobs.start_rejects(spark, config, STREAMS, feed).awaitTermination()
    return spark.read.parquet(config.path("quarantine", "changes"))


def _merged_messages(spark, sf_dir, deliveries=("step <= 2", "step > 2"), layouts=(STREAMS,)):
    """What the keyed enrichment sends for the deliveries, resumed from its checkpoint for each.

    The last delivery goes to the last layout, if there are several, and so on back to the first.
    """
    config = LakeConfig(root=scratch_path(spark, "merge"))
    feed = f"{config.root}/feed"
    messages = starschema.change_messages(spark, sf_dir, STREAMS)
    previous, at = None, layouts[0]
    for number, steps in enumerate(deliveries):
        starschema.deliver(messages.where(steps), feed, f"delivery-{number}")
        now = layouts[max(0, len(layouts) - len(deliveries) + number)]
        if now is not at:
            previous, at = at, now
        jobs.start_merge(spark, config, at, feed, f"{config.root}/merged-{at.layout}", previous).awaitTermination()
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{config.root}/merged-{s.layout}") for s in layouts])


def stream_merge(spark, sf_dir):
    """The enriched reviews."""
    messages = _merged_messages(spark, sf_dir).where(F.col("topic") == STREAMS.merged_topic)
    return accepted(codec.decode(messages, STREAMS), MERGE)


def merge_rejects(spark, sf_dir):
    """Pairs that break the merged contract, with the reason."""
    rows = codec.rejected_pairs(_merged_messages(spark, sf_dir), STREAMS)
    sides = F.from_json("value", "review STRING, item STRING")
    return rows.select(F.get_json_object(sides["review"], "$.text").alias("review_text"),
                       F.get_json_object(sides["item"], "$.title").alias("product_title"), "reason")


def merge_after_relayout(spark, sf_dir):
    """The enriched reviews when the second delivery is merged by another number of lanes, buckets and partitions."""
    other = replace(STREAMS, layout=1, lanes=3, state_buckets=97, state_partitions=12)
    messages = _merged_messages(spark, sf_dir, layouts=(STREAMS, other)).where(F.col("topic") == STREAMS.merged_topic)
    return accepted(codec.decode(messages, STREAMS), MERGE)


def expired_reviews(spark, sf_dir):
    """Reviews that waited in vain for one delivery, after which their time was over."""
    impatient = replace(STREAMS, state_ttl_ms=1)
    messages = _merged_messages(spark, sf_dir, ("step = 1", "step = 2", "step > 2"), (impatient,))
    rows = codec.rejected_pairs(messages, STREAMS).where("reason = 'no_item'")
    return rows.select(F.get_json_object(F.get_json_object("value", "$.review"), "$.text").alias("review_text"), "reason")


def _deliver_merged(rows: DataFrame, feed: str, delivery: str, at: str | None = None) -> None:
    starschema.deliver(
        codec.encode(rows, STREAMS).select(
            F.lit(STREAMS.merged_topic).alias("topic"), F.lit(0).alias("partition"),
            F.lit(None).cast("bigint").alias("offset"), "value", F.lit(at).cast("timestamp").alias("timestamp")),
        feed, delivery)


def stream_to_lake(spark, sf_dir):
    """Merged messages landed in the canonical table in two micro-batches."""
    config = LakeConfig(root=scratch_path(spark, "landing"))
    feed = f"{config.root}/feed"
    rows = merge(spark, sf_dir)
    for delivery, part in {"bought": "verified_purchase", "other": "NOT verified_purchase"}.items():
        _deliver_merged(rows.where(part), feed, delivery)
        jobs.start_landing(spark, config, STREAMS, feed).awaitTermination()
    return lake.read_merge_data(spark, config)


class _Interrupted(Exception):
    pass


def compacted_merge_data(spark, sf_dir):
    """The landed table after a compaction that fails before it is published and is made again, more micro-batches,
    and a second compaction."""
    config = LakeConfig(root=scratch_path(spark, "compacted"), use_manifest=True)
    streams = replace(STREAMS, max_files_per_trigger=3)
    feed = f"{config.root}/feed"
    rows = merge(spark, sf_dir)

    def interrupt():
        raise _Interrupted

    for delivery, part in {"bought": "verified_purchase", "other": "NOT verified_purchase"}.items():
        _deliver_merged(rows.where(part).repartition(8), feed, delivery)
        jobs.start_landing(spark, config, streams, feed).awaitTermination()
        try:
            jobs.compact_landed(spark, config, before_publishing=interrupt)
        except _Interrupted:
            jobs.compact_landed(spark, config)
    return lake.read_merge_data(spark, config)


def landing_dedup(spark, sf_dir):
    """Messages that the topic holds several times: copies within ten minutes land once, later ones land again.

    What is bought comes twice at once, and in part again with the rest five minutes later; a part of the rest comes after
    two hours, and after that some of what was bought once more.
    """
    config = LakeConfig(root=scratch_path(spark, "landing-dedup"))
    streams = replace(STREAMS, dedup_window="10 minutes", dedup_clock="timestamp")
    feed = f"{config.root}/feed"
    rows = merge(spark, sf_dir)
    bought, late = rows.where("verified_purchase"), F.col("helpful_vote") == 2
    rest = rows.where("NOT verified_purchase")
    deliveries = {
        "2024-01-01 00:00:00": bought.unionByName(bought),
        "2024-01-01 00:05:00": rest.where(~late).unionByName(bought.where("helpful_vote > 2")),
        "2024-01-01 02:00:00": rest.where(late),
        "2024-01-01 02:05:00": bought.where("helpful_vote = 1"),
    }
    for number, (at, part) in enumerate(deliveries.items()):
        _deliver_merged(part, feed, str(number), at)
        jobs.start_landing(spark, config, streams, feed).awaitTermination()
    return lake.read_merge_data(spark, config)


def current_items(spark, sf_dir):
    """Items as two deliveries of changes leave them; some are deleted, and some of the first changes come once more."""
    config = LakeConfig(root=scratch_path(spark, "current"))
    feed = f"{config.root}/feed"
    items = starschema.change_messages(spark, sf_dir, STREAMS).where(F.col("topic") == STREAMS.items_topic)
    deleted = starschema.table(spark, sf_dir, "part").where("p_size = 48").select(
        F.lit(STREAMS.items_topic).alias("topic"), F.lit(0).alias("partition"),
        F.expr("CAST(p_partkey * 16 + 9 AS BIGINT)").alias("offset"),
        F.to_json(F.struct(F.lit("d").alias("op"), F.struct(F.col("p_partkey").cast("string").alias("parent_asin")).alias(
            "before"), F.lit(9).alias("ts_ms"))).cast("binary").alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    late = deleted.unionByName(items.where("step > 4 OR step = 2").drop("step"))
    for delivery, messages in {"early": items.where("step <= 4"), "late": late}.items():
        starschema.deliver(messages, feed, delivery)
        jobs.start_current_items(spark, config, STREAMS, feed).awaitTermination()
    return upsert.read_current(spark, config.current_items, METADATA)


def _archived(spark, sf_dir):
    config = LakeConfig(root=scratch_path(spark, "archive"))
    feed = f"{config.root}/feed"
    starschema.deliver(starschema.change_messages(spark, sf_dir, STREAMS), feed, "all")
    jobs.start_archive(spark, config, STREAMS, feed).awaitTermination()
    return config


def cdc_archive(spark, sf_dir):
    """Archived change lines with the topic and partition they are filed under."""
    return spark.read.text(_archived(spark, sf_dir).archive).select("topic", "partition", "value")


def replay_merge(spark, sf_dir):
    """The enriched reviews again, from the archive alone."""
    return accepted(replay.replay_merge(spark, _archived(spark, sf_dir), STREAMS), MERGE)


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(in_utc(spark), sf_dir)


_QUERIES: dict[str, Query] = {
    "silver_reviews": silver_reviews,
    "silver_metadata": silver_metadata,
    "quarantine_reviews": quarantine_reviews,
    "quarantine_metadata": quarantine_metadata,
    "ingest_counts": ingest_counts,
    "raw_reviews_flatten": raw_reviews_flatten,
    "raw_items_flatten": raw_items_flatten,
    "raw_tables_landed": raw_tables_landed,
    "path_routing": path_routing,
    "merge_batch_inner": merge,
    "merge_from_lines": merge_from_lines,
    "merge_fans_out": merge_fans_out,
    "merge_bucketed": merge_bucketed,
    "merge_data_ids": merge_data,
    "uuid7_ids": uuid7_ids,
    "review_preview": review_preview,
    "union_batch_stream": union_batch_stream,
    "dedup_reviews": dedup_reviews,
    "latest_items": latest_items,
    "dim_time": _on_merge_data(silver.dim_time),
    "dim_reviews": _on_merge_data(silver.dim_reviews),
    "dim_products": _on_merge_data(silver.dim_products),
    "fact_reviews": _on_merge_data(silver.fact_reviews),
    "pk_violations": pk_violations,
    "fk_orphans": fk_orphans,
    "key_report_both_paths": key_report_both_paths,
    "natural_key_duplicates": natural_key_duplicates,
    "orphan_products": orphan_products,
    "mart_users": _on_merge_data(gold.mart_users),
    "mart_parent_products": _on_merge_data(gold.mart_parent_products),
    "mart_categories": _on_merge_data(gold.mart_categories),
    "mart_store_performance": _on_merge_data(gold.mart_store_performance),
    "mart_reviews": _on_merge_data(gold.mart_reviews),
    "marts_incremental": marts_incremental,
    "top_stores": top_stores,
    "top_category_per_user": _on_merge_data(gold.top_category_per_user),
    "user_category_counts": user_category_counts,
    "verified_counts": verified_counts,
    "distinct_products": distinct_products,
    "catalog_sql": catalog_sql,
    "catalog_years": catalog_years,
    "historical_store_mart": historical_store_mart,
    "epoch_millis_ts": epoch_millis_ts,
    "event_props": event_props,
    "wire_roundtrip": wire_roundtrip,
    "wire_versions": wire_versions,
    "cdc_envelope_parse": cdc_envelope_parse,
    "cdc_rejects": cdc_rejects,
    "stream_merge": stream_merge,
    "merge_rejects": merge_rejects,
    "merge_after_relayout": merge_after_relayout,
    "expired_reviews": expired_reviews,
    "stream_to_lake": stream_to_lake,
    "landing_dedup": landing_dedup,
    "compacted_merge_data": compacted_merge_data,
    "cdc_archive": cdc_archive,
    "replay_merge": replay_merge,
    "current_items": current_items,
}

QUERIES: dict[str, Query] = {name: _tuned(query) for name, query in _QUERIES.items()}
