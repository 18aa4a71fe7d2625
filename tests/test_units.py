"""Contracts, ids, checks, connector options and the whole historical job."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit import contracts
from plaudit.config import LakeConfig
from plaudit.functions import wire
from plaudit.functions.identifiers import content_digest, name_id, uuid7_from, uuid7_random
from plaudit.functions.times import from_millis, from_text, to_text
from plaudit.operators import checks, enrich
from plaudit.operators.sinks import jdbc_write_options, write_merge_data
from plaudit.plans import batch, registry
from plaudit.session import scratch_path
from plaudit.sources import lake, starschema
from plaudit.sources.jdbc import jdbc_options

UUID7 = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}")


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_avro_schema_round_trip():
    for struct in (contracts.MERGE, contracts.REVIEWS, contracts.METADATA):
        assert contracts.avro_to_struct(contracts.struct_to_avro(struct, "R")) == struct


def test_avro_types():
    schema = {"type": "record", "name": "R", "fields": [
        {"name": "a", "type": ["long", "null"]},
        {"name": "b", "type": {"type": "array", "items": "string"}},
        {"name": "c", "type": {"type": "map", "values": ["null", "double"]}},
        {"name": "d", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "e", "type": ["null", {"type": "record", "name": "S", "fields": [{"name": "x", "type": "bytes"}]}]},
        {"name": "timestamp", "type": ["null", "string"]},
    ]}
    assert contracts.avro_to_struct(schema) == T.StructType([
        T.StructField("a", T.LongType(), True),
        T.StructField("b", T.ArrayType(T.StringType(), False), False),
        T.StructField("c", T.MapType(T.StringType(), T.DoubleType(), True), False),
        T.StructField("d", T.TimestampType(), False),
        T.StructField("e", T.StructType([T.StructField("x", T.BinaryType(), False)]), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ])
    with pytest.raises(ValueError):
        contracts.avro_to_struct({"fields": [{"name": "u", "type": ["int", "string"]}]})


def test_ids(spark):
    ts = F.timestamp_millis(F.lit(1588687728923))
    row = one(spark, a=uuid7_from(ts, F.md5(F.lit("k"))), b=uuid7_from(ts, F.md5(F.lit("k"))),
              c=uuid7_from(ts, F.md5(F.lit("l"))), none=uuid7_from(F.lit(None).cast("timestamp"), F.md5(F.lit("k"))),
              r=uuid7_random(), store=name_id("store", F.lit("S")), category=name_id("category", F.lit("S")),
              no_store=name_id("store", F.lit(None).cast("string")))
    assert all(UUID7.fullmatch(v) for v in (row.a, row.c, row.none, row.r))
    assert row.a == row.b != row.c
    assert int(row.a.replace("-", "")[:12], 16) == 1588687728923
    assert row.store != row.category and row.no_store is None


def test_digest_keeps_fields_apart(spark):
    none = F.lit(None).cast("string")
    row = one(spark, a=content_digest(F.lit("x"), none), b=content_digest(none, F.lit("x")),
              c=content_digest(F.lit("x"), F.lit("")), d=content_digest(F.lit("xy"), F.lit("z")),
              e=content_digest(F.lit("x"), F.lit("yz")))
    assert len(set(row)) == 5
    tricky = one(spark, a=content_digest(F.lit("a\u001fb"), F.lit("c")), b=content_digest(F.lit("a"), F.lit("b\u001fc")),
                 c=content_digest(F.lit("-"), none), d=content_digest(none, F.lit("-")), e=content_digest(F.lit("1:a"), none),
                 f=content_digest(F.lit("\u0001"), none), g=content_digest(none, none))
    assert len(set(tricky)) == 7


def test_times(spark):
    row = one(spark, at=from_millis(F.lit(1588687728923)), text=to_text(from_millis(F.lit(1588687728923))),
              back=from_text(F.lit("2020-05-05 14:08:48")), bad=from_text(F.lit("5 May")),
              early=from_millis(F.lit(-1)))
    assert row.at == datetime(2020, 5, 5, 14, 8, 48) == row.back
    assert row.text == "2020-05-05 14:08:48" and row.bad is None
    assert row.early == datetime(1969, 12, 31, 23, 59, 59)
    beyond = one(spark, a=from_millis(F.lit(9223372036854775807)), b=from_millis(F.lit(10**15)),
                 c=from_millis(F.lit(-10**15)), last=to_text(from_millis(F.lit(253_402_300_799_999))))
    assert (beyond.a, beyond.b, beyond.c) == (None, None, None) and beyond.last == "9999-12-31 23:59:59"


def test_every_byte_survives_the_carrier(spark):
    payload = bytes(range(256))
    framed = wire.frame(F.lit(bytearray(payload)), 70_000)
    back = wire.from_carrier(wire.to_carrier(framed))
    row = one(spark, body=wire.body(back), schema_id=wire.schema_id(back), magic=wire.magic(back))
    assert bytes(row.body) == payload and row.schema_id == 70_000 and bytes(row.magic) == b"\x00"


def test_key_checks(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), (None,)], "k STRING")
    parent = spark.createDataFrame([("a",), ("b",)], "k STRING")
    assert [(r.k, r.n_rows) for r in checks.fk_orphans(child, parent, "k").collect()] == [("x", 2)]
    repeated = checks.pk_violations(child, ["k"]).collect()
    assert {(r.k, r.n_rows) for r in repeated} == {("a", 2), ("x", 2)}


def test_conform(spark):
    rows = spark.createDataFrame([(1, "a")], "b INT, a STRING")
    target = contracts.table("a STRING, b BIGINT")
    assert checks.conform(rows, target).dtypes == [("a", "string"), ("b", "bigint")]
    with pytest.raises(ValueError):
        checks.conform(rows, contracts.table("c STRING"))


def test_jdbc_options():
    config = LakeConfig(root="x", jdbc_url="jdbc:postgresql://h/db", jdbc_properties={"user": "u"})
    assert jdbc_options(config, "t")["user"] == "u"
    options = jdbc_write_options(config, "gold.mart_reviews", contracts.GOLD["mart_reviews"])
    assert options["dbtable"] == "gold.mart_reviews"
    assert options["createTableColumnTypes"] == "review_id VARCHAR(36)"
    with pytest.raises(ValueError):
        jdbc_options(LakeConfig(root="x"), "t")


@pytest.mark.parametrize("name", [*contracts.SILVER, *contracts.GOLD])
def test_jdbc_types_parse(spark, name):
    """Spark reads the option with its own parser, and checks the names against the rows."""
    target = (contracts.SILVER | contracts.GOLD)[name]
    config = LakeConfig(root="x", jdbc_url="jdbc:postgresql://h/db")
    types = jdbc_write_options(config, name, target).get("createTableColumnTypes")
    if types:
        parsed = T.StructType.fromDDL(types)
        assert set(parsed.fieldNames()) <= set(target.fieldNames())
        assert all(isinstance(f.dataType, (T.VarcharType, T.StringType)) for f in parsed)


def test_ids_are_unique_and_stable(spark, sf_dir):
    rows = registry.merge_data(spark, sf_dir)
    assert rows.select("review_id").distinct().count() == rows.count()
    assert rows.select("review_id").exceptAll(registry.merge_data(spark, sf_dir).select("review_id")).isEmpty()


def test_union_and_dedup_of_a_hot_duplicate(spark, sf_dir):
    rows = registry.merge_data(spark, sf_dir)
    hot = rows.orderBy("review_id").limit(1)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("n")).drop("n")
    both = enrich.union_sources(rows, rows.unionByName(copies))
    kept = enrich.dedup_reviews(both)
    assert kept.count() == rows.count()
    assert kept.where("source = 'stream'").isEmpty()


def test_marts_agree_on_totals(spark, sf_dir):
    rows = registry.merge_data(spark, sf_dir)
    total = rows.count()
    tables = batch.gold_tables(rows)
    for name in ("mart_users", "mart_parent_products", "mart_categories"):
        assert tables[name].agg(F.sum("total_reviews")).first()[0] == total
    with_store = rows.where("store IS NOT NULL").count()
    assert tables["mart_store_performance"].agg(F.sum("total_reviews")).first()[0] == with_store


def test_historical_job_twice(spark, sf_dir):
    """A rerun leaves the same tables; streamed slices beside the batch slice are kept."""
    config = LakeConfig(root=scratch_path(spark, "historical-test"))
    starschema.review_lines(spark, sf_dir).write.text(f"{config.raw}/reviews")
    starschema.item_lines(spark, sf_dir).write.text(f"{config.raw}/metadata")
    counts = batch.run_historical(spark, config)
    n = lake.read_merge_data(spark, config).count()
    users = lake.read_table(spark, config.gold("mart_users"))
    first = sorted(users.collect(), key=str)
    distinct = lake.read_merge_data(spark, config).select("review_id").distinct().count()
    assert batch.run_historical(spark, config) == counts
    assert lake.read_merge_data(spark, config).count() == n
    assert sorted(lake.read_table(spark, config.gold("mart_users")).collect(), key=str) == first
    lines = starschema.review_lines(spark, sf_dir).count()
    assert counts["reviews"]["lines"] == lines
    assert counts["reviews"]["valid"] == lake.read_reviews(spark, config).count()
    rejected = lake.read_rejected(spark, config.parsed_reviews).count()
    assert counts["reviews"]["valid"] + rejected == lines
    write_merge_data(lake.read_merge_data(spark, config), config, "stream", 7)
    batch.build_merge_data(spark, config)
    assert lake.read_merge_data(spark, config).count() == 2 * n
    assert lake.read_merge(spark, config).count() == n
    # Both paths hold the same reviews: what is published does not count them twice.
    batch.run_historical(spark, config)
    assert lake.read_published(spark, config).count() == distinct
    assert sorted(lake.read_table(spark, config.gold("mart_users")).collect(), key=str) == first


def test_broken_keys_stop_the_job(spark, sf_dir):
    config = LakeConfig(root=scratch_path(spark, "keys-test"))
    rows = registry.merge_data(spark, sf_dir)
    write_merge_data(rows, config, "batch", 0)
    batch.publish(spark, config)
    batch.build_silver(spark, config)
    batch.build_gold(spark, config)
    batch.check_keys(spark, config)
    twice = lake.read_table(spark, config.silver("dim_time")).limit(1)
    twice.write.mode("append").parquet(config.silver("dim_time"))
    with pytest.raises(ValueError, match="dim_time"):
        batch.check_keys(spark, config)


def test_queries_leave_the_session_alone(spark, sf_dir):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    registry.QUERIES["mart_users"](session, sf_dir)
    assert session.conf.get("spark.sql.adaptive.enabled") == "false"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_catalog_table_over_partitions(spark, sf_dir):
    config = LakeConfig(root=scratch_path(spark, "catalog-test"))
    rows = registry.merge_data(spark, sf_dir)
    write_merge_data(rows, config, "batch", 0)
    write_merge_data(rows, config, "stream", 1)
    lake.register_table(spark, "merged_test", config.merge_data)
    found = spark.sql("SELECT source, count(*) AS n FROM merged_test GROUP BY source").collect()
    assert {(r.source, r.n) for r in found} == {("batch", rows.count()), ("stream", rows.count())}
