"""Change streams against a plain sequential model, restarts, and landing."""

import json
import os
import random
import subprocess
import sys
from dataclasses import replace
from itertools import count

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from plaudit.config import LakeConfig, StreamConfig
from plaudit.contracts import MERGE
from plaudit.operators.validate import accepted
from plaudit.session import scratch_path
from plaudit.sources import lake
from plaudit.streaming import codec, jobs, processor
from plaudit.streaming.merge import merged_rows, spread
from plaudit.streaming.changes import events, parse_changes
from plaudit.streaming.messages import MESSAGE, kafka_sink_options, kafka_source_options

CONFIG = StreamConfig(trigger=None, state_buckets=7, lanes=3, state_partitions=4)


def review(key, name, ts, **changes):
    after = {"rating": 4.0, "title": name, "text": "x", "asin": "A" + key, "parent_asin": key, "user_id": "U",
             "timestamp": "1588687728923", "helpful_vote": 1, "verified_purchase": True, **changes}
    return message(CONFIG.reviews_topic, "c", after, ts)


def item(key, name, ts, **changes):
    after = {"main_category": "Toys", "title": name, "price": 1.5, "store": None, "brand": "B", "material": None,
             "style": None, "color": None, "parent_asin": key, **changes}
    return message(CONFIG.items_topic, "u", after, ts)


_offsets = count()


def message(topic, op, after, ts):
    value = json.dumps({"op": op, "before": None, "after": after, "ts_ms": ts})
    return (topic, 0, next(_offsets), value.encode(), None)


def write(spark, messages, path):
    spark.createDataFrame(messages, MESSAGE).write.parquet(path)


def run_merge(spark, deliveries, config=CONFIG):
    """Feed the deliveries one by one, restarting the query for each; pairs (review, item)."""
    lake_config = LakeConfig(root=scratch_path(spark, "merge-test"))
    feed, out = f"{lake_config.root}/feed", f"{lake_config.root}/out"
    for number, messages in enumerate(deliveries):
        write(spark, messages, f"{feed}/{number}")
        jobs.start_merge(spark, lake_config, config, feed, out).awaitTermination()
    messages = spark.read.parquet(out).where(F.col("topic") == config.merged_topic)
    rows = accepted(codec.decode(messages, config), MERGE)
    return sorted((r.review_title, r.product_title) for r in rows.collect())


def sequential(deliveries):
    """One message after the other, in order of time, items first at equal times."""
    known, waiting, pairs = {}, {}, []
    for messages in deliveries:
        ordered = []
        for topic, _, offset, value, _ in messages:
            event = json.loads(value)
            is_review = topic == CONFIG.reviews_topic
            ordered.append(((event["ts_ms"], is_review, offset), is_review, event["after"]))
        for _, is_review, after in sorted(ordered, key=lambda o: o[0]):
            key = after["parent_asin"]
            if not is_review:
                pairs += [(r, after["title"]) for r in waiting.pop(key, [])]
                known[key] = after["title"]
            elif key in known:
                pairs.append((after["title"], known[key]))
            else:
                waiting.setdefault(key, []).append(after["title"])
    return sorted(pairs)


def test_known_answer(spark):
    """r1, m1, m2, r2: each review once, with the item that was due."""
    messages = [review("P", "r1", 1), item("P", "m1", 2), item("P", "m2", 3), review("P", "r2", 4)]
    assert run_merge(spark, [messages]) == [("r1", "m1"), ("r2", "m2")]
    assert run_merge(spark, [[m] for m in messages]) == [("r1", "m1"), ("r2", "m2")]


def test_random_interleavings(spark):
    """One product gets a third of all reviews."""
    rng = random.Random(7)
    deliveries, ts = [], 0
    for _ in range(4):
        messages = []
        for _ in range(150):
            ts += rng.randint(0, 1)
            key = "hot" if rng.random() < 1 / 3 else f"P{rng.randrange(25)}"
            name = f"{key}-{next(_offsets)}"
            messages.append(item(key, "m" + name, ts) if rng.random() < 0.2 else review(key, "r" + name, ts))
        rng.shuffle(messages)
        deliveries.append(messages)
    assert run_merge(spark, deliveries) == sequential(deliveries)


def test_reviews_beyond_a_chunk_are_parked(spark):
    """More reviews of a group in one batch than are held in memory, with and without an item."""
    config = StreamConfig(trigger=None, lanes=2, state_partitions=2, held_rows=4)
    first = [review("P", f"r{i:03}", i) for i in range(30)]
    second = [review("P", f"r{i:03}", i) for i in range(30, 60)] + [
        item("P", f"m{i}", i) for i in range(35, 55, 2)] + [item(f"Q{i}", "m", 1) for i in range(20)]
    assert run_merge(spark, [first, second], config) == sequential([first, second])


def test_every_product_is_spread_by_one_rule(spark):
    """Also a product that becomes hot after a restart: reviews go to one lane each, items to all."""
    config = StreamConfig(trigger=None, lanes=5, state_partitions=2)
    first = [item("late", "m", 1)] + [review(f"P{i}", f"q{i}", 2) for i in range(50)]
    second = [review("late", f"r{i}", 3) for i in range(300)] + [item("P1", "m", 4)]
    changes = events(parse_changes(spark.createDataFrame(first + second, MESSAGE), config))
    rows = spread(changes, config)
    copies = {(r.parent_asin, r.is_review): (r.n, r.used) for r in rows.groupBy(
        "parent_asin", (F.col("rank") < 0).alias("is_review")).agg(
            F.count("bucket").alias("n"), F.countDistinct("bucket").alias("used")).collect()}
    assert copies["late", False] == (5, 5) and copies["P1", False] == (5, 5)
    assert copies["late", True] == (300, 5) and copies["P7", True] == (1, 1)
    deliveries = [first, second, [item("late", "m2", 6), review("late", "last", 7)]]
    assert run_merge(spark, deliveries, config) == sequential(deliveries)


def test_nothing_is_lost(spark):
    """Merged, waiting and rejected reviews are all reviews."""
    lake_config = LakeConfig(root=scratch_path(spark, "rejects-test"))
    feed, out = f"{lake_config.root}/feed", f"{lake_config.root}/out"
    write(spark, [item("P", "m", 1), review("P", "fine", 2), review("P", None, 2), review("P", "quoted", 2, rating="4"),
                  review("P", "late", 2, timestamp="9223372036854775807"), review("W", "waits", 2),
                  item("N", "m", 1, price="NaN"), item("H", "m", 1, price=1e30), review("N", "n", 2),
                  review("H", "h", 2), review("P", 5, 2)], f"{feed}/0")
    jobs.start_merge(spark, lake_config, CONFIG, feed, out).awaitTermination()
    messages = spark.read.parquet(out)
    merged = accepted(codec.decode(messages.where(F.col("topic") == CONFIG.merged_topic), CONFIG), MERGE)
    assert [r.review_title for r in merged.collect()] == ["fine"]
    rejected = codec.rejected_pairs(messages, CONFIG).collect()
    assert sorted(r.reason for r in rejected) == [
        "bad_type:price", "bad_type:price", "bad_type:rating", "bad_type:review_title", "bad_type:timestamp",
        "missing_required:review_title"]
    assert all(set(json.loads(r.value)) == {"review", "item"} for r in rejected)


class _MapState(dict):
    """A stand-in for the state of one group."""

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


def test_an_expired_chunk_is_skipped():
    logic = processor.MergeProcessor(1, 2)
    logic._heads, logic._waiting, logic._items = _MapState({("P",): (None, 2)}), _MapState({("P", 1): (["r2"],)}), _MapState()
    texts = processor._Texts(logic._items, 2)
    texts.add(("P", 1, 0), "m")
    assert list(logic._pairs({"P": [(1, 0)]}, texts, [], False)) == [("r2", "m")]
    assert logic._heads["P",] == ("m", 0) and not logic._waiting


def test_item_texts_beyond_a_chunk_are_in_state():
    state = _MapState()
    texts = processor._Texts(state, 2)
    for k in range(5):
        texts.add(("P", k, 0), f"m{k}")
    texts.add(("P", 4, 0), "m0")
    assert len(texts) == 2 and len(state) == 3
    assert [texts["P", k, 0] for k in range(5)] == ["m0", "m1", "m2", "m3", "m4"]
    texts.clear()
    assert not state


def test_rejected_changes(spark):
    reviews = CONFIG.reviews_topic
    messages = [
        (reviews, 0, 1, None, None),
        (reviews, 0, 2, b"junk", None),
        message(reviews, "d", None, 1),
        message(reviews, "c", {"title": "no key"}, 1),
        review("P", "fine", 1),
    ]
    rows = parse_changes(spark.createDataFrame(messages, MESSAGE), CONFIG).select("reason").collect()
    assert sorted(r.reason or "" for r in rows) == [
        "", "corrupt_json", "delete_event", "missing_required:parent_asin", "tombstone"]


@pytest.mark.parametrize("changes, reason", [
    ({}, None),
    ({"rating": 5}, None),
    ({"timestamp": None}, None),
    ({"title": None}, "missing_required:review_title"),
    ({"rating": "5"}, "bad_type:rating"),
    ({"helpful_vote": 3000000000}, "bad_type:helpful_vote"),
    ({"timestamp": "None"}, "bad_type:timestamp"),
    ({"timestamp": "9223372036854775807"}, "bad_type:timestamp"),
    ({"timestamp": 10**15}, "bad_type:timestamp"),
    ({"title": 5}, "bad_type:review_title"),
])
def test_merged_contract(spark, changes, reason):
    after = json.loads(review("P", "r", 1, **changes)[3])["after"]
    other = json.loads(item("P", "m", 1)[3])["after"]
    pairs = spark.createDataFrame([(json.dumps(after), json.dumps(other))], "review STRING, item STRING")
    (row,) = merged_rows(pairs).collect()
    assert row.reason == reason


def _merged(spark, n):
    pairs = [(json.dumps(json.loads(review("P", f"r{i}", 1, text="naïve — 値")[3])["after"]),
              json.dumps(json.loads(item("P", "m", 1)[3])["after"])) for i in range(n)]
    return accepted(merged_rows(spark.createDataFrame(pairs, "review STRING, item STRING")), MERGE)


def test_wire_round_trip_and_bad_values(spark):
    rows = _merged(spark, 3)
    values = codec.encode(rows, CONFIG)
    junk = spark.createDataFrame([(b"\xff\xfe",), (b"\x00",), ("値".encode(),), (b"\x00\x00\x00\x00\x01{",), (None,)],
                                 "value BINARY")
    decoded = codec.decode(values.unionByName(junk), CONFIG)
    assert accepted(decoded, MERGE).exceptAll(rows).count() == 0
    assert accepted(decoded, MERGE).count() == 3
    bad = sorted(r.reason for r in decoded.where("reason IS NOT NULL").collect())
    assert bad == ["bad_frame"] * 4 + ["corrupt_json"]


def test_frames_of_another_schema_come_back(spark):
    rows = _merged(spark, 2)
    foreign = codec.encode(rows, replace(CONFIG, schema_id=99))
    decoded = codec.decode(foreign, CONFIG).collect()
    assert [r.reason for r in decoded] == ["unknown_schema"] * 2 and all(r.review_title is None for r in decoded)


def test_landing_rejects_what_would_not_fit(spark):
    values = ['{"rating": 1, "price": 1e30}', '{"rating": 1e39}']
    framed = [b"\x00\x00\x00\x00\x01" + v.encode() for v in values]
    rows = codec.decode(spark.createDataFrame([(f,) for f in framed], "value BINARY"), CONFIG).collect()
    assert all(r.reason is not None for r in rows)


def test_landing_is_idempotent(spark):
    """The same batch written again replaces itself; a restart goes on after the last batch."""
    config = LakeConfig(root=scratch_path(spark, "landing-test"))
    feed = f"{config.root}/feed"
    for number, n in enumerate([4, 3]):
        values = codec.encode(_merged(spark, n), CONFIG).collect()
        write(spark, [(CONFIG.merged_topic, 0, i, bytes(r.value), None) for i, r in enumerate(values)],
              f"{feed}/{number}")
        jobs.start_landing(spark, config, CONFIG, feed).awaitTermination()
    landed = lake.read_merge_data(spark, config)
    assert landed.count() == 7
    ids = {r.review_id for r in landed.collect()}
    copies = {r.review_id for r in spark.read.parquet(config.streaming).collect()}
    assert ids == copies
    # The query runs again from the start, as after a lost checkpoint: the slices are replaced.
    again = LakeConfig(root=config.root)
    object.__setattr__(again, "checkpoint", lambda query: f"{config.root}/other/{query}")
    jobs.start_landing(spark, again, CONFIG, f"{feed}/0").awaitTermination()
    assert lake.read_merge_data(spark, config).count() == 7


def test_kafka_options():
    config = StreamConfig(source="kafka", bootstrap_servers="broker:9092")
    options = kafka_source_options(config, [config.reviews_topic, config.items_topic])
    assert options["subscribe"] == "test.public.raw_reviews,test.public.raw_item_metadata"
    assert options["startingOffsets"] == "earliest"
    assert "topic" not in kafka_sink_options(config)  # each message names its own
    assert config.rejected_topic == "merge_metadata_reviews.rejected"


def test_state_logic_travels_without_the_package(tmp_path):
    """An executor that has no copy of this package can still run the merge."""
    state = tmp_path / "processor.pickle"
    state.write_bytes(cloudpickle.dumps(processor.MergeProcessor(None, 5)))
    code = ("import sys, importlib.util; from pyspark import cloudpickle\n"
            "p = cloudpickle.loads(open(sys.argv[1], 'rb').read())\n"
            "assert importlib.util.find_spec('plaudit') is None\n"
            "print(list(p._framed(iter([('r', 'i')])))[0].columns.tolist())")
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, str(state)], cwd=tmp_path, capture_output=True, text=True, env=clean)
    assert "['review', 'item']" in done.stdout, done.stderr
