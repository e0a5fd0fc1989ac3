import json

import pytest
from pyspark.sql import functions as F

from logstow.config import ArchiveConfig, ConfigError, drop_trailing_slash, split_list
from logstow.functions.names import (
    normalize_prefix,
    object_key,
    object_name_fields,
    payload_size,
    record_key,
    record_key_fields,
)
from logstow.operators.metrics import archive_gauges, partition_counters
from logstow.operators.topics import (
    configured_partitions,
    enumerate_partitions,
    select_topics,
    with_gap_policy,
)
from logstow.plans.daemon import main
from logstow.sources import kafka

ARCHIVE = {
    "s3.accesskey": "a",
    "s3.secretkey": "b",
    "s3.bucket": "bucket",
    "s3.prefix": "some/prefix//",
    "kafka.topics": "t1,t2, t3,t1,,",
}


def test_defaults():
    c = ArchiveConfig.from_properties(ARCHIVE)
    assert c.topics == {"t1", "t2", " t3"}
    assert c.prefix == "some/prefix/"
    assert c.base_uri == "s3a://bucket/some/prefix/"
    assert c.ignore_gaps_topics == frozenset()
    assert (c.max_message_bytes, c.min_chunk_bytes, c.max_commit_interval_ms) == (
        65536, 268435456, 86400000
    )
    assert c.bootstrap_servers == "localhost:9092"
    rule = c.chunk_rule(5, 9)
    assert (rule.max_bytes, rule.interval_ms, rule.run_start_ms, rule.now_ms) == (
        268435456, 86400000, 5, 9
    )


def test_broker_settings():
    broker = {
        "brokerid": "7", "hostname": "h", "port": "0", "num.partitions": "3",
        "topic.partition.count.map": "t1:5,t2:0",
    }
    c = ArchiveConfig.from_properties({**ARCHIVE, "kafka.ignoregaps": "t2"}, broker)
    assert (c.broker_id, c.bootstrap_servers, c.default_partitions) == (7, "h:9092", 3)
    assert c.partition_counts == {"t1": 5, "t2": 0}
    assert c.ignore_gaps_topics == {"t2"}


@pytest.mark.parametrize("name", sorted(ARCHIVE))
@pytest.mark.parametrize("value", [None, ""])
def test_required_settings(name, value):
    props = {**ARCHIVE, name: value}
    with pytest.raises(ConfigError, match=f"Invalid property {name}"):
        ArchiveConfig.from_properties(props)


@pytest.mark.parametrize(
    "name, value",
    [
        ("kafka.maxmessagesize", "2147483648"),
        ("s3.maxcommitinterval", "2147483648"),
        ("s3.mintotalmessagesizeperchunk", "1k"),
        ("s3.mintotalmessagesizeperchunk", " 5"),
        ("s3.mintotalmessagesizeperchunk", "9223372036854775808"),
    ],
)
def test_numbers_out_of_range(name, value):
    with pytest.raises(ConfigError):
        ArchiveConfig.from_properties({**ARCHIVE, name: value})


def test_lists_and_slashes():
    assert split_list("") == {""}
    assert split_list(",") == frozenset()
    assert split_list(",a") == {"", "a"}
    assert drop_trailing_slash("a//") == "a/"
    assert drop_trailing_slash("a") == "a"


def test_properties_file(spark, tmp_path):
    path = tmp_path / "archiver.properties"
    path.write_text(
        "# topics\nkafka.topics=t1,\\\n   t2\ns3.accesskey = k\ns3.secretkey:s\n"
        "s3.bucket=b\ns3.prefix=p/\n!s3.maxcommitinterval=5\n"
    )
    c = ArchiveConfig.load(spark, str(path))
    assert c.topics == {"t1", "t2"}
    assert (c.prefix, c.max_commit_interval_ms) == ("p", 86400000)


def test_wrong_argument_count(capsys):
    assert main(["one"]) == 2
    assert "usage" in capsys.readouterr().err


def test_partitions(spark):
    topics = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "topic string")
    overrides = spark.createDataFrame([("a", 3), ("b", 0)], "topic string, partition_count int")
    parts = enumerate_partitions(topics, overrides, 2, 9)
    got = {(r.topic, r.broker_id, r.partition_id) for r in parts.collect()}
    assert got == {("a", 9, 0), ("a", 9, 1), ("a", 9, 2), ("c", 9, 0), ("c", 9, 1)}
    assert enumerate_partitions(topics, overrides, -1, 9).count() == 3
    policy = {r.topic: r.ignore_gaps for r in with_gap_policy(parts, ["c"]).collect()}
    assert policy == {"a": False, "c": True}
    totals = {r.topic: r.total_partitions for r in archive_gauges(parts).collect()}
    assert totals == {"a": 3, "c": 2, None: 5}
    c = ArchiveConfig.from_properties(
        {**ARCHIVE, "kafka.ignoregaps": "t2"}, {"topic.partition.count.map": "t1:2"}
    )
    assert configured_partitions(spark, c).count() == 4


def test_topic_filter_reaches_the_scan(spark, tmp_path):
    rows = [("a", 1), ("b", 2), ("c", 3)]
    spark.createDataFrame(rows, "topic string, offset long").write.parquet(str(tmp_path / "log"))
    kept = select_topics(spark.read.parquet(str(tmp_path / "log")), {"a", "c"})
    assert {r.topic for r in kept.collect()} == {"a", "c"}
    assert "PushedFilters: [In(topic, [a,c])]" in kept._jdf.queryExecution().toString()


def test_names(spark):
    df = spark.createDataFrame(
        [("x:y_z", 3, 2, 72, 42, 102, b"\x00\xff", "h\u00e9")],
        "topic string, broker_id int, partition_id int, offset long, start_offset long, "
        "end_offset long, value binary, text string",
    )
    key = record_key_fields(F.col("key"))
    name = object_name_fields(F.element_at(F.split("object", "/"), -1))
    row = (
        df.withColumn("key", record_key())
        .withColumn("object", object_key("pre"))
        .select(
            "key",
            "object",
            payload_size().alias("n"),
            payload_size("text").alias("chars"),
            normalize_prefix(F.lit("p//")).alias("prefix"),
            *[c.alias(f"k_{n}") for n, c in key.items()],
            *[c.alias(f"o_{n}") for n, c in name.items()],
        )
        .first()
    )
    assert row.key == "x:y_z:3:2:72"
    assert row.object == "pre/x:y_z/3_2_0000000000000000042_0000000000000000102"
    assert (row.n, row.chars, row.prefix) == (2, 3, "p/")
    assert (row.k_topic, row.k_broker_id, row.k_partition_id, row.k_offset) == ("x:y_z", 3, 2, 72)
    assert (row.o_broker_id, row.o_partition_id, row.o_start_offset, row.o_end_offset) == (
        3, 2, 42, 102
    )


def test_counters(spark):
    chunks = spark.createDataFrame(
        [
            ("t", 1, 0, 0, 10, 2, 20, "size"),
            ("t", 1, 0, 10, 30, 3, 30, "interval"),
            ("t", 1, 0, 30, 40, 1, 5, "open"),
            ("t", 1, 1, 0, 7, 1, 1, "size"),
        ],
        "topic string, broker_id int, partition_id int, start_offset long, end_offset long, "
        "message_count long, message_bytes long, close_reason string",
    )
    got = {tuple(r)[2:] for r in partition_counters(chunks).collect()}
    assert got == {(0, 5, 50, 1, 5, 30, 40), (1, 1, 1, 0, 0, 7, 7)}


def test_kafka_options():
    c = ArchiveConfig.from_properties({**ARCHIVE, "kafka.topics": "b,a", "kafka.ignoregaps": "a"})
    o = kafka.reader_options(c, max_offsets_per_trigger=5)
    assert o["subscribe"] == "a,b"
    assert o["kafka.max.partition.fetch.bytes"] == "65536"
    assert (o["startingOffsets"], o["maxOffsetsPerTrigger"]) == ("earliest", "5")
    assert o["failOnDataLoss"] == "true"
    loose, strict = kafka.by_gap_policy(c)
    assert (loose.topics, strict.topics) == ({"a"}, {"b"})
    assert kafka.reader_options(loose)["failOnDataLoss"] == "false"
    positions = json.loads(kafka.offsets_json([("a", 1, 7), ("a", 0, 3), ("b", 0, 0)]))
    assert positions == {"a": {"0": 3, "1": 7}, "b": {"0": 0}}


def test_kafka_partitions_are_assigned_with_their_starts():
    c = ArchiveConfig.from_properties({**ARCHIVE, "kafka.topics": "b,a"})
    o = kafka.reader_options(
        c, starting=kafka.offsets_json([("a", 1, 7)]), partitions=[("a", 1), ("a", 0), ("b", 2)]
    )
    assert "subscribe" not in o and json.loads(o["assign"]) == {"a": [0, 1], "b": [2]}
    rows = [("a", 3, 0), ("a", 3, 1), ("b", 3, 2)]
    earliest = {("a", 0): 100, ("b", 2): 0}
    assert kafka.log_starts(rows, earliest) == [("a", 3, 0, 100), ("a", 3, 1, 0), ("b", 3, 2, 0)]


def test_kafka_rows_become_messages(spark):
    records = spark.createDataFrame(
        [("t", 4, 41, b"x", 1500), ("t", 4, 42, None, 2500)],
        "topic string, partition int, offset long, value binary, at long",
    ).withColumn("timestamp", F.timestamp_millis("at"))
    got = [tuple(r) for r in kafka.as_messages(records, 3).collect()]
    assert got == [("t", 3, 4, 42, b"x", 1500), ("t", 3, 4, 43, b"", 2500)]
