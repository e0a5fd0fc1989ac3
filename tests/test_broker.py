"""The daemon's queries over a broker that is a folder of files and can be cut."""

import pytest
from pyspark.sql import functions as F

from logstow.config import ArchiveConfig
from logstow.operators.integrity import GapError
from logstow.plans.daemon import committed, starters
from logstow.sinks.sequence_files import filesystem_of, store_options
from logstow.sources.kafka import FIRST_OFFSETS, admitted_offsets
from logstow.sources.tables import file_range_reader, message_stream
from test_archive import messages_of, object_names
from test_streaming import wait_for


class FileBroker:
    """first: what has been cut, by topic and partition. on_read: before ranges are read."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.first, self.on_read, self.asked = {}, lambda: None, []

    def connect(self, spark, config):
        self.topics = config.topics
        return self

    def held(self, messages):
        gone = F.lit(False)
        for (topic, partition), first in self.first.items():
            own = (F.col("topic") == topic) & (F.col("partition_id") == partition)
            gone = gone | (own & (F.col("offset") <= first))
        return messages.filter(~gone)

    def earliest(self, partitions):
        return {p: self.first.get(p, 0) for p in partitions}

    def stream(self, positions, max_offsets):
        self.asked.append(max_offsets)
        return self.held(message_stream(self.spark, self.folder))

    def log(self, ranges):
        self.on_read()
        return self.held(file_range_reader(self.spark, self.folder)(ranges))

    def send(self, topic, offsets):
        rows = [(topic, 3, 0, o, b"0123456789", 0) for o in offsets]
        messages_of(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder)


@pytest.fixture
def broker(spark, tmp_path):
    return FileBroker(spark, str(tmp_path / "log"))


def settings(tmp_path, ignoring):
    topics = frozenset(["t"])
    return ArchiveConfig(
        topics, "", str(tmp_path / "base").lstrip("/"), topics if ignoring else frozenset(),
        min_chunk_bytes=45, broker_id=3, scheme="file",
    )


def run(spark, tmp_path, broker, ignoring, count=None):
    """Until so many messages are committed in all; the counters."""
    name = "ignoring-gaps" if ignoring else "strict"
    begin = starters(
        spark, settings(tmp_path, ignoring), str(tmp_path / "state"), broker.connect,
        max_bytes=1000, trigger={"processingTime": "500 milliseconds"},
    )
    assert list(begin) == [name]

    def counted():
        return committed(spark, [str(tmp_path / "state" / name)])

    query = begin[name]()
    try:
        done = wait_for(lambda: query.exception() or counted()["committed_count"] == count, 60)
        if query.exception():
            raise query.exception()
        assert done, counted()
    finally:
        query.stop()
    return counted()


def names(*ranges):
    return [f"t/3_0_{low:019d}_{high:019d}" for low, high in ranges]


def test_a_log_cut_between_runs(spark, tmp_path, broker):
    broker.send("t", range(20, 161, 20))
    run(spark, tmp_path, broker, True, 5)
    assert object_names(str(tmp_path / "base")) == names((0, 100))
    # The open chunk (100, 160] has lost two of its three messages.
    broker.first["t", 0] = 140
    broker.send("t", range(180, 241, 20))
    counted = run(spark, tmp_path, broker, True, 8)
    assert object_names(str(tmp_path / "base")) == names((0, 100), (140, 200))
    assert counted["committed_chunks"] == 2 and counted["committed_bytes"] == 80
    # After the first batch the bound is one of bytes: 1000 bytes of 10 a message.
    assert broker.asked == [FIRST_OFFSETS, 100]


def test_a_log_cut_while_a_chunk_is_written(spark, tmp_path, broker):
    broker.send("t", range(20, 161, 20))
    broker.on_read = lambda: broker.first.update({("t", 0): 40})
    with pytest.raises(Exception, match="messages read"):
        run(spark, tmp_path, broker, True)
    assert object_names(str(tmp_path / "base")) == []
    run(spark, tmp_path, broker, True, 3)
    assert object_names(str(tmp_path / "base")) == names((40, 100))


def test_a_strict_query_stops_on_a_cut_log(spark, tmp_path, broker):
    broker.send("t", range(20, 161, 20))
    broker.on_read = lambda: broker.first.update({("t", 0): 40})
    with pytest.raises(Exception, match="messages read"):
        run(spark, tmp_path, broker, False)
    with pytest.raises(GapError, match="lost before they were archived"):
        run(spark, tmp_path, broker, False)
    assert object_names(str(tmp_path / "base")) == []


def test_offsets_within_bytes():
    assert admitted_offsets(0, 0, 1000) == FIRST_OFFSETS
    assert admitted_offsets(8, 80, 1000) == 100
    assert admitted_offsets(1, 10**9, 1000) == 1
    assert admitted_offsets(10, 10**4, 8 << 30) == (8 << 30) // 1000


def test_tasks_get_the_credentials_of_the_session(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    given = {
        "fs.s3a.access.key": "a", "fs.s3a.secret.key": "b",
        "fs.s3a.endpoint": "http://store:9000", "fs.s3a.endpoint.region": "eu-west-1",
    }
    before = {name: hadoop.get(name) for name in given}
    try:
        for name, value in given.items():
            hadoop.set(name, value)
        options = store_options(spark, "s3a://bucket/x/")
        assert options == {
            "access_key": "a", "secret_key": "b", "endpoint_override": "store:9000",
            "scheme": "http", "region": "eu-west-1",
        }
        store, root = filesystem_of("s3a://bucket/x/", options)
        assert (store.type_name, store.region, root) == ("s3", "eu-west-1", "bucket/x")
        assert store_options(spark, "/tmp/x") == {}
    finally:
        for name, value in before.items():
            hadoop.unset(name) if value is None else hadoop.set(name, value)
