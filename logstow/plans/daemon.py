"""Start archiving Kafka topics from two properties files.

    spark-submit --packages <kafka connector> -m logstow.plans.daemon \\
        server.properties archiver.properties <checkpoint folder>
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logstow.config import ArchiveConfig, apply_credentials, read_properties
from logstow.model import PARTITION_KEY
from logstow.operators.topics import configured_partitions
from logstow.plans.archive_run import current_starts
from logstow.sinks.sequence_files import OBJECT_STORE, recover
from logstow.sources.kafka import (
    Broker,
    KafkaBroker,
    admitted_offsets,
    by_gap_policy,
    log_starts,
)
from logstow.streaming.archive_stream import start_archive
from logstow.streaming.counters import COUNTERS, stream_counters
from logstow.streaming.starts import grow_starts

# Payload bytes a micro-batch is meant to have.
BATCH_BYTES = 8 << 30
# Between looks at the queries, and lines with the counters.
CHECK_SECONDS = 60
USAGE = "usage: daemon <server properties> <archiver properties> <checkpoint folder>"


def starters(
    spark: SparkSession,
    config: ArchiveConfig,
    checkpoint: str,
    connect: Callable[[SparkSession, ArchiveConfig], Broker] = KafkaBroker,
    max_bytes: int = BATCH_BYTES,
    **options,
) -> dict[str, Callable[[], StreamingQuery]]:
    """By name, how to start each query: one for topics that ignore gaps, one for others.

    A start completes what a dead run left before it looks at the archive, and takes
    its bound on offsets from the mean size of what was committed so far. Where a
    rename copies, tasks rename. options: further ones of `start_archive`.
    """

    def starter(part: ArchiveConfig, name: str) -> Callable[[], StreamingQuery]:
        owner = f"broker-{part.broker_id}-{name}"
        enumerated = configured_partitions(spark, part)
        rows = [(r.topic, r.broker_id, r.partition_id) for r in enumerated.toLocalIterator()]
        read = [(t, p) for t, _, p in rows]
        in_tasks = OBJECT_STORE.match(part.base_uri) is not None
        broker = connect(spark, part)
        ignoring = part.topics <= part.ignore_gaps_topics

        def log_start() -> DataFrame:
            first = log_starts(rows, broker.earliest(read))
            return spark.createDataFrame(
                first, "topic string, broker_id int, partition_id int, log_start long"
            )

        def begin() -> DataFrame:
            return current_starts(enumerated.join(log_start(), PARTITION_KEY), part.base_uri)

        def start() -> StreamingQuery:
            recover(spark, part.base_uri, owner, in_tasks=in_tasks)
            starts = grow_starts(spark, begin, f"{checkpoint}/{name}")
            positions = [
                (r.topic, r.partition_id, r.start_offset) for r in starts.toLocalIterator()
            ]
            counted = committed(spark, [f"{checkpoint}/{name}"])
            most = admitted_offsets(
                counted["committed_count"], counted["committed_bytes"], max_bytes
            )
            return start_archive(
                broker.stream(positions, most),
                broker.log,
                starts,
                part.base_uri,
                part.chunk_rule(int(time.time() * 1000)),
                f"{checkpoint}/{name}",
                owner=owner,
                log_start=log_start if ignoring else None,
                in_tasks=in_tasks,
                **options,
            )

        return start

    return {
        name: starter(part, name)
        for part in by_gap_policy(config)
        for name in ["ignoring-gaps" if part.topics <= part.ignore_gaps_topics else "strict"]
    }


def committed(spark: SparkSession, checkpoints: list[str]) -> dict[str, int]:
    """What queries have committed since they were first started, in this process or not."""
    totals = dict.fromkeys(COUNTERS, 0)
    for checkpoint in checkpoints:
        found = stream_counters(spark, checkpoint).agg(*[F.sum(c).alias(c) for c in COUNTERS]).first()
        for name in COUNTERS:
            totals[name] += found[name] or 0
    return totals


class Supervisor:
    """Starts queries, and starts one again by itself when it has failed.

    restarts: by query name, how often that was done.
    """

    def __init__(self, start: dict[str, Callable[[], StreamingQuery]], most: int = 100):
        """most: restarts of a query before its failure is raised."""
        self.start, self.most = start, most
        self.restarts = dict.fromkeys(start, 0)
        self.running = {name: begin() for name, begin in start.items()}

    def look(self) -> bool:
        """Restart what has failed; whether anything is still running."""
        for name, query in list(self.running.items()):
            if query.isActive:
                continue
            failure = query.exception()
            if failure is None:
                del self.running[name]
                continue
            if self.restarts[name] >= self.most:
                raise failure
            self.restarts[name] += 1
            self.running[name] = self.start[name]()
        return bool(self.running)


def main(argv: list[str]) -> int:
    if len(argv) != 3:
        print(USAGE, file=sys.stderr)
        return 2
    server_path, archive_path, checkpoint = argv
    spark = SparkSession.builder.appName("logstow").getOrCreate()
    archive = read_properties(spark, archive_path)
    config = ArchiveConfig.from_properties(archive, read_properties(spark, server_path))
    apply_credentials(spark, archive)
    queries = starters(spark, config, checkpoint)
    supervisor = Supervisor(queries)
    while supervisor.look():
        time.sleep(CHECK_SECONDS)
        counted = committed(spark, [f"{checkpoint}/{name}" for name in queries])
        print(json.dumps({"restarts": supervisor.restarts, **counted}), flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
