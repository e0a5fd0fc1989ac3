"""Registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.config import ArchiveConfig
from logstow.functions.names import (
    normalize_prefix,
    object_key,
    object_name_fields,
    payload_size,
    record_key,
)
from logstow.model import MESSAGE_SCHEMA, PARTITION_KEY, ChunkRule, Slicing
from logstow.operators.chunking import chain_chunks, closed_chunks, open_tails, plan_chunks
from logstow.operators.integrity import chunk_gaps, lost_data_gaps
from logstow.operators.metrics import archive_gauges, partition_counters
from logstow.operators.positions import last_committed, resume_scan, start_positions
from logstow.operators.topics import (
    configured_partitions,
    enumerate_partitions,
    select_topics,
    with_gap_policy,
)
from logstow.plans.archive_run import run_archive, written
from logstow.plans.table_logs import (
    HOUR_MS,
    conversations_log,
    documents_log,
    events_log,
    load,
)
from logstow.shared_dir import shared_dir
from logstow.sinks.sequence_files import write_chunks
from logstow.sources.archive import (
    archived_messages,
    list_objects,
    objects_between,
    parse_objects,
    read_catalog,
    read_catalog_objects,
)
from logstow.sources.archive_format import read_archive, write_archive
from logstow.sources.tables import file_range_reader, message_stream
from logstow.streaming.archive_stream import start_archive
from logstow.streaming.counters import stream_counters

PREFIX = "archive"
# 2024-01-01T00:00Z, when the events begin.
RUN_START_MS = 1_704_067_200_000
# A first run ended, and the log was cut, on these days.
FIRST_RUN_END_MS = RUN_START_MS + 14 * 24 * HOUR_MS
LOG_CUT_MS = RUN_START_MS + 19 * 24 * HOUR_MS

WATCHED_TOPICS = ["click", "purchase"]
IGNORE_GAPS_TOPICS = ["click", "error", "view"]

EVENT_SIZE_RULE = ChunkRule(200, None, RUN_START_MS)
EVENT_INTERVAL_RULE = ChunkRule(None, 6 * HOUR_MS, RUN_START_MS)
EVENT_RULE = ChunkRule(100, 8 * HOUR_MS, RUN_START_MS)
DOCUMENT_RULE = ChunkRule(65_536, None)
CONVERSATION_RULE = ChunkRule(16_384, None)
# Far below the default, so that these tables have partitions to slice.
SLICING = Slicing(rows=250, chunks=4, group=8)


def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = select_topics(events_log(spark, sf_dir), WATCHED_TOPICS)
    return log.select(*PARTITION_KEY, "offset", "size", "arrival_ms")


def partition_enumeration(spark, sf_dir):
    topics = (
        load(spark, sf_dir, "events").select(F.col("event_type").alias("topic"))
        .union(load(spark, sf_dir, "documents").select("lang"))
        .union(load(spark, sf_dir, "conversations").select("role"))
    )
    overrides = (
        load(spark, sf_dir, "documents")
        .groupBy(F.col("lang").alias("topic"))
        .agg((F.max(F.col("doc_id") % 4) + 1).alias("partition_count"))
    )
    return enumerate_partitions(topics, overrides, 2, 3)


def gap_policy(spark, sf_dir):
    return with_gap_policy(_event_partitions(spark, sf_dir), IGNORE_GAPS_TOPICS)


def record_keys(spark, sf_dir):
    return documents_log(spark, sf_dir).select(record_key().alias("key"), "offset")


def payload_sizes(spark, sf_dir):
    log = documents_log(spark, sf_dir)
    return log.select(*PARTITION_KEY, "offset", payload_size().alias("payload_bytes"))


def object_keys(spark, sf_dir):
    return plan_chunks(documents_log(spark, sf_dir), DOCUMENT_RULE).select(
        *PARTITION_KEY, "start_offset", object_key(PREFIX).alias("object_key")
    )


def object_name_parse(spark, sf_dir):
    """Names written and taken apart again."""
    keys = object_keys(spark, sf_dir).select("topic", "object_key")
    name = F.element_at(F.split("object_key", "/"), -1)
    return keys.select(
        "topic", "object_key", *[c.alias(n) for n, c in object_name_fields(name).items()]
    )


def prefix_normalise(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id", normalize_prefix(F.concat("url", F.lit("/"))).alias("prefix")
    )


def object_name_foreign(spark, sf_dir):
    """Names of other makes among ours, by page: what is read from them, and which of
    them a lenient catalog rejects and a strict one fails on."""
    page, part = F.col("page_id"), F.col("page_id") % 7
    name = (
        F.when(page % 5 == 0, F.format_string("3_%d_%019d_%019d", part, page, page + 10))
        .when(page % 5 == 1, F.concat(F.lit("notes-"), page, F.lit(".txt")))
        .when(page % 5 == 2, F.concat(F.lit("3_"), part, F.lit("_x"), page, F.lit("_5")))
        .when(page % 5 == 3, F.concat(F.lit("3_1_"), page))
        .otherwise(F.concat(F.lit("3_1_5_"), page + 5, F.lit("_extra")))
    )
    pages = load(spark, sf_dir, "pages").select("page_id", name.alias("name"))
    fields = [c.alias(n) for n, c in object_name_fields(F.col("name")).items()]
    return pages.select("*", *fields).withColumn("rejected", F.col("end_offset").isNull())


def prefix_slashes(spark, sf_dir):
    """Prefixes with none, one or two slashes at their end; one goes."""
    slashes = F.expr("repeat('/', cast(page_id % 3 as int))")
    return load(spark, sf_dir, "pages").select(
        "page_id", normalize_prefix(F.concat("url", slashes)).alias("prefix")
    )


def partition_zero_counts(spark, sf_dir):
    """Enumeration where settings give some topics no partition, or fewer than none."""
    docs = load(spark, sf_dir, "documents")
    overrides = docs.groupBy(F.col("lang").alias("topic")).agg(
        F.when(F.col("lang") == "de", 0)
        .when(F.col("lang") == "fr", -2)
        .otherwise(F.max(F.col("doc_id") % 4) + 1)
        .alias("partition_count")
    )
    return enumerate_partitions(docs.select(F.col("lang").alias("topic")), overrides, 2, 3)


def size_chunks(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_SIZE_RULE)


def interval_chunks(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_INTERVAL_RULE)


def combined_chunks(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_RULE)


def size_chunks_sliced(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_SIZE_RULE, SLICING)


def interval_chunks_sliced(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_INTERVAL_RULE, SLICING)


def combined_chunks_sliced(spark, sf_dir):
    return plan_chunks(events_log(spark, sf_dir), EVENT_RULE, SLICING)


def timer_at_end(spark, sf_dir):
    """The interval rule looked at once more, two days after the last event."""
    now = RUN_START_MS + 32 * 24 * HOUR_MS
    rule = ChunkRule(EVENT_RULE.max_bytes, EVENT_RULE.interval_ms, RUN_START_MS, now)
    return plan_chunks(events_log(spark, sf_dir), rule)


def chunk_summary(spark, sf_dir):
    return plan_chunks(documents_log(spark, sf_dir), DOCUMENT_RULE)


def chunk_chaining(spark, sf_dir):
    """Chunk starts recovered from nothing but the chunk ends."""
    chunks = plan_chunks(documents_log(spark, sf_dir), DOCUMENT_RULE)
    starts = chunks.groupBy(*PARTITION_KEY).agg(F.min("start_offset").alias("start_offset"))
    return chain_chunks(chunks.drop("start_offset"), starts).select(
        *PARTITION_KEY, "start_offset", "end_offset"
    )


def open_tail(spark, sf_dir):
    return open_tails(plan_chunks(conversations_log(spark, sf_dir), CONVERSATION_RULE))


def committed_chunks(spark, sf_dir):
    return closed_chunks(plan_chunks(conversations_log(spark, sf_dir), CONVERSATION_RULE))


def _event_partitions(spark, sf_dir):
    """Partitions of the events log, and where the log begins after the cut."""
    log = events_log(spark, sf_dir)
    kept = F.when(F.col("arrival_ms") >= LOG_CUT_MS, F.col("offset") - F.col("size") - 10)
    return log.groupBy(*PARTITION_KEY).agg(
        F.coalesce(F.min(kept), F.max("offset")).alias("log_start")
    )


def _first_run_catalog(spark, sf_dir):
    log = events_log(spark, sf_dir).filter(F.col("arrival_ms") < FIRST_RUN_END_MS)
    return closed_chunks(plan_chunks(log, EVENT_RULE))


def last_committed_offsets(spark, sf_dir):
    parts = _event_partitions(spark, sf_dir).select(*PARTITION_KEY)
    return last_committed(parts, _first_run_catalog(spark, sf_dir))


def start_position(spark, sf_dir):
    parts = gap_policy(spark, sf_dir)
    return start_positions(parts, _first_run_catalog(spark, sf_dir))


def resume(spark, sf_dir):
    unread = resume_scan(events_log(spark, sf_dir), start_position(spark, sf_dir))
    return unread.select(*PARTITION_KEY, "offset", "size", "start_offset")


def lost_data_gap(spark, sf_dir):
    return lost_data_gaps(start_position(spark, sf_dir))


def chunk_gap_check(spark, sf_dir):
    """Gaps that show when the chunks closed by the timer are missing."""
    chunks = plan_chunks(events_log(spark, sf_dir), EVENT_RULE)
    return chunk_gaps(chunks.filter("close_reason = 'size'"))


def counters(spark, sf_dir):
    return partition_counters(plan_chunks(events_log(spark, sf_dir), EVENT_RULE))


def gauges(spark, sf_dir):
    return archive_gauges(partition_enumeration(spark, sf_dir))


def _archived_documents(spark, sf_dir) -> tuple[str, list[str]]:
    """Archive the documents' closed chunks in a fresh folder."""
    path = shared_dir(spark, "archive")
    log = written(documents_log(spark, sf_dir), f"{path}/log")
    chunks = written(closed_chunks(plan_chunks(log, DOCUMENT_RULE)), f"{path}/chunks")
    write_chunks(log, chunks, f"{path}/base")
    topics = [r.topic for r in chunks.select("topic").distinct().collect()]
    return f"{path}/base", topics


def archive_windows(spark, sf_dir):
    """The documents' chunks written in many small windows."""
    path = shared_dir(spark, "windows")
    log = written(documents_log(spark, sf_dir), f"{path}/log")
    chunks = written(closed_chunks(plan_chunks(log, DOCUMENT_RULE)), f"{path}/chunks")
    write_chunks(log, chunks, f"{path}/base", chunks_per_job=8)
    topics = [r.topic for r in chunks.select("topic").distinct().collect()]
    objects = parse_objects(list_objects(spark, f"{path}/base", topics))
    return objects.select(*PARTITION_KEY, "start_offset", "end_offset", "name")


def archive_roundtrip(spark, sf_dir):
    base, topics = _archived_documents(spark, sf_dir)
    records = read_catalog_objects(read_catalog(spark, base, topics))
    return archived_messages(records).select(
        *PARTITION_KEY, "offset", payload_size().alias("payload_bytes"), F.md5("value").alias("md5")
    )


def archive_listing(spark, sf_dir):
    base, topics = _archived_documents(spark, sf_dir)
    objects = parse_objects(list_objects(spark, base, topics))
    return objects.select(*PARTITION_KEY, "start_offset", "end_offset", "name")


def offset_pruned_read(spark, sf_dir):
    """Records of the objects that reach beyond an offset; the rest stay closed."""
    base, topics = _archived_documents(spark, sf_dir)
    catalog = objects_between(read_catalog(spark, base, topics), low=200_000)
    return archived_messages(read_catalog_objects(catalog)).select(*PARTITION_KEY, "offset")


def _documents_by_source(spark, sf_dir) -> str:
    """Archive the documents' closed chunks by `df.write.format`, in a fresh folder."""
    path = shared_dir(spark, "source")
    log = written(documents_log(spark, sf_dir), f"{path}/log")
    chunks = written(closed_chunks(plan_chunks(log, DOCUMENT_RULE)), f"{path}/chunks")
    write_archive(log, chunks, f"{path}/base")
    return f"{path}/base"


def source_roundtrip(spark, sf_dir):
    """Written and read again by the data source."""
    return read_archive(spark, _documents_by_source(spark, sf_dir)).select(
        *PARTITION_KEY, "offset", payload_size().alias("payload_bytes"), F.md5("value").alias("md5")
    )


def source_filtered_read(spark, sf_dir):
    """Rows by plain filters on the data source."""
    rows = read_archive(spark, _documents_by_source(spark, sf_dir))
    wanted = (F.col("offset") > 200_000) & (F.col("partition_id") == 1)
    return rows.filter(wanted).select(*PARTITION_KEY, "offset")


def configured(spark, sf_dir):
    """Partitions and gap policy as two properties files have them; the topics and
    partition counts in the files are those of the documents."""
    counts = (
        load(spark, sf_dir, "documents")
        .groupBy("lang")
        .agg((F.max("doc_id") % 3 + 1).alias("n"))
        .orderBy("lang")
        .collect()
    )
    path = shared_dir(spark, "settings")
    topics = ",".join(r.lang for r in counts)
    archive = f"kafka.topics={topics},none\nkafka.ignoregaps=de,none\ns3.bucket=b\ns3.prefix=p/\n"
    archive += "s3.accesskey=k\ns3.secretkey=s\n"
    broker = "brokerid=3\nnum.partitions=2\ntopic.partition.count.map="
    broker += ",".join(f"{r.lang}:{r.n}" for r in counts)
    for name, text in (("archive", archive), ("broker", broker)):
        one = spark.createDataFrame([(text,)], "value string")
        one.coalesce(1).write.option("lineSep", "\n").text(f"{path}/{name}")
    return configured_partitions(
        spark, ArchiveConfig.load(spark, f"{path}/archive/*", f"{path}/broker/*")
    )


def incremental_runs(spark, sf_dir):
    """Two runs of the archive job, the second going on behind the first."""
    path = shared_dir(spark, "incremental")
    log = written(conversations_log(spark, sf_dir), f"{path}/log")
    half = log.join(
        log.groupBy(*PARTITION_KEY).agg((F.max("offset") / 2).alias("half")), PARTITION_KEY
    ).filter("offset <= half")
    parts = log.select(*PARTITION_KEY).distinct().select(
        "*", F.lit(0).cast("long").alias("log_start"), F.lit(False).alias("ignore_gaps")
    )
    run_archive(half.drop("half"), parts, f"{path}/base", CONVERSATION_RULE)
    run = run_archive(log, parts, f"{path}/base", CONVERSATION_RULE)
    topics = [r.topic for r in run.starts.select("topic").distinct().collect()]
    return read_catalog(spark, f"{path}/base", topics).select(
        *PARTITION_KEY, "start_offset", "end_offset"
    )


def _stream_run(spark, path: str, starts, max_bytes: int) -> None:
    """Stream all files that are in the log's folder by now, then end."""
    query = start_archive(
        message_stream(spark, f"{path}/log", max_bytes),
        file_range_reader(spark, f"{path}/log"),
        starts,
        f"{path}/base",
        CONVERSATION_RULE,
        f"{path}/state",
        trigger={"availableNow": True},
    )
    query.awaitTermination()


def _partition_starts(log: DataFrame) -> DataFrame:
    return log.select(*PARTITION_KEY).distinct().select("*", F.lit(0).alias("start_offset"))


def _streamed(spark, sf_dir, parts: int) -> str:
    """Archive the conversations, fed in so many parts, each to a new run."""
    path = shared_dir(spark, "stream")
    columns = [f.name for f in MESSAGE_SCHEMA]
    log = written(conversations_log(spark, sf_dir).select(*columns), f"{path}/all")
    starts = _partition_starts(log)
    last = log.groupBy(*PARTITION_KEY).agg(F.max("offset").alias("last"))
    placed = log.join(last, PARTITION_KEY).withColumn(
        "part", F.expr(f"least({parts - 1}, offset * {parts} div (last + 1))")
    )
    for part in range(parts):
        some = placed.filter(F.col("part") == part).select(*columns)
        some.write.mode("append").parquet(f"{path}/log")
        _stream_run(spark, path, starts, 8 << 30)
    return path


def _streamed_ranges(spark, path: str) -> DataFrame:
    topics = [r.topic for r in spark.read.parquet(f"{path}/log").select("topic").distinct().collect()]
    return read_catalog(spark, f"{path}/base", topics).select(
        *PARTITION_KEY, "start_offset", "end_offset"
    )


def stream_archive(spark, sf_dir):
    """The streaming job over the conversations, until all input is read."""
    return _streamed_ranges(spark, _streamed(spark, sf_dir, 1))


def stream_restart(spark, sf_dir):
    """The same, ended in mid-log and gone on with when more files have come."""
    return _streamed_ranges(spark, _streamed(spark, sf_dir, 3))


def stream_counter_totals(spark, sf_dir):
    """What three runs of one stream have committed, by partition."""
    return stream_counters(spark, f"{_streamed(spark, sf_dir, 3)}/state")


def stream_new_partition(spark, sf_dir):
    """A topic and partitions that appear after the first run of the stream."""
    path = shared_dir(spark, "stream")
    columns = [f.name for f in MESSAGE_SCHEMA]
    log = written(conversations_log(spark, sf_dir).select(*columns), f"{path}/all")
    last = log.groupBy(*PARTITION_KEY).agg((F.max("offset") / 2).alias("half"))
    placed = log.join(last, PARTITION_KEY)
    first_topic = log.agg(F.min("topic")).first()[0]
    early = (F.col("topic") == first_topic) & (F.col("partition_id") == 0)
    for arriving in (
        early & (F.col("offset") <= F.col("half")),
        (F.col("topic") == first_topic) & ~early,
        (F.col("topic") != first_topic) | (early & (F.col("offset") > F.col("half"))),
    ):
        placed.filter(arriving).select(*columns).write.mode("append").parquet(f"{path}/log")
        known = spark.read.parquet(f"{path}/log")
        _stream_run(spark, path, _partition_starts(known), 8 << 30)
    return _streamed_ranges(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "topic_filter": topic_filter,
    "partition_enumeration": partition_enumeration,
    "gap_policy": gap_policy,
    "record_key": record_keys,
    "payload_size": payload_sizes,
    "object_key": object_keys,
    "object_name_parse": object_name_parse,
    "prefix_normalise": prefix_normalise,
    "size_chunks": size_chunks,
    "interval_chunks": interval_chunks,
    "combined_chunks": combined_chunks,
    "size_chunks_sliced": size_chunks_sliced,
    "interval_chunks_sliced": interval_chunks_sliced,
    "combined_chunks_sliced": combined_chunks_sliced,
    "timer_at_end": timer_at_end,
    "chunk_summary": chunk_summary,
    "chunk_chaining": chunk_chaining,
    "open_tail": open_tail,
    "committed_chunks": committed_chunks,
    "last_committed": last_committed_offsets,
    "start_position": start_position,
    "resume_scan": resume,
    "chunk_gap_check": chunk_gap_check,
    "lost_data_gap": lost_data_gap,
    "partition_counters": counters,
    "archive_gauges": gauges,
    "archive_roundtrip": archive_roundtrip,
    "archive_listing": archive_listing,
    "offset_pruned_read": offset_pruned_read,
    "incremental_runs": incremental_runs,
    "stream_archive": stream_archive,
    "object_name_foreign": object_name_foreign,
    "prefix_slashes": prefix_slashes,
    "partition_zero_counts": partition_zero_counts,
    "archive_windows": archive_windows,
    "source_roundtrip": source_roundtrip,
    "source_filtered_read": source_filtered_read,
    "configured_partitions": configured,
    "stream_restart": stream_restart,
    "stream_new_partition": stream_new_partition,
    "stream_counters": stream_counter_totals,
}


def object_names_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the events cut into chunks, with their object names."""
    return size_chunks(spark, sf_dir).withColumn("object_key", object_key(PREFIX))
