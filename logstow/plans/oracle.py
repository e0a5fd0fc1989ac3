"""The registered queries in plain SQL, for comparison on small data."""

from __future__ import annotations

from logstow.model import ChunkRule
from logstow.plans import queries as q

KEY = "topic, broker_id, partition_id"


def _log(table: str, topic: str, partition: str, payload: str, order: str, arrival: str) -> str:
    size = f"octet_length(encode({payload}))"
    return f"""
    SELECT topic, broker_id, partition_id, "offset", size, arrival_ms, payload FROM (
      SELECT {topic} AS topic, 3::INTEGER AS broker_id,
             CAST({partition} AS INTEGER) AS partition_id,
             CAST(sum({size} + 10) OVER (
               PARTITION BY {topic}, {partition} ORDER BY {order}) AS BIGINT) AS "offset",
             CAST({size} AS BIGINT) AS size,
             CAST({arrival} AS BIGINT) AS arrival_ms,
             {payload} AS payload
      FROM {table})"""


EVENTS = _log("events", "event_type", "user_id % 2", "props", "ts, event_id", "epoch_us(ts) // 1000")
DOCUMENTS = _log("documents", "lang", "doc_id % 4", "text", "doc_id", "0")
CONVERSATIONS = _log("conversations", "role", "conv_id % 2", "text", "conv_id, turn", "0")


def _chunks(log: str, rule: ChunkRule, where: str = "true") -> str:
    """Named queries that end in `chunks`; one step of the recursion per message."""
    limit = 2**61 if rule.max_bytes is None else rule.max_bytes
    wait = 2**61 if rule.interval_ms is None else rule.interval_ms
    begin = rule.run_start_ms
    now = begin if rule.now_ms is None else rule.now_ms
    return f"""
    log AS ({log}),
    numbered AS (
      SELECT {KEY}, "offset", size,
             row_number() OVER (PARTITION BY {KEY} ORDER BY "offset") AS n,
             greatest({begin}, max(arrival_ms) OVER (
               PARTITION BY {KEY} ORDER BY "offset")) AS clock
      FROM log WHERE {where}),
    steps AS (
      SELECT {KEY}, n, "offset", size, bytes, begins, bytes > {limit} AS full_up,
             CASE WHEN bytes > {limit} THEN clock ELSE ticked END AS last
      FROM (
        SELECT {KEY}, n, "offset", size, clock, size AS bytes, 0::BIGINT AS begins,
               CASE WHEN clock - {begin} > {wait}
                    THEN {begin} + (clock - {begin} - 1) // {wait} * {wait}
                    ELSE {begin} END AS ticked
        FROM numbered WHERE n = 1)
      UNION ALL
      SELECT {KEY}, n, "offset", size, bytes, begins, bytes > {limit},
             CASE WHEN bytes > {limit} THEN clock ELSE ticked END
      FROM (
        SELECT m.topic, m.broker_id, m.partition_id, m.n, m."offset", m.size, m.clock,
               CASE WHEN s.full_up OR m.clock - s.last > {wait}
                    THEN m.size ELSE s.bytes + m.size END AS bytes,
               CASE WHEN s.full_up OR m.clock - s.last > {wait}
                    THEN s."offset" ELSE s.begins END AS begins,
               CASE WHEN m.clock - s.last > {wait}
                    THEN s.last + (m.clock - s.last - 1) // {wait} * {wait}
                    ELSE s.last END AS ticked
        FROM steps s JOIN numbered m
          ON m.topic = s.topic AND m.broker_id = s.broker_id
         AND m.partition_id = s.partition_id AND m.n = s.n + 1)),
    grouped AS (
      SELECT {KEY}, begins AS start_offset, max("offset") AS end_offset,
             count(*) AS message_count, CAST(sum(size) AS BIGINT) AS message_bytes,
             bool_or(full_up) AS by_size, arg_max(last, n) AS last
      FROM steps GROUP BY {KEY}, begins),
    chunks AS (
      SELECT {KEY}, start_offset, end_offset, message_count, message_bytes,
             CASE WHEN by_size THEN 'size'
                  WHEN lead(end_offset) OVER (
                    PARTITION BY {KEY} ORDER BY start_offset) IS NOT NULL THEN 'interval'
                  WHEN {now} - last > {wait} THEN 'interval'
                  ELSE 'open' END AS close_reason
      FROM grouped)"""


def _query(with_part: str, select: str) -> str:
    return f"WITH RECURSIVE {with_part}\n{select}"


def _names(topics) -> str:
    return ", ".join(f"'{t}'" for t in topics)


OBJECT_NAME = (
    "printf('%d_%d_%019d_%019d', broker_id, partition_id, start_offset, end_offset)"
)
ALL_TOPICS = """
    topics AS (
      SELECT event_type AS topic FROM events
      UNION SELECT lang FROM documents UNION SELECT role FROM conversations),
    counts AS (
      SELECT topic, coalesce(partition_count, 2) AS n
      FROM topics LEFT JOIN (
        SELECT lang AS topic, max(doc_id % 4) + 1 AS partition_count
        FROM documents GROUP BY lang) USING (topic)),
    partitions AS (
      SELECT topic, 3::INTEGER AS broker_id, CAST(i AS INTEGER) AS partition_id
      FROM counts, unnest(generate_series(0, n - 1)) AS g(i))"""
EVENT_PARTITIONS = f"""
    events_log AS ({EVENTS}),
    event_partitions AS (
      SELECT {KEY}, coalesce(
               min(CASE WHEN arrival_ms >= {q.LOG_CUT_MS} THEN "offset" - size - 10 END),
               max("offset")) AS log_start,
             topic IN ({_names(q.IGNORE_GAPS_TOPICS)}) AS ignore_gaps
      FROM events_log GROUP BY {KEY})"""
FIRST_RUN = _chunks(EVENTS, q.EVENT_RULE, f"arrival_ms < {q.FIRST_RUN_END_MS}")
STARTS = f"""{FIRST_RUN}, {EVENT_PARTITIONS},
    committed AS (
      SELECT {KEY}, max(end_offset) AS archived_end
      FROM chunks WHERE close_reason <> 'open' GROUP BY {KEY}),
    starts AS (
      SELECT {KEY}, log_start, ignore_gaps,
             coalesce(archived_end, 0) AS last_committed,
             greatest(CASE WHEN ignore_gaps THEN log_start ELSE 0 END,
                      coalesce(archived_end, 0)) AS start_offset
      FROM event_partitions LEFT JOIN committed USING ({KEY}))"""
ALL_CHUNKS = "SELECT * FROM chunks"
DOCUMENT_CHUNKS = _chunks(DOCUMENTS, q.DOCUMENT_RULE)
CONVERSATION_CHUNKS = _chunks(CONVERSATIONS, q.CONVERSATION_RULE)
EVENT_CHUNKS = _chunks(EVENTS, q.EVENT_RULE)


def _later_rule() -> ChunkRule:
    now = q.RUN_START_MS + 32 * 24 * q.HOUR_MS
    return ChunkRule(q.EVENT_RULE.max_bytes, q.EVENT_RULE.interval_ms, q.RUN_START_MS, now)


ARCHIVED_DOCUMENTS = f"""
    SELECT l.topic, l.broker_id, l.partition_id, l."offset" {{columns}}
    FROM log l JOIN chunks c
      ON l.topic = c.topic AND l.partition_id = c.partition_id
     AND l."offset" > c.start_offset AND l."offset" <= c.end_offset
    WHERE c.close_reason <> 'open' {{where}}"""
CLOSED_RANGES = (
    f"SELECT {KEY}, start_offset, end_offset FROM chunks WHERE close_reason <> 'open'"
)

ORACLE: dict[str, str] = {
    "topic_filter": f"""
        SELECT {KEY}, "offset", size, arrival_ms FROM ({EVENTS})
        WHERE topic IN ({_names(q.WATCHED_TOPICS)})""",
    "partition_enumeration": _query(ALL_TOPICS, "SELECT * FROM partitions"),
    "gap_policy": _query(EVENT_PARTITIONS, "SELECT * FROM event_partitions"),
    "record_key": f"""
        SELECT printf('%s:%d:%d:%d', topic, broker_id, partition_id, "offset") AS key, "offset"
        FROM ({DOCUMENTS})""",
    "payload_size": f"""
        SELECT {KEY}, "offset", size AS payload_bytes FROM ({DOCUMENTS})""",
    "object_key": _query(
        DOCUMENT_CHUNKS,
        f"""SELECT {KEY}, start_offset,
                   '{q.PREFIX}/' || topic || '/' || {OBJECT_NAME} AS object_key FROM chunks""",
    ),
    "object_name_parse": _query(
        DOCUMENT_CHUNKS,
        f"""SELECT {KEY}, start_offset, end_offset,
                   '{q.PREFIX}/' || topic || '/' || {OBJECT_NAME} AS object_key FROM chunks""",
    ),
    "prefix_normalise": """
        SELECT page_id, regexp_replace(url || '/', '/$', '') AS prefix FROM pages""",
    "size_chunks": _query(_chunks(EVENTS, q.EVENT_SIZE_RULE), ALL_CHUNKS),
    "interval_chunks": _query(_chunks(EVENTS, q.EVENT_INTERVAL_RULE), ALL_CHUNKS),
    "combined_chunks": _query(EVENT_CHUNKS, ALL_CHUNKS),
    "size_chunks_sliced": _query(_chunks(EVENTS, q.EVENT_SIZE_RULE), ALL_CHUNKS),
    "interval_chunks_sliced": _query(_chunks(EVENTS, q.EVENT_INTERVAL_RULE), ALL_CHUNKS),
    "combined_chunks_sliced": _query(EVENT_CHUNKS, ALL_CHUNKS),
    "timer_at_end": _query(_chunks(EVENTS, _later_rule()), ALL_CHUNKS),
    "chunk_summary": _query(DOCUMENT_CHUNKS, ALL_CHUNKS),
    "chunk_chaining": _query(
        DOCUMENT_CHUNKS, f"SELECT {KEY}, start_offset, end_offset FROM chunks"
    ),
    "open_tail": _query(CONVERSATION_CHUNKS, f"{ALL_CHUNKS} WHERE close_reason = 'open'"),
    "committed_chunks": _query(CONVERSATION_CHUNKS, f"{ALL_CHUNKS} WHERE close_reason <> 'open'"),
    "last_committed": _query(STARTS, f"SELECT {KEY}, last_committed FROM starts"),
    "start_position": _query(STARTS, "SELECT * FROM starts"),
    "resume_scan": _query(
        STARTS,
        f"""SELECT {KEY}, l."offset", l.size, s.start_offset
            FROM events_log l JOIN starts s USING ({KEY}) WHERE l."offset" > s.start_offset""",
    ),
    "lost_data_gap": _query(
        STARTS,
        f"""SELECT {KEY}, last_committed, log_start, log_start - last_committed AS lost,
                   CASE WHEN ignore_gaps THEN 'skip' ELSE 'fail' END AS action
            FROM starts WHERE log_start > last_committed""",
    ),
    "chunk_gap_check": _query(
        EVENT_CHUNKS,
        f"""SELECT {KEY}, previous_end, start_offset, end_offset,
                   start_offset - previous_end AS gap
            FROM (SELECT *, lag(end_offset) OVER (
                    PARTITION BY {KEY} ORDER BY start_offset) AS previous_end
                  FROM chunks WHERE close_reason = 'size')
            WHERE previous_end <> start_offset""",
    ),
    "partition_counters": _query(
        EVENT_CHUNKS,
        f"""SELECT {KEY},
          CAST(sum(CASE WHEN close_reason <> 'open' THEN message_count ELSE 0 END) AS BIGINT)
            AS committed_count,
          CAST(sum(CASE WHEN close_reason <> 'open' THEN message_bytes ELSE 0 END) AS BIGINT)
            AS committed_bytes,
          CAST(sum(CASE WHEN close_reason = 'open' THEN message_count ELSE 0 END) AS BIGINT)
            AS uncommitted_count,
          CAST(sum(CASE WHEN close_reason = 'open' THEN message_bytes ELSE 0 END) AS BIGINT)
            AS uncommitted_bytes,
          coalesce(max(CASE WHEN close_reason = 'open' THEN start_offset END),
                   max(end_offset)) AS start_offset,
          max(end_offset) AS end_offset
        FROM chunks GROUP BY {KEY}""",
    ),
    "archive_gauges": _query(
        ALL_TOPICS,
        "SELECT topic, count(*) AS total_partitions FROM partitions GROUP BY ROLLUP (topic)",
    ),
    "archive_roundtrip": _query(
        DOCUMENT_CHUNKS,
        ARCHIVED_DOCUMENTS.format(
            columns=", l.size AS payload_bytes, md5(l.payload) AS md5", where=""
        ),
    ),
    "archive_listing": _query(
        DOCUMENT_CHUNKS,
        f"""SELECT {KEY}, start_offset, end_offset, {OBJECT_NAME} AS name
            FROM chunks WHERE close_reason <> 'open'""",
    ),
    "offset_pruned_read": _query(
        DOCUMENT_CHUNKS,
        ARCHIVED_DOCUMENTS.format(columns="", where="AND c.end_offset > 200000"),
    ),
    "source_roundtrip": _query(
        DOCUMENT_CHUNKS,
        ARCHIVED_DOCUMENTS.format(
            columns=", l.size AS payload_bytes, md5(l.payload) AS md5", where=""
        ),
    ),
    "source_filtered_read": _query(
        DOCUMENT_CHUNKS,
        ARCHIVED_DOCUMENTS.format(
            columns="", where='AND l."offset" > 200000 AND l.partition_id = 1'
        ),
    ),
    "configured_partitions": """
        WITH t AS (
          SELECT lang AS topic, max(doc_id) % 3 + 1 AS n FROM documents GROUP BY lang
          UNION ALL SELECT 'none', 2)
        SELECT topic, 3::INTEGER AS broker_id, i::INTEGER AS partition_id,
               topic IN ('de', 'none') AS ignore_gaps
        FROM t, unnest(generate_series(0, n - 1)) AS g(i)""",
    "incremental_runs": _query(CONVERSATION_CHUNKS, CLOSED_RANGES),
    "stream_archive": _query(CONVERSATION_CHUNKS, CLOSED_RANGES),
    "stream_restart": _query(CONVERSATION_CHUNKS, CLOSED_RANGES),
    "stream_new_partition": _query(CONVERSATION_CHUNKS, CLOSED_RANGES),
    "stream_counters": _query(
        CONVERSATION_CHUNKS,
        f"""SELECT {KEY}, count(*) AS committed_chunks,
                   CAST(sum(message_count) AS BIGINT) AS committed_count,
                   CAST(sum(message_bytes) AS BIGINT) AS committed_bytes
            FROM chunks WHERE close_reason <> 'open' GROUP BY {KEY}""",
    ),
    "archive_windows": _query(
        DOCUMENT_CHUNKS,
        f"""SELECT {KEY}, start_offset, end_offset, {OBJECT_NAME} AS name
            FROM chunks WHERE close_reason <> 'open'""",
    ),
    "object_name_foreign": """
        SELECT page_id, printf('3_%d_%019d_%019d', page_id % 7, page_id, page_id + 10) AS name,
               3::INTEGER AS broker_id, (page_id % 7)::INTEGER AS partition_id,
               page_id AS start_offset, page_id + 10 AS end_offset, false AS rejected
        FROM pages WHERE page_id % 5 = 0
        UNION ALL SELECT page_id, 'notes-' || page_id || '.txt', NULL, NULL, NULL, NULL, true
        FROM pages WHERE page_id % 5 = 1
        UNION ALL SELECT page_id, '3_' || page_id % 7 || '_x' || page_id || '_5',
               3, (page_id % 7)::INTEGER, NULL, 5, false FROM pages WHERE page_id % 5 = 2
        UNION ALL SELECT page_id, '3_1_' || page_id, 3, 1, page_id, NULL, true
        FROM pages WHERE page_id % 5 = 3
        UNION ALL SELECT page_id, '3_1_5_' || (page_id + 5) || '_extra', 3, 1, 5, page_id + 5, false
        FROM pages WHERE page_id % 5 = 4""",
    "prefix_slashes": """
        SELECT page_id, CASE WHEN p LIKE '%/' THEN left(p, length(p) - 1) ELSE p END AS prefix
        FROM (SELECT page_id, url || repeat('/', page_id % 3) AS p FROM pages)""",
    "partition_zero_counts": """
        SELECT lang AS topic, 3::INTEGER AS broker_id, i::INTEGER AS partition_id
        FROM (SELECT lang, max(doc_id % 4) AS top FROM documents
              WHERE lang NOT IN ('de', 'fr') GROUP BY lang),
             unnest(generate_series(0, top)) AS g(i)""",
}
