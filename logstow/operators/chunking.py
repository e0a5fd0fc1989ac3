"""Cut topic partitions into chunks.

The size rule restarts its sum at every chunk, so a chunk's end depends on the
end of the one before it; a window sum cannot express that. Messages are
therefore sorted within their partition and folded batch by batch in
`mapInArrow`, with nothing but offsets, sizes and arrival times in flight.

A partition with more messages than `Slicing.rows` is not left to a single task:
`logstow.operators.slices` cuts it into offset ranges that are worked on in
parallel, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstow.functions.names import payload_size
from logstow.model import CHUNK_SCHEMA, PARTITION_KEY, ChunkRule, Slicing
from logstow.operators.open_chunk import OpenChunk, feed, finish

MAPPED_PARTITIONS = 200_000


def key_runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of equal keys in a batch sorted by them: (key, start, stop)."""
    n = batch.num_rows
    if n == 0:
        return
    changed = np.zeros(n - 1, dtype=bool)
    columns = [batch.column(k) for k in keys]
    for column in columns:
        codes = column.dictionary_encode().indices if pa.types.is_string(column.type) else column
        values = codes.to_numpy(zero_copy_only=False)
        changed |= values[1:] != values[:-1]
    starts = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
    for start, stop in zip(starts[:-1], starts[1:]):
        yield tuple(c[start].as_py() for c in columns), start, stop


def long_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    if column.null_count:
        raise ValueError(f"column {name} must not hold nulls")
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


CLOSED_ARROW = pa.schema(
    [
        ("start_offset", pa.int64()),
        ("end_offset", pa.int64()),
        ("message_count", pa.int64()),
        ("message_bytes", pa.int64()),
        ("close_reason", pa.string()),
    ]
)
KEY_ARROW = {
    "topic": pa.string(),
    "broker_id": pa.int32(),
    "partition_id": pa.int32(),
    "id": pa.int32(),
}
KEY_SQL = {"topic": "string", "broker_id": "int", "partition_id": "int", "id": "int"}
CLOSED_SQL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHUNK_SCHEMA[3:])


def sizes_and_arrivals(batch: pa.RecordBatch, rule: ChunkRule):
    sizes = long_column(batch, "size")
    return sizes, long_column(batch, "arrival_ms") if rule.interval_ms is not None else None


def part_of(arrivals, i: int, j: int):
    return None if arrivals is None else arrivals[i:j]


def _fold_partitions(rule: ChunkRule, keys: list[str], starts: dict[int, int] | None):
    schema = pa.schema([(k, KEY_ARROW[k]) for k in keys] + list(CLOSED_ARROW))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk = None, None
        for batch in batches:
            offsets = long_column(batch, "offset")
            sizes, arrivals = sizes_and_arrivals(batch, rule)
            rows = []
            for run_key, i, j in key_runs(batch, keys):
                if run_key != key:
                    if key is not None:
                        rows += [(*key, *row) for row in finish(chunk, rule)]
                    if starts is None:
                        start = batch.column("start_offset")[i].as_py()
                    else:
                        start = starts[run_key[0]]
                    key, chunk = run_key, OpenChunk.at(start, rule)
                closed = feed(chunk, offsets[i:j], sizes[i:j], part_of(arrivals, i, j), rule)
                rows += [(*key, *row) for row in closed]
            if rows:
                yield arrow_rows(rows, schema)
        if key is not None:
            yield arrow_rows([(*key, *row) for row in finish(chunk, rule)], schema)

    return fold


def message_sizes(messages: DataFrame, rule: ChunkRule) -> DataFrame:
    """What chunking needs of the messages: no payload.

    Takes `size` if the input has it, else the size of `value`. Partitions
    start at `start_offset` if present, else at 0. Arrival times are only read
    when the interval rule is on.
    """
    have = set(messages.columns)
    size = F.col("size") if "size" in have else payload_size()
    start = F.col("start_offset") if "start_offset" in have else F.lit(0)
    arrival = [F.col("arrival_ms").cast("long").alias("arrival_ms")]
    return messages.select(
        *PARTITION_KEY,
        "offset",
        size.cast("int").alias("size"),
        *(arrival if rule.interval_ms is not None else []),
        start.cast("long").alias("start_offset"),
    )


def fold_partitions(
    sizes: DataFrame, rule: ChunkRule, keys: list[str], starts: dict[int, int] | None
) -> DataFrame:
    """One task per topic partition, streamed in offset order.

    starts: start offset per key; taken from the column of that name if None.
    """
    schema = ", ".join([f"{k} {KEY_SQL[k]}" for k in keys] + [CLOSED_SQL])
    return (
        sizes.repartition(*keys)
        .sortWithinPartitions(*keys, "offset")
        .mapInArrow(_fold_partitions(rule, keys, starts), schema)
    )


def _numbered(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(
        [(r.topic, r.broker_id, r.partition_id, i) for i, r in enumerate(rows)],
        "topic string, broker_id int, partition_id int, id int",
    )


def plan_chunks(
    messages: DataFrame,
    rule: ChunkRule,
    slicing: Slicing = Slicing(),
    mapped_partitions: int = MAPPED_PARTITIONS,
) -> DataFrame:
    """Chunks of all partitions: offset range, messages, bytes, close reason.

    The reason is `size`, `interval`, or `open` for the tail that stays
    uncommitted. Offsets must be unique within a partition; a repeated one
    fails the job.

    slicing: which partitions are planned in slices, and how.
    mapped_partitions: up to so many topic partitions are replaced by numbers,
        which keeps topic names out of the shuffle; the map is broadcast.
    """
    from logstow.operators.slices import plan_hot_chunks

    spark = messages.sparkSession
    sizes = message_sizes(messages, rule)
    # One column-pruned counting job; its result has a row per topic partition.
    counts = sizes.groupBy(*PARTITION_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.max("start_offset").alias("start_offset")
    )
    listed = counts.limit(mapped_partitions + 1).collect()
    whole = len(listed) <= mapped_partitions
    if not whole:
        # There are at most (all messages / slicing.rows) hot partitions.
        listed = counts.filter(F.col("n") > slicing.rows).collect()
    table = _numbered(spark, listed)
    starts = {i: r.start_offset for i, r in enumerate(listed)}
    hot = {i: r.n for i, r in enumerate(listed) if r.n > slicing.rows}

    numbered = sizes.join(F.broadcast(table), PARTITION_KEY).drop(*PARTITION_KEY, "start_offset")
    planned = []
    if whole:
        cold = numbered.filter(~F.col("id").isin(list(hot))) if hot else numbered
        planned.append(fold_partitions(cold, rule, ["id"], starts))
    if hot:
        busy = numbered.filter(F.col("id").isin(list(hot)))
        planned.append(plan_hot_chunks(busy, hot, starts, rule, slicing))
    columns = [f.name for f in CHUNK_SCHEMA]
    if planned:
        named = planned[0] if len(planned) == 1 else planned[0].unionByName(planned[1])
        named = named.join(F.broadcast(table), "id").select(columns)
    if whole:
        return named
    rest = sizes.join(F.broadcast(table), PARTITION_KEY, "left_anti") if hot else sizes
    wide = fold_partitions(rest, rule, PARTITION_KEY, None).select(columns)
    return wide.unionByName(named) if planned else wide


def closed_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks that may be committed: not the open tail, and not empty."""
    return chunks.filter(
        (F.col("close_reason") != "open") & (F.col("start_offset") != F.col("end_offset"))
    )


def open_tails(chunks: DataFrame) -> DataFrame:
    """The uncommitted tail of each partition; the next run reads it again."""
    return chunks.filter(F.col("close_reason") == "open")


def chain_chunks(ends: DataFrame, starts: DataFrame) -> DataFrame:
    """Start offsets for chunks of which only the ends are known.

    A chunk starts where the one before it ends, the first one at the
    partition's start position. One row per chunk goes through the window.
    """
    w = Window.partitionBy(*PARTITION_KEY).orderBy("end_offset")
    return (
        ends.join(starts.select(*PARTITION_KEY, "start_offset"), PARTITION_KEY)
        .withColumn(
            "start_offset", F.coalesce(F.lag("end_offset").over(w), F.col("start_offset"))
        )
    )
