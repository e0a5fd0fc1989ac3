"""Write planned chunks as SequenceFiles, one object per chunk.

Chunks are written window by window. A window's files are first written to a
staging folder, then renamed to their final names. The names are stored next to
the files before the first rename, so a run that dies in between is completed by
`recover`.

One Spark job writes the files of many windows, each into its window's own folder,
and one task those of neighbouring chunks, so neither small windows nor small
chunks cost a job or a task each.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import groupby, islice
from operator import and_

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstow.functions.names import OBJECT_PATH_FORMAT, RECORD_KEY_FORMAT, record_key
from logstow.functions.record_files import RecordWriter
from logstow.hadoop import Folder
from logstow.model import KEY_CLASS, PARTITION_KEY, VALUE_CLASS
from logstow.shared_dir import shared_dir

# The archive's file format.
OUTPUT_FORMAT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"
COMPRESSION = {
    "mapreduce.output.fileoutputformat.compress": "true",
    "mapreduce.output.fileoutputformat.compress.type": "BLOCK",
    "mapreduce.output.fileoutputformat.compress.codec": "org.apache.hadoop.io.compress.BZip2Codec",
}
# Tasks move their own file out of the attempt folder; without a _SUCCESS mark
# a window is dropped as a whole.
COMMITTER = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}

# Where a rename copies the object, and the settings that reach it.
OBJECT_STORE = re.compile("^s3[an]?://")
STORE_SETTINGS = {
    "access_key": "fs.s3a.access.key",
    "secret_key": "fs.s3a.secret.key",
    "session_token": "fs.s3a.session.token",
    "endpoint_override": "fs.s3a.endpoint",
    "region": "fs.s3a.endpoint.region",
}

# No topic may contain this character, so the folder cannot be one.
STAGING = "~staging"

# Chunks per window: what is staged, marked as written and recovered together.
CHUNKS_PER_JOB = 4000
# Windows share a write job up to so many chunks, the rows of its broadcast, and bytes.
CHUNKS_AT_ONCE, BYTES_AT_ONCE = 1 << 16, 64 << 30
# Payload bytes that a task writes, unless one chunk has more.
TASK_BYTES = 32 << 20
# Arrow rows turned into Python objects at a time.
SLICE_ROWS = 256
# Ranges that a scan filter spells out; with more it names one range per topic.
RANGES_IN_FILTER = 2000

Range = tuple[str, int, int, int, int]
Messages = DataFrame | Callable[[list[Range]], DataFrame]


def partition_ranges(chunks: list[tuple]) -> list[Range]:
    """Offset range of each partition over a window of chunks sorted by partition."""
    out = []
    for key, group in groupby(chunks, key=lambda c: tuple(c[:3])):
        group = list(group)
        out.append((*key, min(c[3] for c in group), max(c[4] for c in group)))
    return out


def _any_of(conditions: list):
    """Disjunction as a balanced tree, so that its depth stays small."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2], strict=False)
        odd = conditions[-1:] if len(conditions) % 2 else []
        conditions = [a | b for a, b in pairs] + odd
    return conditions[0]


def range_filter(ranges: list[Range]):
    """Scan filter for the ranges (topic, broker, partition, low, high].

    Partitions of a topic with equal ranges share a condition. high may be None,
    for no end. Beyond RANGES_IN_FILTER conditions, each topic has one, from its
    lowest to its highest offset; the exact ranges are joined later in any case.
    """
    grouped: dict[tuple, list[int]] = {}
    for topic, broker, partition, low, high in ranges:
        grouped.setdefault((topic, broker, low, high), []).append(partition)
    if len(grouped) > RANGES_IN_FILTER:
        by_topic: dict[str, list[tuple]] = {}
        for topic, _, low, high in grouped:
            by_topic.setdefault(topic, []).append((low, high))
        grouped = {
            (
                topic,
                None,
                min(low for low, _ in own),
                None if any(h is None for _, h in own) else max(h for _, h in own),
            ): []
            for topic, own in by_topic.items()
        }

    def condition(topic, broker, low, high, partitions):
        parts = [F.col("topic") == topic, F.col("offset") > low]
        if partitions:
            parts += [F.col("broker_id") == broker, F.col("partition_id").isin(partitions)]
        if high is not None:
            parts.append(F.col("offset") <= high)
        return reduce(and_, parts)

    if not grouped:
        return F.lit(False)
    return _any_of([condition(*key, sorted(set(p))) for key, p in grouped.items()])


def assign_chunks(messages: DataFrame, chunks: list[tuple], few: bool = True) -> DataFrame:
    """Messages with `chunk_no`, the position of their chunk in the list.

    A range join: chunks are spread over offset buckets as wide as the average
    chunk, which makes at most three rows per chunk, and messages meet the few
    chunks of their own bucket.

    few: the chunks are those of one window, whose number is bounded, and are
        broadcast. Else Spark chooses by size.
    """
    spark = messages.sparkSession
    width = max(1, sum(c[4] - c[3] for c in chunks) // len(chunks))
    table = spark.createDataFrame(
        [(*c[:5], i) for i, c in enumerate(chunks)],
        "topic string, broker_id int, partition_id int, low long, high long, chunk_no int",
    ).withColumn("bucket", F.explode(F.expr(f"sequence((low + 1) div {width}, high div {width})")))
    return (
        messages.withColumn("bucket", F.expr(f"offset div {width}"))
        .join(F.broadcast(table) if few else table, [*PARTITION_KEY, "bucket"])
        .filter((F.col("offset") > F.col("low")) & (F.col("offset") <= F.col("high")))
        .drop("bucket", "low", "high")
    )


def deal_tasks(chunks: list[tuple], parallelism: int) -> list[int]:
    """The task that writes each chunk: neighbours share one, up to its share of bytes."""
    share = min(TASK_BYTES, sum(c[6] + 1 for c in chunks) // (4 * parallelism) + 1)
    tasks, task, held = [], 0, 0
    for c in chunks:
        if held and held + c[6] + 1 > share:
            task, held = task + 1, 0
        held += c[6] + 1
        tasks.append(task)
    return tasks


def _checked_records(expected: list[int]):
    """Records of chunk i for the writer; a chunk with a missing message fails."""

    def run(i: int, rows: Iterator) -> Iterator[tuple[str, bytearray]]:
        n = 0
        for row in rows:
            n += 1
            yield row.key, bytearray(row.value)
        if n != expected[i]:
            raise ValueError(f"chunk {i}: {n} messages read, {expected[i]} planned")

    return run


def _write_by_hadoop(messages: DataFrame, chunks: list[tuple], path: str) -> None:
    """One window through Hadoop's own output format, for stores only it can reach."""
    rows = (
        assign_chunks(messages, chunks)
        .select("chunk_no", "offset", record_key().alias("key"), "value")
        .repartitionById(len(chunks), F.col("chunk_no"))
        .sortWithinPartitions("offset")
        .select("key", "value")
    )
    rows.rdd.mapPartitionsWithIndex(
        _checked_records([c[5] for c in chunks])
    ).saveAsNewAPIHadoopFile(
        path, OUTPUT_FORMAT, keyClass=KEY_CLASS, valueClass=VALUE_CLASS, conf=COMPRESSION | COMMITTER
    )


def _write_files(base: str, options: dict[str, str]):
    """Writes the files of a task's chunks. Of each, a row with `head` comes first, which
    names the file, then its messages; a chunk with a missing message fails.

    Where an object appears as a whole when it is closed, attempts of a task may write
    the same name; elsewhere each writes a file of its own and renames it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem_of(base, options)
        whole = OBJECT_STORE.match(base)
        head, out, name, n = None, None, None, 0

        def finish() -> int:
            if head is None:
                return 0
            out.close()
            if n != head["planned"]:
                raise ValueError(f"chunk {head['file']}: {n} messages read, {head['planned']} planned")
            if name != head["file"]:
                store.move(f"{root}/{name}", f"{root}/{head['file']}")
            return 1

        for batch in batches:
            files = 0
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for begins, offset, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if begins is not None:
                        files += finish()
                        head, n = begins, 0
                        name = begins["file"] + ("" if whole else f".{uuid.uuid4().hex}")
                        out = RecordWriter(store.open_output_stream(f"{root}/{name}"))
                        key = (begins["topic"], begins["broker_id"], begins["partition_id"])
                        continue
                    out.add((RECORD_KEY_FORMAT % (*key, offset)).encode(), value)
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])
        yield pa.RecordBatch.from_arrays([pa.array([finish()], pa.int64())], names=["files"])

    return run


def _write_window(
    messages: DataFrame,
    windows: list[list[tuple]],
    archive: Folder,
    stages: list[str],
    in_tasks: bool = False,
) -> None:
    """Write the files of some windows to their stages by one job, and mark them as written."""
    spark = messages.sparkSession
    if not _in_reach(archive, in_tasks):
        for window, stage in zip(windows, stages, strict=True):
            _write_by_hadoop(messages, window, f"{archive.path}/{stage}/data")
        return
    options = store_options(spark, archive.path)
    chunks = [c for window in windows for c in window]
    tasks = deal_tasks(chunks, spark.sparkContext.defaultParallelism)
    files = [
        f"{stage}/data/{_part_file(i)}"
        for window, stage in zip(windows, stages, strict=True)
        for i in range(len(window))
    ]
    table = spark.createDataFrame(
        [(i, t, f, *c[:3], c[5]) for i, (t, f, c) in enumerate(zip(tasks, files, chunks, strict=True))],
        "chunk_no int, task int, file string, topic string, broker_id int, partition_id int, "
        "planned long",
    )
    head = F.struct("file", "topic", "broker_id", "partition_id", "planned")
    heads = table.select(
        "task", "chunk_no", head.alias("head"),
        F.lit(None).cast("long").alias("offset"), F.lit(None).cast("binary").alias("value"),
    )
    payloads = (
        assign_chunks(messages.select(*PARTITION_KEY, "offset", "value"), chunks)
        .join(F.broadcast(table.select("chunk_no", "task")), "chunk_no")
        .select("task", "chunk_no", F.lit(None).cast(heads.schema["head"].dataType).alias("head"), "offset", "value")
    )
    written = (
        payloads.unionByName(heads)
        .repartitionById(tasks[-1] + 1, F.col("task"))
        .sortWithinPartitions("chunk_no", F.col("offset").asc_nulls_first())
        .select("head", "offset", "value")
        .mapInArrow(_write_files(archive.path, options), "files long")
        .agg(F.sum("files"))
        .first()[0]
    )
    if written != len(chunks):
        raise ValueError(f"{written} files written, {len(chunks)} planned")
    store, root = filesystem_of(archive.path, options)
    for stage in stages:
        store.open_output_stream(f"{root}/{stage}/data/_SUCCESS").close()


NAMES = pa.schema(
    [
        ("topic", pa.string()),
        ("broker_id", pa.int32()),
        ("partition_id", pa.int32()),
        ("start_offset", pa.int64()),
        ("end_offset", pa.int64()),
        ("chunk_no", pa.int32()),
    ]
)
NAMES_SQL = (
    "topic string, broker_id int, partition_id int, start_offset long, end_offset long, "
    "chunk_no int"
)


def _in_reach(archive: Folder, in_tasks: bool) -> bool:
    """Whether pyarrow's file systems reach the archive, not only Hadoop's. That they
    reach an object store is what a caller says by `in_tasks`."""
    return archive.scheme == "file" or (in_tasks and bool(OBJECT_STORE.match(archive.path)))


def _stage_names(
    spark: SparkSession,
    archive: Folder,
    windows: list[list[tuple]],
    stages: list[str],
    threads: int,
    in_tasks: bool = False,
) -> None:
    """Empty the windows' folders and store there what their files are to be named."""
    reach = _in_reach(archive, in_tasks)
    if reach:
        store, root = filesystem_of(archive.path, store_options(spark, archive.path))

    def stage_window(window: list[tuple], stage: str) -> None:
        archive.delete(stage)
        rows = [(*c[:5], i) for i, c in enumerate(window)]
        if not reach:
            spark.createDataFrame(rows, NAMES_SQL).write.parquet(f"{archive.path}/{stage}/names")
            return
        for below in ("names", "data"):
            archive.make(f"{stage}/{below}")
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), NAMES, strict=True)]
        table = pa.Table.from_arrays(columns, schema=NAMES)
        pq.write_table(table, f"{root}/{stage}/names/part-0.parquet", filesystem=store)

    with ThreadPoolExecutor(threads) as pool:
        for _ in pool.map(stage_window, windows, stages):
            pass


def _publish_window(
    spark: SparkSession, archive: Folder, window: str, threads: int, in_tasks: bool = False
) -> int:
    """Rename a finished window's files, by the names that are stored with them."""
    names = spark.read.schema(NAMES_SQL).parquet(f"{archive.path}/{window}/names")
    rows = [(window, r.chunk_no, *tuple(r)[:5]) for r in names.collect()]
    return _publish(spark, archive, rows, threads, in_tasks)


def _publish(
    spark: SparkSession, archive: Folder, rows: list[tuple], threads: int, in_tasks: bool = False
) -> int:
    """Rename finished windows' files to their object names.

    rows: (window, chunk_no, topic, broker, partition, start, end) of each.

    A topic partition is renamed in ascending offset order by one thread, or one
    task, which stops at its first failure: whatever happens, the archive of a
    partition has no hole. An object that is already there was published by an
    earlier attempt.
    """
    for topic in sorted({r[2] for r in rows}):
        archive.make(topic)
    windows = sorted({r[0] for r in rows})
    files = [
        (*r[2:6], f"{r[0]}/data/{_part_file(r[1])}", OBJECT_PATH_FORMAT % r[2:7]) for r in rows
    ]
    if in_tasks:
        n = _rename_in_tasks(spark, files, archive.path)
    else:
        n = _rename_here(files, archive, windows, threads)
    with ThreadPoolExecutor(threads) as pool:
        for _ in pool.map(archive.delete, windows):
            pass
    return n


def _part_file(chunk_no: int) -> str:
    return f"part-r-{chunk_no:05d}"


def _rename_here(files: list[tuple], archive: Folder, windows: list[str], threads: int) -> int:
    """files: (topic, broker, partition, start, staged file, target) of each."""

    def staged_in(window: str) -> list[str]:
        names = Folder(archive.spark, f"{archive.path}/{window}/data").names()
        return [f"{window}/data/{name}" for name in names]

    def move_partition(group: list[tuple]) -> None:
        for *_, part, target in group:
            if archive.exists(target):
                continue
            if part not in staged:
                raise FileNotFoundError(f"{part} for {target}")
            if not archive.rename(part, target):
                raise OSError(f"cannot publish {target}")

    groups = [list(own) for _, own in groupby(sorted(files), key=lambda f: f[:3])]
    with ThreadPoolExecutor(threads) as pool:
        staged = {file for some in pool.map(staged_in, windows) for file in some}
        for _ in pool.map(move_partition, groups):
            pass
    return len(files)


def _rename_in_tasks(spark: SparkSession, files: list[tuple], base: str) -> int:
    """The same in Spark tasks, for stores where a rename copies the object.

    Tasks reach the store through pyarrow, with the session's credentials for it.
    """
    options = store_options(spark, base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem_of(base, options)
        for batch in batches:
            for part, target in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                source = f"{root}/{part}"
                there, staged = store.get_file_info([f"{root}/{target}", source])
                if there.type == fs.FileType.NotFound:
                    if staged.type == fs.FileType.NotFound:
                        raise FileNotFoundError(f"{source} for {target}")
                    store.move(source, f"{root}/{target}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    moved = (
        spark.createDataFrame(
            files,
            "topic string, broker_id int, partition_id int, start_offset long, part string, "
            "target string",
        )
        .repartition(*PARTITION_KEY)
        .sortWithinPartitions(*PARTITION_KEY, "start_offset")
        .select("part", "target")
        .mapInArrow(run, "n long")
    )
    return moved.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def store_options(spark: SparkSession, base: str) -> dict[str, str]:
    """What the session's Hadoop settings say of the object store, in pyarrow's words."""
    if not OBJECT_STORE.match(base):
        return {}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    found = {ours: hadoop.get(name) for ours, name in STORE_SETTINGS.items()}
    options = {ours: value for ours, value in found.items() if value}
    scheme, there, host = options.get("endpoint_override", "").partition("://")
    if there:
        options |= {"endpoint_override": host, "scheme": scheme}
    return options


def filesystem_of(base: str, options: dict[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """The store of a base folder, and the folder's path in it.

    options: of an object store, as `store_options` has them; without any, pyarrow
        looks for credentials in its own environment.
    """
    if "://" not in base and not base.startswith("file:"):
        return fs.LocalFileSystem(), base.rstrip("/")
    if options:
        return fs.S3FileSystem(**options), OBJECT_STORE.sub("", base).rstrip("/")
    store, root = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", base))
    return store, root.rstrip("/")


def recover(
    spark: SparkSession, base: str, owner: str, threads: int = 32, in_tasks: bool = False
) -> int:
    """Finish what an interrupted run of the same owner left in staging.

    Windows that were completely written are published; others are dropped,
    their messages are still unread as far as the archive is concerned.
    """
    archive = Folder(spark, base)
    staging = f"{STAGING}/{owner}"
    published = 0
    for name in Folder(spark, f"{archive.path}/{staging}").names():
        window = f"{staging}/{name}"
        if archive.exists(f"{window}/data/_SUCCESS"):
            published += _publish_window(spark, archive, window, threads, in_tasks)
        else:
            archive.delete(window)
    return published


def _windows(chunks: DataFrame, chunks_per_job: int) -> Iterator[list[tuple]]:
    """The chunk rows in partition and offset order, so many at a time."""
    rows = (
        chunks.select(
            *PARTITION_KEY, "start_offset", "end_offset", "message_count", "message_bytes"
        )
        .orderBy(*PARTITION_KEY, "start_offset")
        .toLocalIterator()
    )
    while window := [tuple(r) for r in islice(rows, chunks_per_job)]:
        yield window


def jobs_of(windows: Iterable[list[tuple]]) -> Iterator[list[list[tuple]]]:
    """Neighbouring windows that one job writes; a window is never cut."""
    job, chunks, size = [], 0, 0
    for window in windows:
        more = sum(c[6] for c in window)
        if job and (chunks + len(window) > CHUNKS_AT_ONCE or size + more > BYTES_AT_ONCE):
            yield job
            job, chunks, size = [], 0, 0
        job.append(window)
        chunks, size = chunks + len(window), size + more
    if job:
        yield job


def _split_by_window(
    messages: DataFrame, windows: list[list[Range]], path: str
) -> Callable[[int], DataFrame]:
    """Write the messages once, by window, so that no window scans the whole log.

    The rebalance hint lets Spark cut large windows into several tasks and files.
    """
    numbered = [(r, no) for no, ranges in enumerate(windows) for r in ranges]
    window_of = messages.sparkSession.createDataFrame(
        [(i, no) for i, (_, no) in enumerate(numbered)], "chunk_no int, window int"
    )
    (
        assign_chunks(messages, [r for r, _ in numbered], few=False)
        .join(window_of, "chunk_no")
        .select(*PARTITION_KEY, "offset", "value", "window")
        .hint("rebalance", "window")
        .write.partitionBy("window")
        .parquet(path)
    )
    return lambda no: messages.sparkSession.read.parquet(f"{path}/window={no}")


def write_chunks(
    messages: Messages,
    chunks: DataFrame,
    base: str,
    owner: str = "default",
    chunks_per_job: int = CHUNKS_PER_JOB,
    threads: int = 32,
    scans: int = 2,
    in_tasks: bool = False,
) -> int:
    """Archive the given chunks; returns how many objects were published.

    messages: the log, as a DataFrame with `value`, or a function that reads
        given ranges (topic, broker, partition, low, high] of it.
    chunks: chunk rows to publish. They are walked in partition and offset
        order, a window at a time, so they should come from a written table.
    owner: names the staging folder; writers that run at the same time on the
        same archive must differ in it.
    chunks_per_job: chunks of a window. A job writes one window, or more up to
        CHUNKS_AT_ONCE chunks and BYTES_AT_ONCE bytes.
    scans: with more jobs than this, a log without a range reader is first
        split by job, instead of being scanned once for each.
    in_tasks: rename in Spark tasks, for object stores, where a rename is a copy; else
        the driver does, which is right where a rename only touches metadata. Without it
        other stores than files are written through Hadoop, a job a window.
    """
    spark = chunks.sparkSession
    archive = Folder(spark, base)
    ranges, split = [], None
    if not callable(messages):
        ranges = [
            partition_ranges([c for window in job for c in window])
            for job in jobs_of(_windows(chunks, chunks_per_job))
        ]
        if len(ranges) > scans:
            split = _split_by_window(messages, ranges, shared_dir(spark, "windows"))

    def source_of(no: int, job: list[list[tuple]]) -> DataFrame:
        if callable(messages):
            return messages(partition_ranges([c for window in job for c in window]))
        return split(no) if split else messages.filter(range_filter(ranges[no]))

    published, publishing, first = 0, None, 0
    with ThreadPoolExecutor(1) as publisher:
        for no, job in enumerate(jobs_of(_windows(chunks, chunks_per_job))):
            stages = [f"{STAGING}/{owner}/w{first + i:08d}" for i in range(len(job))]
            first += len(job)
            _stage_names(spark, archive, job, stages, threads, in_tasks)
            _write_window(source_of(no, job), job, archive, stages, in_tasks)
            named = [
                (stage, i, *c[:5])
                for stage, window in zip(stages, job, strict=True)
                for i, c in enumerate(window)
            ]
            # One job's files are renamed while those of the next one are being written.
            if publishing is not None:
                published += publishing.result()
            publishing = publisher.submit(_publish, spark, archive, named, threads, in_tasks)
        if publishing is not None:
            published += publishing.result()
    return published
