"""The archive as a Spark data source: `spark.read.format("logstow")` and
`df.write.format("logstow")`.

Reading plans by object names: filters on topic, broker, partition and offset leave
objects unopened, and objects are dealt to tasks by their size. Writing streams each
chunk to a staged file in a task; when all tasks are done their messages are stored
as the list of what is to be published, and the files are renamed in offset order.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from logstow.functions.names import OBJECT_PATH_FORMAT, RECORD_KEY_FORMAT
from logstow.functions.record_files import RecordWriter, read_records
from logstow.model import PARTITION_KEY
from logstow.sinks.sequence_files import (
    CHUNKS_PER_JOB,
    STAGING,
    Messages,
    _windows,
    assign_chunks,
    deal_tasks,
    filesystem_of,
    jobs_of,
    partition_ranges,
    range_filter,
)

NAME = "logstow"
READ_SCHEMA = "topic string, broker_id int, partition_id int, offset long, value binary"
#: What a row of a write is: a message, and the chunk that it belongs to.
WRITE_COLUMNS = [*PARTITION_KEY, "start_offset", "end_offset", "message_count", "offset", "value"]
OBJECT_NAME = re.compile(r"(\d+)_(\d+)_(\d+)_(\d+)")
#: Compressed bytes of objects that a task reads.
TASK_BYTES = 128 << 20
#: Records and payload bytes of an Arrow batch.
BATCH_RECORDS, BATCH_BYTES = 4096, 8 << 20
# The list of a finished write, next to its staged files.
LIST = "names.json"


@dataclass
class Objects(InputPartition):
    """Objects that one task reads: (path, topic, broker, partition)."""

    found: list[tuple[str, str, int, int]]


@dataclass
class Chunks(WriterCommitMessage):
    """What one task has staged: (file, topic, broker, partition, start, end)."""

    staged: list[tuple[str, str, int, int, int, int]]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["path"]
        self.topics = [t for t in options.get("topics", "").split(",") if t] or None
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.allowed: dict[str, set] = {}
        # Offsets that may be asked for lie in (low, high].
        self.low, self.high = -1, None

    def _learn(self, one: Filter) -> None:
        column = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
        if column in PARTITION_KEY and isinstance(one, EqualTo | EqualNullSafe | In):
            values = set(one.value) if isinstance(one, In) else {one.value}
            self.allowed[column] = self.allowed.get(column, values) & values
        if column != "offset" or getattr(one, "value", None) is None:
            return
        if isinstance(one, EqualTo | EqualNullSafe | GreaterThan | GreaterThanOrEqual):
            low = one.value if isinstance(one, GreaterThan) else one.value - 1
            self.low = max(self.low, low)
        if isinstance(one, EqualTo | EqualNullSafe | LessThan | LessThanOrEqual):
            high = one.value - 1 if isinstance(one, LessThan) else one.value
            self.high = high if self.high is None else min(self.high, high)

    def _wanted(self, topic: str, broker: int, partition: int, start: int, end: int) -> bool:
        key = dict(zip(PARTITION_KEY, (topic, broker, partition), strict=True))
        if any(key[c] not in values for c, values in self.allowed.items()):
            return False
        return end > self.low and (self.high is None or start < self.high)

    def objects(self) -> list[tuple[int, tuple[str, str, int, int]]]:
        """(size, object) of all objects that may hold rows; only their names are read."""
        store, root = filesystem_of(self.base)
        topics = self.topics
        if topics is None:
            below = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
            topics = [i.base_name for i in below if i.type == fs.FileType.Directory]
        out = []
        for topic in sorted(set(topics) - {STAGING}):
            if topic not in self.allowed.get("topic", {topic}):
                continue
            for info in store.get_file_info(fs.FileSelector(f"{root}/{topic}", allow_not_found=True)):
                name = OBJECT_NAME.fullmatch(info.base_name)
                if name is None or info.type != fs.FileType.File:
                    continue
                broker, partition, start, end = map(int, name.groups())
                if self._wanted(topic, broker, partition, start, end):
                    out.append((info.size, (info.path, topic, broker, partition)))
        return out

    def partitions(self) -> list[Objects]:
        parts, held = [], 0
        for size, one in sorted(self.objects(), key=lambda x: x[1]):
            if not parts or held + size > self.task_bytes:
                parts.append(Objects([]))
                held = 0
            parts[-1].found.append(one)
            held += size
        return parts or [Objects([])]

    def read(self, partition: Objects) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem_of(self.base)
        for path, topic, broker, no in partition.found:
            offsets, values, size = [], [], 0
            with store.open_input_stream(path) as source:
                for key, value in read_records(source):
                    offsets.append(int(key.rsplit(b":", 1)[1]))
                    values.append(value)
                    size += len(value)
                    if len(offsets) >= BATCH_RECORDS or size >= BATCH_BYTES:
                        yield _batch(topic, broker, no, offsets, values)
                        offsets, values, size = [], [], 0
            if offsets:
                yield _batch(topic, broker, no, offsets, values)


class FilteringReader(ArchiveReader):
    """A reader that Spark hands its filters; Spark still applies them to the rows."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            self._learn(one)
            yield one


def _batch(topic: str, broker: int, partition: int, offsets: list, values: list) -> pa.RecordBatch:
    n = len(offsets)
    columns = [
        pa.array([topic] * n, pa.string()),
        pa.array([broker] * n, pa.int32()),
        pa.array([partition] * n, pa.int32()),
        pa.array(offsets, pa.int64()),
        pa.array(values, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*PARTITION_KEY, "offset", "value"])


class ArchiveWriter(DataSourceArrowWriter):
    """Rows of a chunk must come to one task, one after the other in offset order."""

    def __init__(self, options: dict, columns: list[str]):
        missing = set(WRITE_COLUMNS) - set(columns)
        if missing:
            raise ValueError(f"columns missing for the archive: {sorted(missing)}")
        self.base, self.owner = options["path"], options.get("owner", "default")
        self.job = uuid.uuid4().hex

    def _folder(self, root: str) -> str:
        return f"{root}/{STAGING}/{self.owner}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Chunks:
        store, root = filesystem_of(self.base)
        folder = self._folder(root)
        store.create_dir(folder, recursive=True)
        staged, current, out, n = [], None, None, 0

        def finish() -> None:
            if current is None:
                return
            out.close()
            if n != current[5]:
                raise ValueError(f"chunk {current[:5]}: {n} messages read, {current[5]} planned")
            staged.append((name, *current[:5]))

        for batch in iterator:
            for *chunk, offset, value in zip(
                *(batch.column(c).to_pylist() for c in WRITE_COLUMNS), strict=True
            ):
                if chunk != current:
                    finish()
                    # No two attempts of a task share a file.
                    name = f"{uuid.uuid4().hex}-{len(staged)}"
                    current, n, last = chunk, 0, None
                    out = RecordWriter(store.open_output_stream(f"{folder}/{name}"))
                if last is not None and offset <= last:
                    raise ValueError(f"chunk {current[:5]}: offsets must be unique and ascend")
                out.add((RECORD_KEY_FORMAT % (*chunk[:3], offset)).encode(), value)
                last, n = offset, n + 1
        finish()
        return Chunks(staged)

    def commit(self, messages: list) -> None:
        store, root = filesystem_of(self.base)
        staged = [c for m in messages if m is not None for c in m.staged]
        folder = self._folder(root)
        if staged:
            with store.open_output_stream(f"{folder}/{LIST}.new") as out:
                out.write(json.dumps(staged).encode())
            store.move(f"{folder}/{LIST}.new", f"{folder}/{LIST}")
            publish(store, root, folder)
        elif store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)

    def abort(self, messages: list) -> None:
        """Tasks may still be writing; what is left is dropped by `recover_writes`."""
        store, root = filesystem_of(self.base)
        if store.get_file_info(self._folder(root)).type != fs.FileType.NotFound:
            store.delete_dir(self._folder(root))


def publish(store: fs.FileSystem, root: str, folder: str, threads: int = 32) -> int:
    """Rename the files of a finished write to their object names.

    A topic partition is renamed in offset order and ends at its first failure, so the
    archive has no hole; an object that is there already was published before.
    """
    with store.open_input_stream(f"{folder}/{LIST}") as source:
        staged = sorted(json.loads(source.read()), key=lambda c: c[1:])

    def move_partition(own: list) -> None:
        store.create_dir(f"{root}/{own[0][1]}", recursive=True)
        for name, *chunk in own:
            target = f"{root}/{OBJECT_PATH_FORMAT % tuple(chunk)}"
            there, file = store.get_file_info([target, f"{folder}/{name}"])
            if there.type == fs.FileType.NotFound:
                if file.type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{folder}/{name} for {target}")
                store.move(file.path, target)

    groups = [list(own) for _, own in groupby(staged, key=lambda c: c[1:4])]
    with ThreadPoolExecutor(threads) as pool:
        for _ in pool.map(move_partition, groups):
            pass
    store.delete_dir(folder)
    return len(staged)


def recover_writes(base: str, owner: str = "default") -> int:
    """Publish the finished writes that died while renaming, and drop the others."""
    store, root = filesystem_of(base)
    published = 0
    selector = fs.FileSelector(f"{root}/{STAGING}/{owner}", allow_not_found=True)
    for info in sorted(store.get_file_info(selector), key=lambda i: i.path):
        if store.get_file_info(f"{info.path}/{LIST}").type == fs.FileType.NotFound:
            store.delete_dir(info.path)
        else:
            published += publish(store, root, info.path)
    return published


class ArchiveSource(DataSource):
    """Options: path, the archive's base. Reading: topics (comma list, all if absent),
    pushdown (true where Spark's filter pushdown for Python sources is on), taskbytes.
    Writing, by appending only: owner, which names the staging folder."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        pushed = self.options.get("pushdown", "false").lower() == "true"
        return (FilteringReader if pushed else ArchiveReader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("an archive is only appended to")
        return ArchiveWriter(dict(self.options), schema.names)


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_archive(spark: SparkSession, base: str, topics: Iterable[str] | None = None) -> DataFrame:
    """Archived messages; filters leave objects unopened if the session's setting
    `spark.sql.python.filterPushdown.enabled` allows it."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(NAME).option("pushdown", spark.conf.get(PUSHDOWN, "false"))
    if topics is not None:
        reader = reader.option("topics", ",".join(sorted(topics)))
    return reader.load(base)


def write_archive(
    messages: Messages,
    chunks: DataFrame,
    base: str,
    owner: str = "default",
    chunks_per_job: int = CHUNKS_PER_JOB,
) -> int:
    """Archive the given chunks through the data source; returns how many there were.

    Takes what `write_chunks` takes. Files are renamed by the writer's commit, with the
    store's own client; what a dead run left is completed or dropped first.
    """
    spark = chunks.sparkSession
    spark.dataSource.register(ArchiveSource)
    recover_writes(base, owner)
    n = 0
    for job in jobs_of(_windows(chunks, chunks_per_job)):
        window = [c for part in job for c in part]
        tasks = deal_tasks(window, spark.sparkContext.defaultParallelism)
        ranges = partition_ranges(window)
        log = messages(ranges) if callable(messages) else messages.filter(range_filter(ranges))
        bounds = spark.createDataFrame(
            [(i, t, *c[3:6]) for i, (t, c) in enumerate(zip(tasks, window, strict=True))],
            "chunk_no int, task int, start_offset long, end_offset long, message_count long",
        )
        # A job has a bounded number of chunks.
        rows = (
            assign_chunks(log.select(*PARTITION_KEY, "offset", "value"), window)
            .join(F.broadcast(bounds), "chunk_no")
            .repartitionById(tasks[-1] + 1, F.col("task"))
            .sortWithinPartitions("chunk_no", "offset")
            .select(*WRITE_COLUMNS)
        )
        rows.write.format(NAME).option("owner", owner).mode("append").save(base)
        n += len(window)
    return n
