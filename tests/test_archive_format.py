"""The data source: the same objects as the job's own sink, pruned reads, crashes."""

import io

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan

from logstow.functions import record_files
from logstow.functions.record_files import pack_number, read_records, unpack_number, write_records
from logstow.model import ChunkRule
from logstow.operators.chunking import closed_chunks, plan_chunks
from logstow.plans.archive_run import written
from logstow.ship import ship
from logstow.sinks.sequence_files import write_chunks
from logstow.sources.archive import read_objects
from logstow.sources.archive_format import (
    PUSHDOWN,
    WRITE_COLUMNS,
    ArchiveSource,
    ArchiveWriter,
    Chunks,
    FilteringReader,
    read_archive,
    recover_writes,
    write_archive,
)
from test_archive import everything, messages_of, object_names, sample_log

TOPICS = ("a.b_c", "_hidden")


@pytest.fixture
def planned(spark, tmp_path):
    ship(spark)
    log = messages_of(spark, sample_log())
    return log, written(closed_chunks(plan_chunks(log, ChunkRule(40, None))), str(tmp_path / "chunks"))


@given(st.integers(0, 2**62))
def test_numbers(n):
    assert unpack_number(b"x" + pack_number(n), 1) == (n, 1 + len(pack_number(n)))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=300), st.binary(max_size=3000)), max_size=40))
def test_records_come_back(records):
    out = io.BytesIO()
    out.close, data = (lambda: None), out
    write_records(out, records)
    assert list(read_records(io.BytesIO(data.getvalue()))) == records


def test_files_are_those_of_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_files, "BLOCK_BYTES", 200)
    records = [(f"t:3:0:{i}".encode(), bytes([i % 256]) * (i % 50)) for i in range(300)]
    path = str(tmp_path / "object")
    with open(path, "wb") as out:
        write_records(out, records)
    by_spark = [(r.key.encode(), bytes(r.value)) for r in read_objects(spark, [path]).collect()]
    assert by_spark == records


def test_the_same_objects_as_the_sink(spark, tmp_path, planned):
    log, chunks = planned
    bases = [str(tmp_path / d) for d in ("sink", "source")]
    n = write_chunks(log, chunks, bases[0])
    assert write_archive(log, chunks, bases[1], chunks_per_job=4) == n > 4
    assert object_names(bases[0]) == object_names(bases[1])
    rows = everything(spark, bases[0])
    assert everything(spark, bases[1]) == rows
    for base in bases:
        assert sorted((*r[:4], bytes(r.value)) for r in read_archive(spark, base).collect()) == rows
    assert read_archive(spark, bases[0], ["none"]).collect() == []


def test_names_prune_objects(spark, tmp_path, planned):
    log, chunks = planned
    base = str(tmp_path / "base")
    write_chunks(log, chunks, base)
    known = [(c.topic, c.partition_id, c.start_offset, c.end_offset) for c in chunks.collect()]

    def opened(*filters):
        reader = FilteringReader({"path": base})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        found = [o for p in reader.partitions() for o in p.found]
        return sorted((t, p, int(path.split("_")[-2]), int(path.split("_")[-1])) for path, t, _, p in found)

    def among(test):
        return sorted(k for k in known if test(*k))

    assert opened() == among(lambda *k: True)
    assert opened(EqualTo(("topic",), "a.b_c")) == among(lambda t, p, a, b: t == "a.b_c")
    got = opened(In(("partition_id",), (1, 7)), GreaterThan(("offset",), 600))
    assert got == among(lambda t, p, a, b: p == 1 and b > 600) != []
    got = opened(GreaterThanOrEqual(("offset",), 600), LessThan(("offset",), 800))
    assert got == among(lambda t, p, a, b: b >= 600 and a < 799) != []
    assert opened(EqualTo(("offset",), 10**9)) == []
    reader = FilteringReader({"path": base, "taskbytes": "1"})
    assert len(reader.partitions()) == len(known)


def test_a_plain_filter_reaches_the_names(spark, tmp_path, planned):
    log, chunks = planned
    base = str(tmp_path / "base")
    write_chunks(log, chunks, base)
    want = sorted(r for r in everything(spark, base) if r[0] == "a.b_c" and r[3] > 700)
    # An object that holds none of these rows is broken: it must stay closed.
    first = min(n for n in object_names(base) if n.startswith("a.b_c/3_1_"))
    with open(f"{base}/{first}", "wb") as out:
        out.write(b"broken")
    before = spark.conf.get(PUSHDOWN)
    try:
        for setting in ("true", "false"):
            spark.conf.set(PUSHDOWN, setting)
            rows = read_archive(spark, base).filter((F.col("topic") == "a.b_c") & (F.col("offset") > 700))
            if setting == "true":
                assert sorted((*r[:4], bytes(r.value)) for r in rows.collect()) == want != []
            else:
                with pytest.raises(Exception, match="ends within a record|SequenceFile"):
                    rows.collect()
    finally:
        spark.conf.set(PUSHDOWN, before)


def staged_write(base):
    return ArchiveWriter({"path": base}, WRITE_COLUMNS)


def batch_of(rows):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=WRITE_COLUMNS)


@pytest.mark.parametrize("survivors", [0, 1, 2])
def test_a_crash_while_renaming_is_completed(tmp_path, monkeypatch, survivors):
    base = str(tmp_path)
    writer = staged_write(base)
    rows = [("t", 3, 0, o - 10, o, 1, o, b"x") for o in (10, 20, 30)]
    message = writer.write(iter([batch_of(rows[:2]), batch_of(rows[2:])]))
    real, done = fs.LocalFileSystem, []

    class Failing(real):
        def move(self, source, target):
            if "names" not in source:
                if len(done) >= survivors:
                    raise OSError("lost")
                done.append(target)
            super().move(source, target)

    with monkeypatch.context() as m:
        m.setattr("logstow.sources.archive_format.filesystem_of", lambda b: (Failing(), b))
        with pytest.raises(OSError, match="lost"):
            writer.commit([message, None])
    names = [f"t/3_0_{o - 10:019d}_{o:019d}" for o in (10, 20, 30)]
    assert (object_names(base) if survivors else []) == names[:survivors]
    assert recover_writes(base) == 3 and object_names(base) == names
    assert recover_writes(base) == 0


def test_writes_that_did_not_end_are_dropped(tmp_path):
    base = str(tmp_path)
    writer = staged_write(base)
    rows = [("t", 3, 0, 0, 20, 2, o, b"x") for o in (10, 20)]
    writer.write(iter([batch_of(rows)]))
    assert recover_writes(base) == 0 and object_names(base) == []
    with pytest.raises(ValueError, match="1 messages read, 2 planned"):
        writer.write(iter([batch_of(rows[:1])]))
    with pytest.raises(ValueError, match="ascend"):
        writer.write(iter([batch_of(rows[::-1])]))
    writer.abort([None])
    assert fs.LocalFileSystem().get_file_info(f"{base}/~staging/default/{writer.job}").type == fs.FileType.NotFound
    writer.commit([Chunks([]), None])
    assert object_names(base) == []


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="only appended"):
        ArchiveSource({"path": "x"}).writer(None, True)
    with pytest.raises(ValueError, match="missing"):
        ArchiveWriter({"path": "x"}, ["topic"])
    with pytest.raises(ValueError, match="not a SequenceFile"):
        list(read_records(io.BytesIO(b"PAR1....")))
