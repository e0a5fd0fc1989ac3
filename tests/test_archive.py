import os

import pytest
from pyspark.sql import functions as F

from logstow.hadoop import Folder
from logstow.model import MESSAGE_SCHEMA, PARTITION_SCHEMA, ChunkRule
from logstow.operators.chunking import closed_chunks, plan_chunks
from logstow.operators.integrity import GapError, chunk_gaps, lost_data_gaps
from logstow.operators.positions import last_committed, start_positions
from logstow.plans import archive_run
from logstow.plans.archive_run import current_starts, run_archive
from logstow.shared_dir import shared_dir
from logstow.sinks import sequence_files
from logstow.sinks.sequence_files import assign_chunks, partition_ranges, recover, write_chunks
from logstow.sources.archive import (
    archive_catalog,
    archived_messages,
    list_objects,
    objects_between,
    read_catalog,
    read_catalog_objects,
    read_objects,
    read_topics,
    rejected_objects,
)


def messages_of(spark, rows):
    return spark.createDataFrame(
        [(t, b, p, o, v, a) for t, b, p, o, v, a in rows], MESSAGE_SCHEMA
    )


def partitions_of(spark, *rows):
    return spark.createDataFrame(rows, PARTITION_SCHEMA)


def sample_log(n=60):
    rows = []
    for topic, p in [("a.b_c", 1), ("a.b_c", 11), ("_hidden", 0)]:
        for i in range(1, n + 1):
            value = bytes((i * 7 + k) % 256 for k in range(i % 13))
            rows.append((topic, 3, p, i * 20, value, 1000 + i))
    return rows


def parts_for(spark, log_start=0, ignore=False):
    return partitions_of(
        spark,
        ("a.b_c", 3, 1, log_start, ignore),
        ("a.b_c", 3, 11, log_start, ignore),
        ("_hidden", 3, 0, log_start, ignore),
    )


def object_names(base):
    return sorted(
        f"{d}/{f}"
        for d in os.listdir(base)
        if not d.startswith("~")
        for f in os.listdir(f"{base}/{d}")
        if not f.startswith(".")
    )


def everything(spark, base, topics=("a.b_c", "_hidden")):
    return sorted(
        (r.topic, r.broker_id, r.partition_id, r.offset, bytes(r.value))
        for r in archived_messages(read_topics(spark, base, topics)).collect()
    )


def test_chunk_file_has_keys_values_and_classes(spark, tmp_path):
    base = str(tmp_path)
    rows = [("topic.test", 3, 2, 72, b"message_1", 0), ("topic.test", 3, 2, 102, b"message_2", 0)]
    messages = messages_of(spark, rows)
    sized = messages.withColumn("start_offset", F.lit(42))
    chunks = plan_chunks(sized, ChunkRule(17, None))
    assert write_chunks(messages, chunks, base) == 1
    name = "topic.test/3_2_0000000000000000042_0000000000000000102"
    assert object_names(base) == [name]
    head = open(f"{base}/{name}", "rb").read(120)
    for word in (b"SEQ", b"hadoop.io.Text", b"hadoop.io.BytesWritable", b"BZip2Codec"):
        assert word in head
    records = read_objects(spark, [f"{base}/{name}"]).collect()
    assert [(r.key, bytes(r.value)) for r in records] == [
        ("topic.test:3:2:72", b"message_1"),
        ("topic.test:3:2:102", b"message_2"),
    ]


@pytest.mark.parametrize("start, end", [(0, 20), (40, 60)])
def test_reopened_archive_goes_on_at_the_end(spark, tmp_path, start, end):
    base = str(tmp_path)
    parts = partitions_of(spark, ("unit_test_topic", 3, 2, start, True))
    before = current_starts(parts, base).first()
    assert before.start_offset == start
    messages = messages_of(spark, [("unit_test_topic", 3, 2, end, b"message_1", 0)])
    run = run_archive(messages, parts, base, ChunkRule(8, None))
    assert run.published == 1
    assert object_names(base) == [f"unit_test_topic/3_2_{start:019d}_{end:019d}"]
    assert current_starts(parts, base).first().start_offset == end


def test_round_trip_is_byte_for_byte(spark, tmp_path):
    base, rows = str(tmp_path), sample_log()
    run = run_archive(
        messages_of(spark, rows), parts_for(spark), base, ChunkRule(40, None), chunks_per_job=4
    )
    assert run.published == closed_chunks(run.chunks).count() == len(object_names(base))
    assert run.published > 4
    got = everything(spark, base)
    tails = {tuple(r)[:3]: r.start_offset for r in run.open_tails.collect()}
    want = [r[:5] for r in rows if r[3] <= tails.get(r[:3], 10**9)]
    assert got == sorted(want)
    assert Folder(spark, f"{base}/~staging/default").names() == []


def test_second_run_reads_only_what_is_new(spark, tmp_path):
    base, rows = str(tmp_path), sample_log()
    half = [r for r in rows if r[3] <= 600]
    rule = ChunkRule(40, None)
    run_archive(messages_of(spark, half), parts_for(spark), base, rule)
    again = run_archive(messages_of(spark, half), parts_for(spark), base, rule)
    assert again.published == 0
    run_archive(messages_of(spark, rows), parts_for(spark), base, rule)
    stepwise = object_names(base)
    whole = str(tmp_path / "whole")
    run_archive(messages_of(spark, rows), parts_for(spark), whole, rule)
    assert object_names(whole) == [n for n in stepwise if not n.startswith("whole")]
    assert chunk_gaps(read_catalog(spark, base, ["a.b_c", "_hidden"])).count() == 0


@pytest.mark.parametrize("survivors", [0, 2])
def test_crash_while_publishing_is_completed(spark, tmp_path, monkeypatch, survivors):
    base, rows, rule = str(tmp_path), sample_log(), ChunkRule(40, None)
    real, done = Folder.rename, []

    def failing(folder, source, target):
        if len(done) >= survivors:
            raise OSError("lost")
        done.append(target)
        return real(folder, source, target)

    monkeypatch.setattr(Folder, "rename", failing)
    with pytest.raises(OSError):
        write_chunks(
            messages_of(spark, rows),
            closed_chunks(plan_chunks(messages_of(spark, rows), rule)),
            base,
            threads=1,
        )
    monkeypatch.setattr(Folder, "rename", real)
    assert len(object_names(base)) == survivors
    assert recover(spark, base, "default") > 0
    run_archive(messages_of(spark, rows), parts_for(spark), base, rule)
    whole = str(tmp_path / "~whole")
    run_archive(messages_of(spark, rows), parts_for(spark), whole, rule)
    assert object_names(base) == object_names(whole)
    assert everything(spark, base) == everything(spark, whole)


def test_crash_while_writing_is_dropped(spark, tmp_path, monkeypatch):
    base, rows, rule = str(tmp_path), sample_log(), ChunkRule(40, None)

    def failing(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(sequence_files, "_write_window", failing)
    with pytest.raises(RuntimeError):
        run_archive(messages_of(spark, rows), parts_for(spark), base, rule)
    assert Folder(spark, f"{base}/~staging/default").names() != []
    assert recover(spark, base, "default") == 0
    assert Folder(spark, f"{base}/~staging/default").names() == []


def test_message_missing_at_write_time_fails(spark, tmp_path):
    rows = sample_log()
    chunks = closed_chunks(plan_chunks(messages_of(spark, rows), ChunkRule(40, None)))
    with pytest.raises(Exception, match="planned"):
        write_chunks(messages_of(spark, rows[1:]), chunks, str(tmp_path))
    assert object_names(str(tmp_path)) == []


def test_source_may_be_a_range_reader(spark, tmp_path):
    rows, asked = sample_log(), []

    def read(ranges):
        asked.extend(ranges)
        return messages_of(spark, rows).filter(sequence_files.range_filter(ranges))

    chunks = closed_chunks(plan_chunks(messages_of(spark, rows), ChunkRule(40, None)))
    n = write_chunks(read, chunks, str(tmp_path), chunks_per_job=10)
    assert n == chunks.count()
    assert {r[:3] for r in asked} == {r[:3] for r in rows}


@pytest.mark.parametrize("scans", [1, 100])
def test_windows_of_a_log_without_range_reader(spark, tmp_path, scans):
    rows = sample_log()
    messages = messages_of(spark, rows)
    chunks = closed_chunks(plan_chunks(messages, ChunkRule(40, None))).cache()
    n = write_chunks(messages, chunks, str(tmp_path), chunks_per_job=4, scans=scans)
    assert n == chunks.count() > 8
    got = everything(spark, str(tmp_path))
    assert len(got) == chunks.agg(F.sum("message_count")).first()[0]
    records = read_catalog_objects(read_catalog(spark, str(tmp_path), ["a.b_c", "_hidden"]))
    assert records.count() == len(got)


def test_run_with_landed_sizes_and_a_range_reader(spark, tmp_path):
    rows, rule = sample_log(), ChunkRule(40, 500, 1000)
    base, whole = str(tmp_path / "base"), str(tmp_path / "whole")

    def log(ranges):
        return messages_of(spark, rows).filter(sequence_files.range_filter(ranges))

    run = run_archive(
        messages_of(spark, rows), parts_for(spark), base, rule, log=log, land_sizes=True
    )
    assert run.published > 0
    run_archive(messages_of(spark, rows), parts_for(spark), whole, rule)
    assert object_names(base) == object_names(whole)


def test_assign_chunks_against_brute_force(spark):
    rows = sample_log(80)
    chunks = [
        ("a.b_c", 3, 1, 0, 15, 0), ("a.b_c", 3, 1, 15, 17, 0), ("a.b_c", 3, 1, 60, 800, 0),
        ("a.b_c", 3, 11, 0, 20, 0), ("a.b_c", 3, 11, 20, 40, 0), ("_hidden", 3, 0, 400, 1600, 0),
    ]
    got = {
        (r.topic, r.partition_id, r.offset, r.chunk_no)
        for r in assign_chunks(messages_of(spark, rows), chunks).collect()
    }
    want = {
        (r[0], r[2], r[3], i)
        for r in rows
        for i, c in enumerate(chunks)
        if r[:3] == c[:3] and c[3] < r[3] <= c[4]
    }
    assert got == want
    assert partition_ranges(chunks)[0] == ("a.b_c", 3, 1, 0, 800)


def test_foreign_names(spark, tmp_path):
    base = str(tmp_path)
    os.mkdir(f"{base}/t")
    for name in ["3_2_00_20", "3_2_20_40_note", "3_2_x_50", "readme", "3_2_7"]:
        open(f"{base}/t/{name}", "w").write("x")
    os.mkdir(f"{base}/t/3_2_sub")
    open(f"{base}/t/3_2_sub/3_2_0_999", "w").write("x")
    objects = list_objects(spark, base, ["t", "absent"])
    assert {r.name for r in objects.collect()} == {
        "3_2_00_20", "3_2_20_40_note", "3_2_x_50", "readme", "3_2_7"
    }
    assert {r.name for r in rejected_objects(objects).collect()} == {"readme", "3_2_7"}
    lenient = archive_catalog(objects, strict=False)
    assert lenient.agg(F.max("end_offset")).first()[0] == 50
    with pytest.raises(Exception, match="not an archive object"):
        archive_catalog(objects).collect()
    assert list_objects(spark, base, ["absent"]).count() == 0


def catalog_of(spark, *rows):
    return spark.createDataFrame(
        rows,
        "topic string, broker_id int, partition_id int, start_offset long, end_offset long",
    )


def test_positions_and_gaps(spark):
    parts = partitions_of(
        spark, ("t", 1, 1, 50, False), ("t", 1, 11, 50, True), ("u", 1, 0, 5, True)
    )
    catalog = catalog_of(
        spark, ("t", 1, 1, 0, 10), ("t", 1, 1, 10, 30), ("t", 1, 11, 0, 40), ("v", 1, 0, 0, 9)
    )
    committed = {(r.topic, r.partition_id): r.last_committed for r in last_committed(parts, catalog).collect()}
    assert committed == {("t", 1): 30, ("t", 11): 40, ("u", 0): 0}
    starts = start_positions(parts, catalog)
    assert {(r.topic, r.partition_id): r.start_offset for r in starts.collect()} == {
        ("t", 1): 30, ("t", 11): 50, ("u", 0): 5
    }
    lost = {(r.topic, r.partition_id): (r.lost, r.action) for r in lost_data_gaps(starts).collect()}
    assert lost == {("t", 1): (20, "fail"), ("t", 11): (10, "skip"), ("u", 0): (5, "skip")}


def test_hole_and_overlap(spark):
    catalog = catalog_of(
        spark, ("t", 1, 1, 0, 10), ("t", 1, 1, 12, 30), ("t", 1, 1, 25, 40), ("t", 1, 2, 5, 6)
    )
    assert [(r.start_offset, r.gap) for r in chunk_gaps(catalog).collect()] == [(12, 2), (25, -5)]


def test_lost_data_stops_a_run_unless_ignored(spark, tmp_path):
    base, rows = str(tmp_path), [r for r in sample_log() if r[3] > 300]
    rule = ChunkRule(40, None)
    with pytest.raises(GapError):
        run_archive(messages_of(spark, rows), parts_for(spark, 300), base, rule)
    run = run_archive(messages_of(spark, rows), parts_for(spark, 300, True), base, rule)
    assert run.chunks.agg(F.min("start_offset")).first()[0] == 300


def test_hole_in_the_archive_stops_a_run(spark, tmp_path):
    base, rows, rule = str(tmp_path), sample_log(), ChunkRule(40, None)
    run_archive(messages_of(spark, rows), parts_for(spark), base, rule)
    victim = [n for n in object_names(base) if n.startswith("a.b_c/3_1_")][1]
    os.remove(f"{base}/{victim}")
    with pytest.raises(GapError):
        run_archive(messages_of(spark, rows), parts_for(spark), base, rule)


def test_objects_are_chosen_by_name(spark):
    catalog = catalog_of(spark, ("t", 1, 1, 0, 10), ("t", 1, 1, 10, 30), ("t", 1, 1, 30, 40))
    assert [r.end_offset for r in objects_between(catalog, 10, 30).collect()] == [30]
    assert objects_between(catalog).count() == 3


def test_supplied_time_closes_the_tail(spark, tmp_path):
    rule = ChunkRule(10**6, 1000, run_start_ms=1000, now_ms=3000)
    run = run_archive(messages_of(spark, sample_log()), parts_for(spark), str(tmp_path), rule)
    assert run.published == 3 and run.open_tails.count() == 0


def test_every_start_reaches_the_scan(spark, tmp_path):
    rows = [("t", 3, p, 1000 * k, b"x", 0) for p in range(100) for k in (1, 2)]
    messages_of(spark, rows).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    parts = partitions_of(spark, *[("t", 3, p, 0, False) for p in range(100)])
    catalog = catalog_of(spark, *[("t", 3, p, 0, 1000 + p) for p in range(1, 100)])
    unread = archive_run.unread_messages(log, start_positions(parts, catalog))
    spark.conf.set("spark.sql.maxMetadataStringLength", str(1 << 20))
    try:
        pushed = unread._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f"GreaterThan(offset,{1000 + p})" in pushed for p in range(1, 100))
    assert "GreaterThan(offset,0)" in pushed
    got = sorted((r.partition_id, r.offset) for r in unread.collect())
    assert got == [(0, 1000)] + [(p, 2000) for p in range(100)]


def test_more_ranges_than_a_filter_spells_out(spark, monkeypatch):
    rows = [("t", 3, p, 10 * p + k, b"x", 0) for p in range(9) for k in range(5)]
    ranges = [("t", 3, p, 10 * p + 1, 10 * p + 3) for p in range(2, 6)]
    exact = messages_of(spark, rows).filter(sequence_files.range_filter(ranges)).count()
    assert exact == 8
    monkeypatch.setattr(sequence_files, "RANGES_IN_FILTER", 2)
    coarse = messages_of(spark, rows).filter(sequence_files.range_filter(ranges))
    assert sorted(r.offset for r in coarse.collect()) == [22, 23, 24] + list(range(30, 35)) + list(range(40, 45)) + [50, 51, 52, 53]
    assert messages_of(spark, rows).filter(sequence_files.range_filter([])).count() == 0


def test_objects_of_a_partition_appear_in_order(spark, tmp_path, monkeypatch):
    seen, real = [], Folder.rename

    def slow(folder, source, target):
        seen.append(target)
        return real(folder, source, target)

    monkeypatch.setattr(Folder, "rename", slow)
    run_archive(messages_of(spark, sample_log()), parts_for(spark), str(tmp_path), ChunkRule(40, None))
    for part in ("a.b_c/3_1_", "a.b_c/3_11_", "_hidden/3_0_"):
        own = [t for t in seen if t.startswith(part)]
        assert own == sorted(own) and len(own) > 3


def test_no_folder_of_one_machine_on_a_cluster(spark, tmp_path):
    class Session:
        class conf:
            value = None

            @classmethod
            def get(cls, *_):
                return cls.value

        class sparkContext:
            master = "local[4]"

    assert "logstow-" in shared_dir(Session, "x")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        Session.sparkContext.master = master
        with pytest.raises(ValueError):
            shared_dir(Session, "x")
    Session.conf.value = str(tmp_path)
    assert shared_dir(Session, "x").startswith(str(tmp_path))


def test_renames_in_tasks(spark, tmp_path):
    rows, rule = sample_log(), ChunkRule(40, None)
    base, whole = str(tmp_path / "base"), str(tmp_path / "whole")
    first = [r for r in rows if r[3] <= 600]
    run_archive(messages_of(spark, first), parts_for(spark), f"file://{base}", rule, in_tasks=True)
    run = run_archive(messages_of(spark, rows), parts_for(spark), base, rule, in_tasks=True)
    assert run.published > 0
    run_archive(messages_of(spark, rows), parts_for(spark), whole, rule)
    assert object_names(base) == object_names(whole)
    assert everything(spark, base) == everything(spark, whole)


def test_renames_in_tasks_stop_at_a_hole(spark, tmp_path):
    rows = sample_log()
    chunks = closed_chunks(plan_chunks(messages_of(spark, rows), ChunkRule(40, None)))
    archive, window = Folder(spark, str(tmp_path)), "~staging/default/w00000000"
    some = [tuple(c)[:5] for c in chunks.filter("topic = '_hidden'").orderBy("start_offset").collect()]
    spark.createDataFrame(
        [(*c, i) for i, c in enumerate(some)],
        "topic string, broker_id int, partition_id int, start_offset long, end_offset long, chunk_no int",
    ).write.parquet(f"{tmp_path}/{window}/names")
    for i in range(len(some)):
        if i != 2:
            archive.make(f"{window}/data/part-r-{i:05d}")
    with pytest.raises(Exception, match="part-r-00002"):
        sequence_files._publish_window(spark, archive, window, 4, in_tasks=True)
    assert len(object_names(str(tmp_path))) == 2
