"""Windows that share a write job, and chunks that share a task."""

import os

import pytest
from pyspark.sql import functions as F

from logstow.hadoop import Folder
from logstow.model import ChunkRule
from logstow.operators.chunking import closed_chunks, plan_chunks
from logstow.sinks import sequence_files
from logstow.sinks.sequence_files import deal_tasks, jobs_of, write_chunks
from tests.test_archive import everything, messages_of, object_names, sample_log


@pytest.fixture
def planned(spark):
    messages = messages_of(spark, sample_log())
    return messages, closed_chunks(plan_chunks(messages, ChunkRule(40, None))).cache()


def test_small_windows_share_a_job(spark, tmp_path, planned, monkeypatch):
    messages, chunks = planned
    jobs, real = [], sequence_files._write_window

    def counting(messages, windows, archive, stages, *rest):
        assert all(Folder(spark, f"{archive.path}/{s}/names").names() for s in stages)
        jobs.append([len(w) for w in windows])
        real(messages, windows, archive, stages, *rest)

    monkeypatch.setattr(sequence_files, "_write_window", counting)
    n = write_chunks(messages, chunks, str(tmp_path), chunks_per_job=4)
    assert n == chunks.count() == len(object_names(str(tmp_path)))
    assert len(jobs) == 1 and set(jobs[0][:-1]) == {4} and len(jobs[0]) == -(-n // 4)


def test_every_way_of_writing_gives_the_same_archive(spark, tmp_path, planned, monkeypatch):
    messages, chunks = planned
    write_chunks(messages, chunks, f"{tmp_path}/one")
    monkeypatch.setattr(sequence_files, "CHUNKS_AT_ONCE", 8)
    write_chunks(messages, chunks, f"{tmp_path}/split", chunks_per_job=4, scans=1)
    monkeypatch.setattr(sequence_files, "_in_reach", lambda *_: False)
    write_chunks(messages, chunks, f"{tmp_path}/hadoop", chunks_per_job=10)
    want = everything(spark, f"{tmp_path}/one")
    for other in ("split", "hadoop"):
        assert object_names(f"{tmp_path}/{other}") == object_names(f"{tmp_path}/one")
        assert everything(spark, f"{tmp_path}/{other}") == want


def test_chunk_without_any_message_fails_and_leaves_no_object(spark, tmp_path, planned):
    messages, chunks = planned
    first = chunks.orderBy("start_offset").first()
    lost = (F.col("topic") == first.topic) & (F.col("partition_id") == first.partition_id)
    lost = lost & (F.col("offset") <= first.end_offset)
    with pytest.raises(Exception, match="0 messages read"):
        write_chunks(messages.filter(~lost), chunks, str(tmp_path))
    assert [d for d in os.listdir(tmp_path) if not d.startswith("~")] == []


def test_jobs_and_tasks_are_bounded(monkeypatch):
    chunks = [("t", 3, 0, i, i + 1, 1, size) for i, size in enumerate([5, 1, 1, 100, 0, 0, 1])]
    tasks = deal_tasks(chunks, 2)
    assert tasks == sorted(tasks) and set(tasks) == set(range(tasks[-1] + 1)) and tasks[-1] > 0
    assert deal_tasks([], 2) == []
    monkeypatch.setattr(sequence_files, "BYTES_AT_ONCE", 6)
    jobs = list(jobs_of([[c] for c in chunks]))
    assert [len(j) for j in jobs] == [2, 1, 1, 3]
    assert [w for j in jobs for w in j] == [[c] for c in chunks]


def test_local_objects_are_renamed_without_the_jvm(spark, tmp_path):
    folder = Folder(spark, f"file://{tmp_path}")
    (tmp_path / "a").write_text("new")
    (tmp_path / "there").write_text("old")
    folder._fs = folder._path_class = None
    assert folder.exists("a") and not folder.exists("b")
    assert not folder.rename("a", "there")
    assert (tmp_path / "there").read_text() == "old"
    assert folder.rename("a", "b")
    assert not folder.exists("a") and (tmp_path / "b").read_text() == "new"
    with pytest.raises(FileNotFoundError):
        folder.rename("a", "c")
