"""Phrases against counting everything in Python."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from logstow.llm import collocations
from logstow.llm.collocations import Mining, phrase_collocations, score_phrases

from .conftest import DOCUMENTS

UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows, rule):
    found, words = {}, Counter()
    for row in rows:
        lang = "und" if row.lang is None else row.lang
        own = found.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row.text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, rule.longest + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= rule.least}
        around = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if p in around and 100 * around[p] >= rule.cover * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[: rule.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(
    "rule",
    [Mining(least=5), Mining(least=2, shards=3, filter_bits=1 << 10, top=50), Mining(least=3, shards=1)],
)
def test_phrases_of_a_table(small, rule):
    docs = small.filter("length(text) < 20000").repartition(3)
    got = sorted(tuple(r) for r in phrase_collocations(docs, rule).collect())
    assert got == plain(docs.collect(), rule) != []


def test_awkward_rows(spark, awkward, nothing):
    rule = Mining(least=2)
    got = sorted(tuple(r) for r in phrase_collocations(awkward, rule).collect())
    assert got == plain(awkward.collect(), rule) != []
    assert phrase_collocations(nothing).collect() == []


def test_texts_beyond_a_block_and_pieces_without_end(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 300)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("a b c d. E, f".split(), k=400)), "x", "s", 0) for i in range(6)]
    rows.append((9, "no end here at all " * 60, "x", "s", 0))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    batches = docs.select("lang", "text").toArrow().to_batches()
    total, blocks = Counter(), 0
    everywhere = SimpleNamespace(value=(np.full(1, 2**64 - 1, np.uint64),) * 2)
    for texts, langs in collocations._texts(iter(batches)):
        words = collocations.Words(texts, langs)
        assert words.words.sum() == np.count_nonzero(words.code) == len(words.at)
        blocks += 1
    for found in collocations._spell(everywhere, 4)(iter(batches)):
        for lang, _, phrase, n in zip(*found.to_pydict().values(), strict=True):
            total[lang, phrase] += n
    want = Counter()
    for row in rows:
        for piece in re.split(r"[.,;:!?\n]", row[1].lower()):
            w = piece.split()
            for k in range(1, 5):
                want.update(("x", " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    assert total == want and blocks > 5


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    rows = [("x", 1, "a", big), ("x", 1, "b", big + 1), ("x", 2, "a b", big - 1)]
    got = score_phrases(spark.createDataFrame(rows, "lang string, size int, phrase string, n long"))
    assert got.first().score == 2000000 * (big - 1) // (2 * big + 1)


def test_counters_are_kept_and_moved_as_runs(spark, tmp_path, monkeypatch):
    """A row of the state is a run of counters, so rows do not grow with phrases."""
    monkeypatch.setattr(collocations, "shared_dir", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(collocations, "Folder", lambda *a: SimpleNamespace(delete=lambda name: None))
    rng = random.Random(7)
    names = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(names, k=100)), "xy"[i % 2], "s", 0) for i in range(200)]
    docs, rule = spark.createDataFrame(rows, DOCUMENTS).repartition(3), Mining(least=3)
    got = sorted(tuple(r) for r in phrase_collocations(docs, rule).collect())
    assert got == plain(docs.collect(), rule) != []
    kept = [spark.read.parquet(str(p)).count() for p in tmp_path.glob("phrases/state-*")]
    assert len(kept) > 2 and max(kept) < 100


def test_counters_of_a_bucket_over_a_cycle():
    def runs(counters):
        values = np.array(counters, collocations.COUNTER)
        return collocations._runs(values, np.arange(1 if len(values) else 0))

    def after(step, opened, reached):
        table = pa.table({"bucket": pa.array([3, 3], pa.int32()), "open": opened, "reached": reached})
        out = collocations._sum_counters(step, 2, 5, 3)(table)
        both = (collocations._values(out.column(c), collocations.COUNTER).tolist() for c in ("open", "reached"))
        return *both, out.column("parts").to_pylist(), out.column("last").to_pylist()

    new = [(7, 2, 2, 1, -1), (9, 1, 2, 1, -1), (2**63, 4, 3, 1, -1)]
    again = [(7, 3, 2, 2, -1), (9, 1, 2, 2, -1), (11, 1, 2, 2, -1), (2**63, 1, 3, 2, -1)]
    none = pa.array([b"", b""], pa.binary())
    opened, reached, parts, last = after(1, pa.concat_arrays([runs(new), none[:1]]), none)
    assert (opened, reached, parts, last) == (new, [], [0], [-1])
    both = pa.concat_arrays([runs(new), runs(again)])
    # 7 and 2**63 reach five in step 2, 9 has had its cycle, 11 goes on.
    assert after(2, both, none) == ([(11, 1, 2, 2, -1)], [(7, 5, 2, 1, 2), (2**63, 5, 3, 1, 2)], [1], [2])
    assert after(3, runs([(7, 1, 2, 3, -1)]).take(pa.array([0, None])).fill_null(b""), pa.concat_arrays(
        [runs([(7, 5, 2, 1, 2)]), none[:1]]
    )) == ([], [(7, 6, 2, 1, 2)], [1], [2])


def test_phrases_are_dealt_and_summed_by_bucket(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_PHRASES", 4)
    rows = [("x", 2, "a b", 3), ("y", 2, "a b", 1), ("x", 1, "ñ", 4), ("x", 2, "a b", 2), ("x", 1, "c", 1)] * 3
    spelled = [pa.RecordBatch.from_pylist([dict(zip(("lang", "size", "phrase", "n"), r))]) for r in rows]
    dealt = pa.Table.from_batches(collocations._deal(iter, 4)(iter(spelled)))
    got = []
    for lang, bucket in {(r["lang"], r["bucket"]) for r in dealt.to_pylist()}:
        mine = (pc.field("lang") == lang) & (pc.field("bucket") == bucket)
        got += collocations._sum_phrases(4)(dealt.filter(mine)).to_pylist()
    assert sorted(tuple(r.values()) for r in got) == [("x", 1, "ñ", 12), ("x", 2, "a b", 15)]
