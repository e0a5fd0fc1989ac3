import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from logstow.llm.mixing import Mix, distances, draw, mixing, rake, sample
from logstow.llm.queries import LLM_QUERIES

from .test_pii import PLAIN, holds
from .test_simhash import brute_components, brute_fingerprint

DATA = "/root/testdata/sf0.001"


def brute_rake(cells, mix):
    """Factors by plain loops over {(source, lang, topic): tokens}."""
    factor = dict.fromkeys(cells, 1.0)
    whole = sum(cells.values())
    for _ in range(200):
        for at, power in enumerate((mix.source, mix.lang, mix.topic)):
            own, now = Counter(), Counter()
            for c, n in cells.items():
                own[c[at]] += n
                now[c[at]] += n * factor[c]
            tempered = {v: n**power if n else 0 for v, n in own.items()}
            for c in cells:
                if now[c[at]]:
                    target = tempered[c[at]] / sum(tempered.values()) * whole
                    factor[c] *= target / now[c[at]]
    return factor


def test_factors_against_plain_loops(spark):
    cells = {(s, l, t): (3 * i + 7 * j + 11 * t) ** 2 for i, s in enumerate("abc") for j, l in enumerate("xy") for t in (0, 1)}
    df = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic int, tokens long")
    mix = Mix(source=0.5, lang=0.0, topic=0.8, tolerance=1e-9, sweeps=40)
    got = {(r.source, r.lang, r.topic): r.factor for r in rake(df, mix).collect()}
    want = brute_rake(cells, mix)
    assert got.keys() == want.keys()
    assert all(got[c] == pytest.approx(want[c], rel=1e-6) for c in want if cells[c])


def test_expected_tokens_meet_the_targets(spark):
    rows = mixing(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert max(r.probability for r in rows) <= 1
    for marginal in ("source", "lang", "topic"):
        own, drawn = Counter(), Counter()
        for r in rows:
            own[r[marginal]] += r.n_tokens
            drawn[r[marginal]] += r.n_tokens * r.probability
        tempered = {v: n**0.9 for v, n in own.items()}
        for v in own:
            target = tempered[v] / sum(tempered.values())
            assert drawn[v] / sum(drawn.values()) == pytest.approx(target, rel=5e-3)
    kept = sum(r.sampled for r in rows)
    assert kept == pytest.approx(sum(r.probability for r in rows), abs=4 * len(rows) ** 0.5)


def test_share_is_met_with_probabilities_of_one(small):
    rows = mixing(small, Mix(source=0.2, share=0.9)).collect()
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(0.9 * tokens, rel=1e-3)
    assert max(r.probability for r in rows) == 1


def test_a_tiny_cell_does_not_decide_the_size_of_the_sample(spark):
    names = "source string, lang string, topic int, tokens long"
    big = [(s, l, t, 1000 * (3 + i + 2 * j + t)) for i, s in enumerate("abc") for j, l in enumerate("xy") for t in (0, 1)]
    whole = sum(c[3] for c in big) + 10
    for lang in ("x", "own"):
        df = spark.createDataFrame([*big, ("own", lang, 0, 10)], names)
        rows = distances(df, Mix()).collect()
        for m in ("source", "lang", "topic"):
            drawn = sum(r.expected for r in rows if r.marginal == m)
            assert drawn == pytest.approx(0.5 * whole, rel=1e-3)
        for r in rows:
            if r.value == "own":
                assert r.expected == pytest.approx(10, rel=2e-3) and r.target > 10 and r.off < 0
            else:
                assert abs(r.off) < 5e-3


def test_awkward_rows(awkward, nothing):
    out = draw(awkward)
    assert out.columns[: len(awkward.columns)] == awkward.columns and out.count() == awkward.count()
    drawn = sample(awkward)
    assert drawn.columns == awkward.columns
    assert sorted(map(str, drawn.collect())) == sorted(map(str, sample(awkward).collect()))
    ones = [r.mix_sampled for r in out.filter("doc_id = 1").collect()]
    assert len(ones) == 2 and len(set(ones)) == 1
    assert mixing(nothing).collect() == []


def test_stages_one_by_one(spark):
    """Each stage against plain Python, on what the stage before it kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns
        rows = out.collect()
        after = {r.doc_id: r for r in rows}
        assert len(rows) == len(after) and after.keys() <= before.keys()
        if name == "language_id":
            assert all(len(before[i].text) < 200 for i in before.keys() - after.keys())
        if name == "simhash_near_dedup":
            prints = [(i, brute_fingerprint(r.text)) for i, r in sorted(before.items())]
            assert set(after) == {c for *_, c in brute_components(prints)}
        if name == "pii":
            assert set(after) == set(before)
            for i, r in after.items():
                found = [m for k, p in PLAIN.items() for m in re.finditer(p, before[i].text) if holds(k, m.group())]
                assert found or r.text == before[i].text
                assert not any(re.search(PLAIN[k], r.text) for k in ("email", "ip"))
        if name == "mixing":
            assert all(before[i] == r for i, r in after.items()) and 0 < len(after) < len(before)
        docs, before = spark.createDataFrame(rows, docs.schema), after
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in last} == before.keys()
    for r in last:
        assert r.piece_ids == library.encode(before[r.doc_id].text) and r.n_tokens == len(r.piece_ids)


def test_run_is_the_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    key = F.col("doc_id")
    want = [tuple(r) for r in docs.orderBy(key).collect()]
    assert [tuple(r) for r in corpus_pipeline.run(spark, DATA).orderBy(key).collect()] == want


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward, DATA).count() <= awkward.count()
        assert stage(spark, nothing, DATA).collect() == []


def test_every_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 11))
