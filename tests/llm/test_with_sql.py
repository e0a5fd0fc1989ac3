"""Queries whose result SQL can express, and the counts of quality rules in Python."""

import re
from collections import Counter

import duckdb
import pytest
from .conftest import by_id

from logstow.llm.quality_rules import RULES, quality_rules
from logstow.llm.queries import LLM_ORACLE, LLM_QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, DATA)
    cursor = con.execute(LLM_ORACLE[name])
    columns = sorted(d[0] for d in cursor.description)
    assert sorted(df.columns) == columns
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want)


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def test_rules_on_awkward_rows(awkward):
    got = quality_rules(awkward).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    ).collect()
    assert all(not r.kept for r in got if r.base_failed)
    want = [(r.doc_id, *counts(r.text)) for r in awkward.collect()]
    assert by_id(r[:7] for r in got) == by_id(want)


def test_rules_of_an_empty_table(nothing):
    assert quality_rules(nothing).collect() == []


def test_a_table_row_decides(spark):
    text = " ".join(["the quick brown fox"] + [f"word{i} of" for i in range(60)])
    df = spark.createDataFrame([(1, text), (2, text.replace("word", "w#%&ord"))], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_rules(df).collect()}
    assert kept == {1: True, 2: False}
    loose = tuple(r for r in RULES if r[0] != "symbols_per_word")
    assert all(r.kept for r in quality_rules(df, loose).collect())


def test_no_python_in_native_plans(small):
    from logstow.llm.pii import pii

    for df in (quality_rules(small), pii(small)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
