import math

import numpy as np
import pytest

from logstow.llm.topk_search import Block, Blocks, is_query, top_k


def brute(rows, k=10):
    def usable(v):
        return v and all(
            x is not None and math.isfinite(x) and abs(x * 1024) < 2**31 - 1 for x in v
        )

    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = set()
    for i, q in good:
        if i % 100:
            continue
        found = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), j)
            for j, v in good
            if j != i and len(v) == len(q)
        )[:k]
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(found)}
    return out


@pytest.mark.parametrize("blocks", [Blocks(), Blocks(64, 2, 8), Blocks(10, 3, 1)])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) / 1024 for x in rng.integers(-3, 4, 5)]) for i in range(250)]
    rows += [(300 + i, [3.0, -2.5, 0.0, 1.0, 0.25]) for i in range(40)]  # ties
    rows += [
        (500, None), (600, []), (700, [None, 1.0]), (800, [math.nan] * 5), (900, [math.inf] * 5),
        (1000, [1.0, 2.0]), (1001, [1.0, 2.5]), (1100, [1e300] * 5), (1200, [7.0] * 3), (None, [1.0] * 5),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' AS v", "0 AS block", "1 AS part", "2 AS score"
    )
    got = top_k(df, df.filter(is_query()), blocks=blocks).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, top_k(df, df.filter(is_query())).collect()))
    assert got == [(0, 1, 1, 2048 * 1024), (0, 2, 1, 2048 * 1024)]
    assert top_k(df.limit(0), df.limit(0)).collect() == []
    assert top_k(df, df.limit(0)).collect() == []


def test_proof_keeps_all_of_the_best():
    rng = np.random.default_rng(4)
    values = rng.normal(0, 130, (3000, 16)).astype(np.int32)
    block = Block(np.arange(3000), values, 32)
    for i in range(0, 3000, 150):
        q = values[i].astype(np.int64)
        scores = values.astype(np.int64) @ q
        scores[i] = -(10**15)
        want = np.lexsort((np.arange(3000), -scores))[:10]
        ids, found = block.search(i, q, 10)
        assert (ids == want).all() and (found == scores[want]).all()
        assert len(block._possible(q, block.ids == i, 10, 80)) < 3000
