import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from logstow.llm import suffix_dedup as sd

from .conftest import by_id


def brute(rows):
    strings = Counter()
    for _, text in rows:
        data = (text or "").encode()
        strings.update(data[i : i + 200] for i in range(len(data) - 199))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 199):
            if strings[data[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return by_id(out)


def mixed(seed):
    rng = random.Random(seed)
    def text(n):
        return "".join(rng.choice("abé \n") for _ in range(n))
    base = [text(rng.randint(150, 700)) for _ in range(8)]
    rows = []
    for i in range(70):
        x, y, kind = rng.choice(base), rng.choice(base), rng.random()
        at = rng.randint(0, len(x))
        if kind < 0.3:
            rows.append((i, x[:at] + "x" + x[at:]))
        elif kind < 0.6:
            rows.append((i, x[rng.randint(0, 300) :] + y[: rng.randint(0, 400)]))
        elif kind < 0.7:
            rows.append((i, rng.choice(["ab", "a", "abc"]) * rng.randint(50, 300)))
        else:
            rows.append((i, x if kind < 0.8 else text(300)))
    return rows + [
        (900, None), (901, ""), (902, base[0]), (902, base[0]), (903, base[1]), (903, base[2]),
        (None, base[3]), (None, "z" * 500),
    ]


@pytest.mark.parametrize("together, block, seed", [(500, 1 << 20, 1), (2, 1 << 20, 2), (500, 64, 3)])
def test_against_brute_force(spark, monkeypatch, together, block, seed):
    monkeypatch.setattr(sd, "TOGETHER", together)
    monkeypatch.setattr(sd, "BLOCK", block)
    rows = mixed(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(sd.suffix_dedup(df).collect()) == brute(rows)


def test_tables(small, awkward, nothing):
    for df in (small, awkward):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert by_id(sd.suffix_dedup(df).collect()) == brute(rows)
    assert sd.suffix_dedup(nothing).collect() == []


def test_equal_strings_have_equal_triggers():
    rng = np.random.default_rng(0)
    inner = rng.integers(97, 103, 600, dtype=np.uint8).tobytes()
    left, right = (rng.integers(97, 103, 333, dtype=np.uint8).tobytes() for _ in range(2))

    def trigger_of(data):
        first, last, trigger = sd.parse(data)
        assert (trigger >= last).all() and (trigger < first + sd.REACH).all()
        assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
        return np.repeat(trigger, last - first + 1)

    whole, alone = trigger_of(left + inner + right), trigger_of(inner)
    assert (whole[333 : 333 + 401] - 333 == alone).all()
    assert len(sd.parse(b"x" * 199)[0]) == 0


def test_many_entries_of_a_seed_are_cut_into_few_runs(spark, monkeypatch):
    """A passage in many texts has seeds with an entry for each of them."""
    rng, made, real = random.Random(7), [], sd._runs
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, near = word(900), word(700)
    rows = [(i, word(260) + passage + word(260)) for i in range(60)]
    for i in range(60, 100):
        at = rng.randint(0, 690)
        rows.append((i, near[:at] + word(4) + near[at + 4 :]))

    def counted(entries, size):
        runs = real(entries, size)
        made.append((entries.count(), runs.count()))
        return runs

    monkeypatch.setattr(sd, "TOGETHER", 8)
    monkeypatch.setattr(sd, "_runs", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(sd.suffix_dedup(df).collect()) == brute(rows)
    assert made[0][0] >= 100
    assert sum(n for _, n in made) <= 20 * made[0][0]
