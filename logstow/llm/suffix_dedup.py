"""Removal of byte strings that start more than once, by prefix-free parsing.

A rolling hash picks triggers: the trigger of a start position is the least hash
among the next `reach` positions. It depends on the following `length` bytes
alone, so equal strings have equal triggers at equal distances. Starts that share
a trigger form a phrase; the phrase's dictionary entry is all that those strings
can see. Most of a corpus is then settled without looking at single bytes:

* A trigger whose seed, the bytes that all its strings hold, is found once
  starts no repeated string.
* An entry found twice starts only repeated strings.
* Other entries that share a seed are told apart by the suffix array of the
  dictionary: their suffixes in order, where equal neighbours are repeated.

Only one occurrence of every entry takes part in the last step, however often the
parse refers to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstow.llm.tables import release, slices, text_of, written

#: Bytes of a string that must not repeat, and start positions a trigger reaches.
LENGTH, REACH = 200, 152
WINDOW = 16  # bytes of the rolling hash
BLOCK = 1 << 20  # starts parsed at a time, so that long texts take little memory
#: Entries of one seed that are sorted together; seeds with more go by hash first.
TOGETHER = 500
#: Starts in a run of those, level by level; each length divides the one before.
RUNS = (48, 12, 3, 1)

_SEED_BYTES = LENGTH - REACH + 1
_FACTOR = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


def _hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash of every window, by doubling."""
    h, factor, size = data.astype(np.uint64) + np.uint64(1), _FACTOR, 1
    while size < WINDOW:
        h = h[:-size] + np.uint64(factor) * h[size:]
        factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        size *= 2
    h = h * np.uint64(_MIX)
    h ^= h >> np.uint64(32)
    return h * np.uint64(_MIX)


def _least_ahead(keys: np.ndarray, reach: int) -> np.ndarray:
    """Minimum over the next `reach` keys, for every position that has them."""
    out, size = keys, 1
    while 2 * size <= reach:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = len(keys) - reach + 1
    return np.minimum(out[:rest], out[reach - size :][:rest])


def parse(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of every phrase, and its trigger's position."""
    firsts, lasts, triggers = [], [], []
    starts = len(text) - LENGTH + 1
    data = np.frombuffer(text, dtype=np.uint8)
    low = np.uint64(0xFFFFFFFF)
    for at in range(0, max(starts, 0), BLOCK):
        n = min(BLOCK, starts - at)
        hashes = _hashes(data[at : at + n + REACH + WINDOW - 2])
        # Of equal hashes the last one counts; its position is kept below the hash.
        keys = hashes >> np.uint64(32) << np.uint64(32)
        keys |= low - np.arange(len(keys), dtype=np.uint64)
        trigger = (low - (_least_ahead(keys, REACH) & low)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], trigger[1:] != trigger[:-1])))
        firsts.append(at + new)
        lasts.append(at + np.concatenate((new[1:], [n])) - 1)
        triggers.append(at + trigger[new])
    if not firsts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(triggers)


def _key() -> list[Column]:
    """What tells one text of the corpus from others: its id and a hash of it."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text_of()).alias("text_hash"),
    ]


def phrases(docs: DataFrame) -> DataFrame:
    """The parse: seed, entry (hashes), doc, text_hash, first and shape of each phrase.

    shape holds the trigger's distance from the first start times 256, and the
    number of starts.
    """
    names = ["seed", "entry", "doc", "text_hash", "first", "shape"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches):
            seeds, entries, firsts, shapes, counts = [], [], [], [], []
            for text in batch.column(2):
                data = text.as_py().encode("utf-8", "surrogatepass")
                first, last, trigger = parse(data)
                counts.append(len(first))
                firsts.append(first)
                shapes.append((trigger - first) * 256 + last - first + 1)
                seeds += [digest(data[t : t + _SEED_BYTES]) for t in trigger.tolist()]
                # The distance of the trigger is part of what an entry is.
                entries += [
                    digest(data[a : b + LENGTH], t - a)
                    for a, b, t in zip(
                        first.tolist(), last.tolist(), trigger.tolist(), strict=True
                    )
                ]
            if not seeds:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(seeds, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(entries, dtype=np.uint64).view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), counts)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), counts)),
                    pa.array(np.concatenate(firsts).astype(np.int64)),
                    pa.array(np.concatenate(shapes).astype(np.int32)),
                ],
                names=names,
            )

    return docs.select(*_key(), text_of()).mapInArrow(
        run, "seed long, entry long, doc long, text_hash long, first long, shape int"
    )


def _contexts(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries with their bytes, cut from the one text each was seen in."""
    by_text = entries.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("seed", "n", "classes", "first", "shape")).alias("wanted")
    )
    names = ["seed", "n", "classes", "doc", "text_hash", "first", "distance", "data"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.binary()]
            columns = [pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in slices(batches):
            for doc, text_hash, text, wanted in zip(*batch.columns, strict=True):
                doc, text_hash = doc.as_py(), text_hash.as_py()
                data = text.as_py().encode("utf-8", "surrogatepass")
                for w in wanted.as_py():
                    first, (distance, starts) = w["first"], divmod(w["shape"], 256)
                    where = (doc, text_hash, first, distance)
                    piece = data[first : first + starts - 1 + LENGTH]
                    found.append((w["seed"], w["n"], w["classes"], *where, piece))
                if len(found) >= 4096:
                    yield flush()
        if found:
            yield flush()

    return (
        docs.select(*_key(), text_of().alias("text"))
        .join(by_text, ["doc", "text_hash"])
        .select("doc", "text_hash", "text", "wanted")
        .mapInArrow(run, schema)
    )


SPANS = "doc long, text_hash long, first long, last long"


def _sorted_groups(entries: DataFrame) -> DataFrame:
    """Starts, of entries found once, whose string another entry of the seed holds.

    A task sorts the suffixes of one seed's entries at a time. There are at most
    TOGETHER entries with REACH suffixes each.
    """

    def settle(rows: list[tuple]) -> Iterator[tuple]:
        suffixes = sorted(
            (data[i : i + LENGTH], no, i)
            for no, (*_, data) in enumerate(rows)
            for i in range(len(data) - LENGTH + 1)
        )
        previous = (b"", -1, -1)
        for suffix in suffixes:
            if suffix[0] == previous[0]:
                yield previous[1:]
                yield suffix[1:]
            previous = suffix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[list[tuple]]:
            current, rows = None, []
            for batch in slices(batches):
                for seed, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if seed != current:
                        if rows:
                            yield rows
                        current, rows = seed, []
                    rows.append(tuple(row))
            if rows:
                yield rows

        found: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in found], pa.int64()) for i in range(4)]
            found.clear()
            return pa.RecordBatch.from_arrays(
                columns, names=["doc", "text_hash", "first", "last"]
            )

        for rows in groups():
            marks = {(no, i) for no, i in settle(rows) if rows[no][0] == 1}
            run_of = None
            for no, i in sorted(marks):
                if run_of and run_of[0] == no and run_of[2] == i - 1:
                    run_of[2] = i
                    continue
                if run_of:
                    found.append(_span(rows, run_of))
                run_of = [no, i, i]
            if run_of:
                found.append(_span(rows, run_of))
            if len(found) >= 4096:
                yield flush()
        if found:
            yield flush()

    return (
        entries.select("seed", "n", "doc", "text_hash", "first", "data")
        .repartition("seed")
        .sortWithinPartitions("seed")
        .mapInArrow(run, SPANS)
    )


def _span(rows: list[tuple], run_of: list[int]) -> tuple[int, int, int, int]:
    no, begin, end = run_of
    _, doc, text_hash, first, _ = rows[no]
    return doc, text_hash, first + begin, first + end


def _runs(entries: DataFrame, size: int) -> DataFrame:
    """Entries cut into runs of `size` starts, counted back from the trigger.

    The seed of a run is a hash of the bytes that all strings of its place hold, so
    runs of different seeds share no string. high and low are a hash of 128 bits of
    what the run's strings can see.
    """
    names = ["seed", "high", "low", "n", "doc", "text_hash", "first", "distance", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_of, digest = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_intdigest
        for batch in slices(batches):
            for at in range(0, batch.num_rows, 512):
                found = []
                part = batch.slice(at, 512)
                for n, doc, text_hash, first, distance, data in zip(
                    *(c.to_pylist() for c in part.columns), strict=True
                ):
                    i, starts = 0, len(data) - LENGTH + 1
                    while i < starts:
                        slot = (distance - i) // size
                        stop = min(starts, distance - slot * size + 1)
                        piece = data[i : stop - 1 + LENGTH]
                        # From the place's last start on, to the end of its first string.
                        farthest = min((slot + 1) * size, REACH) - 1
                        core = data[distance - slot * size : distance - farthest + LENGTH]
                        seed = seed_of(core, slot) - (1 << 63)
                        both = digest(piece, distance - i)
                        high, low = (x - (1 << 63) for x in divmod(both, 1 << 64))
                        where = (doc, text_hash, first + i, distance - i)
                        found.append((seed, high, low, n, *where, piece))
                        i = stop
                kinds = [pa.int64()] * 8 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)],
                    names=names,
                )

    columns = ["n", "doc", "text_hash", "first", "distance", "data"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", data binary"
    return entries.select(*columns).mapInArrow(run, schema)


def _hashed_runs(entries: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """The same as `_sorted_groups` for seeds with many entries.

    Entries are cut into a few long runs, which have seeds of their own. A run found
    twice is settled, and so is one whose seed nothing else has. Of the others one of
    each kind goes on: to the sorted groups where its seed has become rare enough, else
    to be cut further. An entry between a text of its own and a common passage goes on
    with the one run that holds the border. Nothing of a seed needs to be in one task.
    """
    runs = written(_runs(entries, sizes[0]), "suffix-runs")
    kind = ["seed", "high", "low"]
    seen = F.struct("n", "doc", "text_hash", "first", "distance", "data")
    kinds = written(
        runs.groupBy(*kind).agg(F.count(F.lit(1)).alias("found"), F.min(seen).alias("seen")),
        "suffix-kinds",
    )
    spans = (
        runs.filter("n = 1")
        .join(kinds.filter("found > 1").select(*kind), kind)
        .select(
            "doc",
            "text_hash",
            "first",
            (F.col("first") + F.octet_length("data") - LENGTH).alias("last"),
        )
    )
    if len(sizes) == 1:
        return spans
    single = F.when(F.col("found") == 1, F.col("seen.n")).otherwise(F.lit(2))
    open_seeds = written(
        kinds.groupBy("seed")
        .agg(F.count(F.lit(1)).alias("classes"), F.min(single).alias("least"))
        .filter("least = 1 AND classes > 1")
        .select("seed", "classes"),
        "suffix-open",
    )
    rest = kinds.join(open_seeds, "seed").select(
        "seed",
        "classes",
        single.alias("n"),
        *(f"seen.{c}" for c in ("doc", "text_hash", "first", "distance", "data")),
    )
    spans = spans.unionByName(_sorted_groups(rest.filter(F.col("classes") <= TOGETHER)))
    if open_seeds.filter(F.col("classes") > TOGETHER).isEmpty():
        return spans
    return spans.unionByName(
        _hashed_runs(rest.filter(F.col("classes") > TOGETHER), sizes[1:])
    )


def repeated_starts(docs: DataFrame) -> DataFrame:
    """Rows (doc, text_hash, first, last): starts of strings that start elsewhere too."""
    parsed = phrases(docs)
    # Counts per seed, added up in every task first. Two different entries of a seed
    # show in the least and the greatest of them.
    seeds = written(
        parsed.groupBy("seed")
        .agg(F.count(F.lit(1)).alias("n"), F.min("entry").alias("a"), F.max("entry").alias("b"))
        .filter("n > 1")
        .select("seed", (F.col("a") != F.col("b")).alias("mixed")),
        "suffix-seeds",
    )
    release(docs.sparkSession)
    shared = written(parsed.join(seeds, "seed"), "suffix-phrases")
    release(docs.sparkSession)
    last = (F.col("first") + F.col("shape") % 256 - 1).alias("last")
    span = ["doc", "text_hash", "first", last]
    plain = shared.filter(~F.col("mixed")).select(*span)

    mixed = shared.filter("mixed")
    seen_in = F.struct("doc", "text_hash", "first", "shape")
    entries = written(
        mixed.groupBy("seed", "entry").agg(
            F.count(F.lit(1)).alias("n"), F.min(seen_in).alias("seen")
        ),
        "suffix-entries",
    )
    twice = (
        mixed.join(entries.filter("n > 1").select("seed", "entry"), ["seed", "entry"])
        .select(*span)
    )
    # Seeds where some entry was found once; others have nothing left to settle.
    open_seeds = written(
        entries.groupBy("seed")
        .agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
        .filter("least = 1")
        .select("seed", "classes"),
        "suffix-open",
    )
    contexts = written(
        _contexts(docs, entries.join(open_seeds, "seed").select("seed", "n", "classes", "seen.*")),
        "suffix-dictionary",
    )
    release(docs.sparkSession)
    few = _sorted_groups(contexts.filter(F.col("classes") <= TOGETHER))
    many = _hashed_runs(contexts.filter(F.col("classes") > TOGETHER), RUNS)
    return plain.unionByName(twice).unionByName(few).unionByName(many)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Every document without the bytes that a repeated string covers.

    Takes doc_id and text. Returns doc_id, n_bytes, n_removed, n_spans (maximal
    runs) and kept_sha256. Texts of fewer than LENGTH bytes lose nothing; a null
    text counts as empty. Copies lose everything that is long enough, in all of
    their places, and so do repeated rows. An empty table gives an empty result.
    """
    removed = repeated_starts(docs).groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("first", "last")).alias("spans")
    )
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                kept, at, runs = [], 0, 0
                for first, last in sorted((s["first"], s["last"]) for s in spans.as_py() or ()):
                    # Runs that touch are one run.
                    if first > at or not runs:
                        kept.append(data[at:first])
                        runs += 1
                    at = max(at, last + LENGTH)
                kept.append(data[at:])
                rest = b"".join(kept)
                out[0].append(len(data))
                out[1].append(len(data) - len(rest))
                out[2].append(runs)
                out[3].append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3], pa.string())],
                names=names,
            )

    return (
        docs.select(F.col("doc_id").cast("long"), *_key(), text_of().alias("text"))
        .join(removed, ["doc", "text_hash"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
    )
