"""Packing token pieces into sequences by best-two-fit.

Pieces of the same length can stand for each other, so what to pack is told by how
many there are of each length, which is a table of at most `capacity` rows however
many pieces there are. The method works on that table: a bin is filled greedily with
the longest pieces that fit; then its smallest piece gives way to two unpacked ones
that fill the gap more tightly, as long as two such are left. A bin that was found is
taken as often as the counts allow, which makes it a pattern. Spark numbers the
pieces of every length, and a piece's number tells its place in the patterns.
"""

from __future__ import annotations

import os
import struct
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from logstow.llm.ranking import ranked
from logstow.llm.tables import slices, text_of, written

CAPACITY = 2048
#: Id that ends a document.
END = 0
# White space that the tokenizer drops and nothing joins across: it may be fed words.
_SPACE = np.zeros(256, bool)
_SPACE[list(b"\t\n\v\f\r ")] = True
# Nor does it take a letter or digit of ASCII and one of these marks after it together.
_ALNUM, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
_MARK[list(b".,;:!?")] = True
#: Words that a Python worker remembers the ids of.
REMEMBERED = 1 << 18

PIECE_FIELDS = [
    StructField("piece", IntegerType()),
    StructField("start", LongType()),
    StructField("length", LongType()),
    StructField("ids", BinaryType()),
]


class WordEncoder:
    """Ids of texts by those of their words, each different one encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        # Letters of ASCII alone are one word of the model, in lower case.
        model = self.tokenizer.model
        plain = [w for w in words if w.isalpha()]
        for word in plain:
            ids = [token.id for token in model.tokenize(word.lower().decode())]
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        others = [w for w in words if not w.isalpha()]
        for at in range(0, len(others), 4096):
            some = [w.decode() for w in others[at : at + 4096]]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            begins = np.cumsum([0, *(len(w) + 1 for w in some)])
            starts = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            bounds = (4 * np.searchsorted(starts, begins)).tolist()
            self.known.update(
                (w, ids[a:b])
                for w, a, b in zip(others[at : at + 4096], bounds[:-1], bounds[1:], strict=True)
            )

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls."""
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        is_word = ~_SPACE[data]
        starting = is_word.copy()
        starting[1:] &= ~is_word[:-1]
        inside = bounds[:-1][bounds[:-1] < len(data)]
        starting[inside] |= is_word[inside]
        starting[1:] |= _MARK[data[1:]] & _ALNUM[data[:-1]]
        starts = np.flatnonzero(starting)
        if not len(starts):
            return [np.zeros(0, "<u4")] * len(texts)
        letters = data[is_word]
        ends = np.append((np.cumsum(is_word) - 1)[starts], len(letters))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
        ).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, distinct
        self._learn(new)
        ids = [self.known[w] for w in distinct]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        which = words.indices.to_numpy()
        own = sizes[which]
        upto = np.concatenate(([0], np.cumsum(own)))
        tokens = flat[np.repeat(begins[which] - upto[:-1], own) + np.arange(upto[-1])]
        at = upto[np.searchsorted(starts, bounds)]
        return [tokens[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, once per Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _cut(path: str, capacity: int, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(path), np.array([END], "<u4")
        for batch in slices(batches, 512):
            rows, numbers, starts, lengths, ids = [], [], [], [], []
            for row, found in enumerate(encode(batch.column("_text"))):
                tokens = np.concatenate([found, end])
                for start in range(0, len(tokens), capacity):
                    own = tokens[start : start + capacity]
                    rows.append(row)
                    numbers.append(start // capacity)
                    starts.append(start)
                    lengths.append(len(own))
                    ids.append(own.tobytes())
            taken = batch.select(others).take(pa.array(rows, pa.int64()))
            for at in range(0, len(rows), 1024):
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.slice(at, 1024).columns,
                        pa.array(numbers[at : at + 1024], pa.int32()),
                        pa.array(starts[at : at + 1024], pa.int64()),
                        pa.array(lengths[at : at + 1024], pa.int64()),
                        pa.array(ids[at : at + 1024], pa.binary()),
                    ],
                    names=[*others, *(f.name for f in PIECE_FIELDS)],
                )

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces of at most `capacity` tokens.

    tokenizer: file of the `tokenizers` library, at the same path on every machine.
    Returns doc_id, row (a unique number of the document's row), piece (from 0), start
    (ids of the document before it), length and ids (little-endian unsigned 32-bit). A
    document is its ids and an id 0; a null or empty text is that id alone. Only
    documents longer than the capacity are cut. Repeated rows are documents of their
    own, an empty table has no pieces.
    """
    rows = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), text_of().alias("_text")
    )
    kept = rows.drop("_text")
    return rows.mapInArrow(
        _cut(tokenizer, capacity, kept.columns), StructType([*kept.schema.fields, *PIECE_FIELDS])
    )


class _Unpacked:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.counts = Counter({n: c for n, c in counts.items() if c > 0})
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.lengths[bisect_left(self.lengths, length)]

    def put(self, length: int) -> None:
        if not self.counts[length]:
            insort(self.lengths, length)
        self.counts[length] += 1

    def longest(self, room: int) -> int | None:
        at = bisect_left(self.lengths, room + 1)
        return self.lengths[at - 1] if at else None

    def best_two(self, least: int, room: int) -> tuple[int, int] | None:
        """Two pieces whose sum is above `least` and nearest to `room`, not above it."""
        fitting = np.array(self.lengths[: bisect_left(self.lengths, room)], np.int64)
        if not len(fitting):
            return None
        partner = np.searchsorted(fitting, room - fitting, "right") - 1
        # A length with one piece left is no pair of its own: its neighbour below is.
        single = np.array([self.counts[int(n)] < 2 for n in fitting])
        partner = np.where((partner == np.arange(len(fitting))) & single, partner - 1, partner)
        sums = np.where(partner >= 0, fitting + fitting[partner], 0)
        at = int(np.argmax(sums))
        if sums[at] <= least:
            return None
        return int(fitting[at]), int(fitting[partner[at]])


def _bin(left: _Unpacked, capacity: int) -> Counter:
    """One bin's lengths, taken from what is left."""
    own, room = Counter(), capacity
    while (length := left.longest(room)) is not None:
        n = min(left.counts[length], room // length)
        left.take(length, n)
        own[length] += n
        room -= n * length
    while room:
        smallest = min(own)
        pair = left.best_two(smallest, room + smallest)
        if pair is None:
            break
        for length in pair:
            left.take(length, 1)
            own[length] += 1
        left.put(smallest)
        own[smallest] -= 1
        room += smallest - sum(pair)
        own += Counter()
    return own


def best_two_fit_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Bins for so many pieces of each length, as (how often, {length: pieces in it})."""
    left, patterns = _Unpacked(counts), []
    while left.lengths:
        own = _bin(left, capacity)
        # The same bin once more for as long as the counts allow.
        more = min(left.counts[length] // n for length, n in own.items())
        if more:
            for length, n in own.items():
                left.take(length, more * n)
        patterns.append((1 + more, dict(own)))
    return patterns


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Which pieces of a length go where: rows (length, first number, first sequence,
    pieces in a sequence, first offset), in order."""
    used, rows, sequence = Counter(), [], 0
    for times, own in patterns:
        offset = 0
        for length, n in sorted(own.items(), reverse=True):
            rows.append((length, used[length], sequence, n, offset))
            used[length] += times * n
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# A length and a number as one key; numbers stay below 2 to the 51st.
NUMBER_BITS = 51


def _place(slots, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of, low, sequence, n, offset = slots.value.T
        keys = (length_of << NUMBER_BITS) + low
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("position").to_numpy()
            at = np.searchsorted(keys, (length << NUMBER_BITS) + number, "right") - 1
            beyond = number - low[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(sequence[at] + beyond // n[at]),
                    pa.array(offset[at] + beyond % n[at] * length),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The pieces with `sequence_id` and `offset`, in few sequences of `capacity`.

    pieces: a written table with `length` (1 to capacity) and any other columns; those
        of these two names are replaced.
    order: columns that tell pieces of the same length apart, for a fixed result.
    """
    spark = pieces.sparkSession
    kept = pieces.drop("sequence_id", "offset", "position", "group_size", "group_start")
    # One row per length.
    counts = {r.length: r.n for r in kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be between 1 and {capacity}")
    slots = spark.sparkContext.broadcast(_slots(best_two_fit_patterns(counts, capacity)))
    numbered = ranked(kept, "length", order, "packing")
    places = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    return numbered.mapInArrow(
        _place(slots, kept.columns), StructType([*kept.schema.fields, *places])
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of every sequence, its pieces in order of offset."""
    own = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(own.alias("own"))
        .select(
            "sequence_id",
            F.aggregate("own.ids", F.lit(b""), lambda all_, one: F.concat(all_, one)).alias("ids"),
            F.col("own.doc_id").alias("doc_ids"),
        )
    )


def best_fit_packing(docs: DataFrame, tokenizer: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per
    piece. Nulls, empty texts and repeated rows as `token_pieces` has them.
    """
    pieces = token_pieces(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = pack(written(pieces, "packing-pieces"), ["doc_id", "piece", "ids_crc32", "row"])
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
