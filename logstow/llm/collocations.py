"""Phrases that stand out, by dynamic itemset counting.

Every word becomes a number of 32 bits once, and the texts of numbers are dealt into
shards that are scanned one after the other, round and round. Words are counted from
the first shard on. A longer phrase is counted from the shard after the one in which
both phrases it is made of, without its last and without its first word, have reached
the threshold, and for one full cycle: so lengths are counted side by side. Counting
ends when no phrase that has come up is short of its cycle.

Counters are kept by a hash of the phrase, and dealt out by its first bits into buckets:
a row holds a run of counters, so what is shuffled and summed are runs, not single
counters. What may be counted is told to the tasks by
bit arrays of bounded size over the hashes that have reached the threshold. Hashes
that meet and bits that say yes too often make counts larger, never smaller, so what
falls short is rightly left out; a last scan counts the words of what remains exactly,
in runs of phrases by the same buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.hadoop import Folder
from logstow.llm.tables import least_of_each, text_of, written
from logstow.shared_dir import shared_dir

#: Language of documents without one.
NO_LANGUAGE = "und"
#: Bytes of text that are counted together; longer texts are cut between pieces.
BLOCK_BYTES = 4 << 20

# What ends a piece, and what parts words within it.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

WORD_BYTE, BLANK, PIECE_END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = BLANK
_KIND[list(ENDS)] = PIECE_END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A phrase's counter: the step it was begun in, and the one it reached the threshold in
#: or -1.
COUNTER = np.dtype([("hash", "<u8"), ("n", "<i8"), ("size", "<i2"), ("seen", "<i2"), ("reach", "<i2")])
#: Counters in a row of the state at most.
RUN = 1 << 12

STEP, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)

@dataclass(frozen=True)
class Mining:
    """What is mined.

    least: occurrences that make a phrase a candidate.
    longest: words of a phrase at most.
    cover: percent of its occurrences that a longer phrase must have to displace it.
    top: phrases reported of each language.
    shards: parts of a cycle.
    filter_bits: bound of either bit array that is sent to tasks, a power of two.
    """

    least: int = 30
    longest: int = 4
    cover: int = 80
    top: int = 2000
    shards: int = 2
    filter_bits: int = 1 << 26


def _scattered(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * SPREAD
    return x ^ (x >> np.uint64(29))


def _mixed(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all words but the last, and the last's numbers."""
    return _scattered(first * STEP + then)


def _bits_of(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in an array of n bits."""
    mask = np.uint64(n - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether an array of 64-bit words may have the hashes in it."""

    def is_set(at: np.ndarray) -> np.ndarray:
        return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    first, second = _bits_of(hashes, 64 * len(bits))
    return is_set(first) & is_set(second)


def _sums(letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash, not yet scattered, of the bytes between each two bounds, which are not equal."""
    sizes = np.diff(bounds)
    place = np.arange(len(letters)) - np.repeat(bounds[:-1], sizes)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, STEP))
    return np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * powers[place], bounds[:-1])


class Words:
    """The words of some texts.

    code: their numbers, the same for a word wherever a language has it, with a 0
        where a piece or a text ends.
    at: where in code each word is.
    letters, bounds: the words' bytes, one after the other.
    """

    def __init__(self, texts: list[np.ndarray], langs: list[str]):
        data = _LOWER[np.concatenate(texts)]
        begins = np.cumsum([0, *(len(t) for t in texts)])
        kind = _KIND[data]
        is_word = kind == WORD_BYTE
        starting = is_word.copy()
        starting[1:] &= ~is_word[:-1]
        inside = begins[begins < len(data)]
        starting[inside] |= is_word[inside]
        starts = np.flatnonzero(starting)
        self.letters = data[is_word]
        self.bounds = np.append((np.cumsum(is_word, dtype=np.int32) - 1)[starts], len(self.letters))
        first = np.searchsorted(starts, begins)
        self.words = np.diff(first)
        doc = np.repeat(np.arange(len(texts)), self.words)
        ends = np.cumsum(kind == PIECE_END, dtype=np.int32)[starts] + doc.astype(np.int32)
        # One 0 wherever something ends between two words, and after each text.
        breaks = np.diff(ends, prepend=ends[:1]) > 0
        self.at = np.arange(len(starts)) + np.cumsum(breaks)
        self.code = np.zeros(len(starts) + int(breaks.sum()) + 1, np.uint32)
        self.code[self.at] = self._numbers(np.array([_seed(lang) for lang in langs], np.uint64)[doc])
        #: Where in code each text begins.
        self.begins = np.append(self.at, len(self.code))[first[:-1]]
        self.doc = doc

    def _numbers(self, seeds: np.ndarray) -> np.ndarray:
        if not len(seeds):
            return np.zeros(0, np.uint32)
        sums = _sums(self.letters, self.bounds)
        return np.maximum(_scattered(sums ^ seeds) >> np.uint64(32), np.uint64(1)).astype(np.uint32)

    def spelled(self) -> pa.Array:
        return pa.Array.from_buffers(
            pa.binary(), len(self.at), [None, pa.py_buffer(self.bounds.astype(np.int32)), pa.py_buffer(self.letters)]
        )


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang)


def phrases(code: np.ndarray, longest: int, extends):
    """(size, where phrases begin, their hashes), by size, of all phrases whose parts
    `extends(hashes)` holds for."""
    at = np.flatnonzero(code)
    hashes = _scattered(code[at].astype(np.uint64) * STEP)
    yield 1, at, hashes
    for size in range(2, longest + 1):
        good = extends(hashes)
        # The part without the first word is the one that begins a word further on.
        whole = np.flatnonzero((at[1:] == at[:-1] + 1) & good[1:] & good[:-1])
        at = at[whole]
        hashes = _mixed(hashes[whole], code[at + size - 1].astype(np.uint64))
        yield size, at, hashes


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[str]]]:
    """Texts as bytes with their languages, in blocks of bounded size."""
    texts, langs, held = [], [], 0
    for batch in batches:
        column = batch.column("text")
        for lang, value in zip(batch.column("lang").to_pylist(), column, strict=True):
            data = np.frombuffer(value.as_buffer(), np.uint8)
            while len(data):
                part = data
                if len(data) > BLOCK_BYTES:
                    ends = np.flatnonzero(_KIND[data[:BLOCK_BYTES]] == PIECE_END)
                    if not len(ends):
                        ends = np.flatnonzero(_KIND[data] == PIECE_END)[:1]
                    if len(ends):
                        part = data[: ends[-1] + 1]
                data = data[len(part) :]
                texts.append(part)
                langs.append(lang)
                held += len(part)
                if held >= BLOCK_BYTES:
                    yield texts, langs
                    texts, langs, held = [], [], 0
    if texts:
        yield texts, langs
    pa.default_memory_pool().release_unused()


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, words, code): the number of words and their numbers, by text."""
    for texts, langs in _texts(batches):
        found = Words(texts, langs)
        ends = np.append(found.begins[1:], len(found.code))
        for some in range(0, len(texts), 256):
            own = slice(some, some + 256)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[own], pa.string()),
                    pa.array(found.words[own].astype(np.int64)),
                    pa.array(
                        [found.code[a:b].tobytes() for a, b in zip(found.begins[own], ends[own], strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["lang", "words", "code"],
            )


#: Words whose phrases are counted together before they are shuffled.
BLOCK_WORDS = 1 << 21


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, n = [], 0
    for batch in batches:
        for value in batch.column("code"):
            held.append(np.frombuffer(value.as_buffer(), np.uint32))
            n += len(held[-1])
            if n >= BLOCK_WORDS:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def _bucket_bits(words: int) -> int:
    """Bits of a hash that tell its bucket, for buckets of about a quarter million words."""
    return min(24, max(4, (words >> 18).bit_length()))


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _runs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values from each start to the next, as bytes."""
    bounds = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(values.tobytes())]
    )


def _values(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """The values of all runs of a column, one after the other."""
    runs = [np.frombuffer(v.as_buffer(), dtype) for v in column]
    return np.concatenate([np.zeros(0, dtype), *runs])


def _count_shard(words: bool, filters, longest: int, step: int, bits: int):
    """Rows (bucket, open, reached) of new counters: a run for each size and bucket."""

    def counted(size: int, hashes: np.ndarray) -> pa.RecordBatch:
        distinct, n = np.unique(hashes, return_counts=True)
        counters = np.empty(len(distinct), COUNTER)
        counters["hash"], counters["n"], counters["size"] = distinct, n, size
        counters["seen"], counters["reach"] = step, -1
        bucket = _buckets(distinct, bits)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[starts].astype(np.int32)),
                _runs(counters, starts),
                pa.array([b""] * len(starts), pa.binary()),
            ],
            names=["bucket", "open", "reached"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code in _codes(batches):
            if filters is None:
                hashes = next(phrases(code, 1, None))[2]
                if len(hashes):
                    yield counted(1, hashes)
                continue
            reached, recent = filters.value
            before = None
            for size, at, hashes in phrases(code, longest, lambda h: _holds(reached, h)):
                if size == 1:
                    chosen = hashes if words else hashes[:0]
                else:
                    # Counted from when the later of both parts has come up, for a cycle.
                    new = _holds(recent, before[1])
                    first = np.searchsorted(before[0], at)
                    chosen = hashes[new[first] | new[np.minimum(first + 1, len(new) - 1)]]
                before = (at, hashes)
                if len(chosen):
                    yield counted(size, chosen)

    return run


def _sum_counters(step: int, cycle: int, least: int, longest: int):
    """The counters of a bucket after a step.

    Rows (bucket, open, reached, parts, last): runs of counters below the threshold whose
    cycle goes on, and of those that have reached it; of the latter, how many can be part
    of a longer phrase, and the step in which the last of these has come up, or -1.
    """

    def run(table: pa.Table) -> pa.Table:
        given = np.concatenate([_values(table.column(c), COUNTER) for c in ("open", "reached")])
        given = given[np.argsort(given["hash"], kind="stable")]
        starts = np.flatnonzero(np.append(True, given["hash"][1:] != given["hash"][:-1]))
        counters = given[starts]
        counters["n"] = np.add.reduceat(given["n"], starts)
        counters["size"] = np.minimum.reduceat(given["size"], starts)
        counters["seen"] = np.minimum.reduceat(given["seen"], starts)
        counters["reach"] = np.maximum.reduceat(given["reach"], starts)
        over = counters["n"] >= least
        counters["reach"][over & (counters["reach"] < 0)] = step
        going = counters[~over & (counters["seen"] + cycle > step + 1)]
        reached = counters[over]
        own, opened, ended = [], [], []
        for at in range(0, max(len(going), len(reached)), RUN):
            part = reached[at : at + RUN]
            reach = part["reach"][part["size"] < longest]
            own.append((len(reach), int(reach.max(initial=-1))))
            opened.append(going[at : at + RUN].tobytes())
            ended.append(part.tobytes())
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()] * len(own), pa.int32()),
                "open": pa.array(opened, pa.binary()),
                "reached": pa.array(ended, pa.binary()),
                "parts": pa.array([n for n, _ in own], pa.int64()),
                "last": pa.array([last for _, last in own], pa.int32()),
            }
        )

    return run


def _spell(filters, longest: int):
    """Rows (lang, size, phrase, n) of the phrases whose hashes are among the bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bits, _) = filters.value
        for texts, langs in _texts(batches):
            found = Words(texts, langs)
            spelled, lang = found.spelled(), pa.array(langs, pa.string())
            # From a place in code to the number of the word there.
            number = np.zeros(len(found.code), np.int64)
            number[found.at] = np.arange(len(found.at))
            for size, at, hashes in phrases(found.code, longest, lambda h: _holds(bits, h)):
                # Words are told apart by language and bytes, not by their numbers.
                mine = number[at[_holds(bits, hashes)]]
                if not len(mine):
                    break
                if size == 1:
                    words = spelled.dictionary_encode()
                    names, of_lang = np.unique(np.array(langs, str), return_inverse=True)
                    token = of_lang[found.doc] * len(words.dictionary) + words.indices.to_numpy()
                    _, token = np.unique(token, return_inverse=True)
                ids = token[mine]
                for k in range(1, size):
                    _, ids = np.unique(ids * (len(token) + 1) + token[mine + k], return_inverse=True)
                _, first, n = np.unique(ids, return_index=True, return_counts=True)
                begin = mine[first]
                parts = [spelled.take(pa.array(begin + k)) for k in range(size)]
                phrase = pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.take(pa.array(found.doc[begin])),
                        pa.array(np.full(len(begin), size, np.int32)),
                        phrase.cast(pa.string()),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )

    return run


#: Spelled phrases that are dealt into buckets together.
BLOCK_PHRASES = 1 << 18


def _deal(spell, bits: int):
    """Rows (lang, bucket, phrases, n) of what `spell` gives: a language's phrases of a
    bucket, parted by line feeds, which no word has in it."""

    def dealt(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        phrase = rows.column("phrase").combine_chunks()
        bounds = np.frombuffer(phrase.buffers()[1], np.int32)[: len(phrase) + 1].astype(np.int64)
        bucket = _buckets(_scattered(_sums(np.frombuffer(phrase.buffers()[2], np.uint8), bounds)), bits)
        key = (lang.indices.to_numpy().astype(np.int64) << bits) + bucket
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        ends = pa.array(np.append(starts, len(key)).astype(np.int32))
        runs = pa.ListArray.from_arrays(ends, phrase.take(pa.array(order)))
        return pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(key[starts] >> bits)),
                pa.array((key[starts] & ((1 << bits) - 1)).astype(np.int32)),
                pc.binary_join(runs, "\n"),
                _runs(rows.column("n").to_numpy()[order], starts),
            ],
            names=["lang", "bucket", "phrases", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in spell(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_PHRASES:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    return run


def _sum_phrases(least: int):
    """Rows (lang, size, phrase, n) of a language's phrases in a bucket that are frequent."""

    def run(table: pa.Table) -> pa.Table:
        spelt = pc.list_flatten(pc.split_pattern(table.column("phrases"), "\n"))
        counted = pa.table({"phrase": spelt, "n": _values(table.column("n"), np.int64)})
        total = counted.group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        total = total.filter(pc.greater_equal(total.column("n_sum"), least))
        size = pc.add(pc.count_substring(total.column("phrase"), " "), 1)
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * len(total), pa.string()),
                "size": size.cast(pa.int32()),
                "phrase": total.column("phrase"),
                "n": total.column("n_sum"),
            }
        )

    return run


def _set_bits(n: int, since: int, below: int):
    """Rows (recent, slot, bits) that set the bits of what has reached the threshold and
    has fewer than `below` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counters = _values(batch.column("reached"), COUNTER)
            counters = counters[counters["size"] < below]
            hashes, new = counters["hash"], counters["reach"] >= since
            for recent, chosen in ((False, hashes), (True, hashes[new])):
                at = np.concatenate(_bits_of(chosen, n))
                bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), recent)), pa.array(at >> 6), pa.array(bits.view(np.int64))],
                    names=["recent", "slot", "bits"],
                )

    return run


def _filters(state: DataFrame, count: int, since: int, below: int, most: int):
    """Both bit arrays, for the tasks: 16 bits a phrase, but a bounded number of all."""
    n = min(most, max(1 << 10, 1 << (16 * count - 1).bit_length()))
    rows = (
        state.select("reached")
        .mapInArrow(_set_bits(n, since, below), "recent boolean, slot long, bits long")
        .groupBy("recent", "slot")
        .agg(F.bit_or("bits").alias("bits"))
    )
    arrays = {False: np.zeros(n // 64, np.uint64), True: np.zeros(n // 64, np.uint64)}
    for batch in rows.toArrow().to_batches():
        recent, slot, bits = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for which, array in arrays.items():
            array[slot[recent == which]] = bits[recent == which].view(np.uint64)
    return state.sparkSession.sparkContext.broadcast((arrays[False], arrays[True]))


COUNTED = "bucket int, open binary, reached binary"
STATE = f"{COUNTED}, parts long, last int"


def count_phrases(docs: DataFrame, rule: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n) of every phrase with at least `least` occurrences, and
    (lang, n) with the words of every language."""
    spark, cycle = docs.sparkSession, rule.shards
    folder = shared_dir(spark, "phrases")
    scratch = Folder(spark, folder)
    texts = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), text_of().alias("text")
    )
    (
        texts.mapInArrow(_encode, "lang string, words long, code binary")
        .withColumn("shard", (F.monotonically_increasing_id() % cycle).cast("int"))
        .write.partitionBy("shard")
        .parquet(f"{folder}/codes")
    )
    codes = spark.read.schema("lang string, words long, code binary, shard int").parquet(
        f"{folder}/codes"
    )
    totals = written(codes.groupBy("lang").agg(F.sum("words").alias("n")), "phrase-words")
    bits = _bucket_bits(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    state, filters, step = spark.createDataFrame([], STATE), None, 0
    while True:
        counted = (
            codes.filter(F.col("shard") == step % cycle)
            .select("code")
            .mapInArrow(_count_shard(step < cycle, filters, rule.longest, step, bits), COUNTED)
        )
        updated = (
            state.select("bucket", "open", "reached")
            .unionByName(counted)
            .groupBy("bucket")
            .applyInArrow(_sum_counters(step, cycle, rule.least, rule.longest), STATE)
        )
        updated.write.parquet(f"{folder}/state-{step}")
        state = spark.read.schema(STATE).parquet(f"{folder}/state-{step}")
        scratch.delete(f"state-{step - 1}")
        seen = state.agg(
            F.coalesce(F.sum("parts"), F.lit(0)).alias("n"),
            F.coalesce(F.max("last"), F.lit(-1)).alias("last"),
        ).first()
        # What the latest to reach the threshold can be part of has had its cycle then.
        if step >= cycle - 1 and (seen.last < 0 or step >= seen.last + cycle):
            break
        if filters is not None:
            filters.unpersist()
        step += 1
        filters = _filters(state, seen.n, step - cycle, rule.longest, rule.filter_bits) if seen.n else None
    scratch.delete("codes")
    size = F.coalesce(F.sum(F.octet_length("reached")), F.lit(0)) / COUNTER.itemsize
    frequent = int(state.agg(size).first()[0])
    chosen = _filters(state, max(1, frequent), 0, rule.longest + 1, rule.filter_bits)
    spelled = (
        texts.mapInArrow(
            _deal(_spell(chosen, rule.longest), bits),
            "lang string, bucket int, phrases string, n binary",
        )
        .groupBy("lang", "bucket")
        .applyInArrow(_sum_phrases(rule.least), "lang string, size int, phrase string, n long")
    )
    return written(spelled, "phrase-counts"), totals


def score_phrases(frequent: DataFrame, rule: Mining = Mining()) -> DataFrame:
    """lang, size, phrase, a, l, r, score of the phrases that no longer one displaces.

    Of all cuts of a phrase into two, the one that scores least counts, of equal ones
    the first. Products are decimals, which do not overflow below 10 to the 38th.
    """
    candidates = frequent.filter("size > 1").withColumnRenamed("n", "a")
    cuts = (
        candidates.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)")))
        .withColumn("head", F.expr("substring_index(phrase, ' ', cut)"))
        .withColumn("tail", F.expr("substring_index(phrase, ' ', cut - size)"))
        .join(frequent.selectExpr("lang", "phrase AS head", "n AS l"), ["lang", "head"])
        .join(frequent.selectExpr("lang", "phrase AS tail", "n AS r"), ["lang", "tail"])
        .withColumn(
            "score",
            F.expr(
                "(cast(a AS decimal(20, 0)) * 2000000) div "
                "(cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))"
            ),
        )
    )
    scored = cuts.groupBy("lang", "size", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("least")
    )
    # Every shorter phrase within a candidate, with the most occurrences of one around it.
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    around = (
        candidates.filter("size > 2")
        .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    covered = F.expr(
        f"cast(longer AS decimal(20, 0)) * 100 >= cast(a AS decimal(20, 0)) * {rule.cover}"
    )
    return (
        scored.join(around, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | ~covered)
        .select("lang", "size", "phrase", "a", "least.l", "least.r", "least.score")
    )


def phrase_collocations(docs: DataFrame, rule: Mining = Mining()) -> DataFrame:
    """The phrases of every language that stand out most.

    docs: text and lang; A-Z count as a-z. Returns lang (`und` where it is null), rank
    (from 1, by score and occurrences descending, then phrase by bytes), phrase, a, l,
    r, n, score. Null and empty texts have no phrase; repeated rows count each time; an
    empty table, or a language without a phrase often enough, gives no rows.
    """
    frequent, totals = count_phrases(docs, rule)
    scored = score_phrases(frequent, rule).withColumns(
        {"less_score": -F.col("score"), "less_a": -F.col("a")}
    )
    top = least_of_each(scored, "lang", ["less_score", "less_a", "phrase"], rule.top)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
