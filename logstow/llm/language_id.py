"""Language identification by compression.

Each language is a raw-content zstandard dictionary made of a few labelled
documents. A text belongs to the language whose dictionary makes it smallest.
Where that margin is narrow, a finer compressor, which also finds matches of
three bytes, decides; where it is narrow again, the document is rejected.

A dictionary saves a bounded number of bytes each time it is used. So a text is
compressed in blocks, each with the dictionary anew, and sizes are summed over all
of them: the margin is a share of the text that does not depend on its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from logstow.llm.tables import id_remainder, least_of_each, slices

LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Bytes of letters that are compressed with the dictionary at a time.
BLOCK = 16 * 1024


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample, which is all that is learned from.

    texts: documents taken per language, least hash of the id first.
    shortest, longest: characters of a text that is taken first, and whole.
    others: a language with fewer such texts, and a dictionary that is not full,
        also learns from so many of its other texts that hold a letter, as far as
        the dictionary goes: shorter ones whole, of longer ones the beginning.
    dictionary: bytes kept per language.
    languages: more labels than this are an error, since all dictionaries are
        sent to every task.
    """

    texts: int = 40
    shortest: int = 200
    longest: int = 4000
    others: int = 1000
    dictionary: int = 32 * 1024
    languages: int = 256


@dataclass(frozen=True)
class Languages:
    """Learned labels, commonest in the sample's population first."""

    names: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def letters_only(text: str) -> bytes:
    """Runs of letters, lower-cased, with one space between; empty without a letter.

    The pattern also takes signs such as superscript digits, which are no letters.
    """
    runs = LETTERS.findall(text.lower())
    if not any(c.isalpha() for run in runs for c in run):
        return b""
    return " ".join(runs).encode("utf-8", "surrogatepass")


def learn_languages(labelled: DataFrame, training: Training = Training()) -> Languages:
    """Dictionaries from rows (doc_id, text, lang) that may be learned from.

    Rows without a label are left out. Two small results come to the driver: the
    labels with their counts and the bounded sample.
    """
    known = labelled.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = known.groupBy("lang").count().limit(training.languages + 1).collect()
    if len(counts) > training.languages:
        raise ValueError(f"more than {training.languages} languages")
    names = [r["lang"] for r in sorted(counts, key=lambda r: (-r["count"], r["lang"]))]
    fit = F.length("text").between(training.shortest, training.longest)
    ids = known.filter(fit).select("lang", "doc_id", F.xxhash64("doc_id").alias("order"))
    chosen = least_of_each(ids, "lang", ["order", "doc_id"], training.texts).select(
        "lang", "doc_id", "rank"
    )
    rows = (
        known.filter(fit)
        .join(F.broadcast(chosen), ["lang", "doc_id"])  # texts x languages rows at most
        .groupBy("lang", "doc_id", "rank")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    joined: dict[str, bytes] = {}
    open_ones = []
    for name in names:
        texts = sorted((r["rank"], r["text"]) for r in rows if r["lang"] == name)
        joined[name] = b" ".join(letters_only(t) for _, t in texts)
        if len(texts) < training.texts and len(joined[name]) < training.dictionary:
            open_ones.append(name)
    if open_ones:
        rest = known.filter(F.col("lang").isin(open_ones) & ~fit)
        more = sorted((r["rank"], r["lang"], r["text"]) for r in _others(rest, training))
        for _, name, text in more:
            joined[name] += (b" " if joined[name] else b"") + letters_only(text)
    return Languages(tuple(names), tuple(joined[n][: training.dictionary] for n in names))


def _others(known: DataFrame, training: Training) -> list[Row]:
    """Texts (lang, rank, text) that fill a dictionary, each language's about twice.

    A long text gives an even part of the dictionary, at least `longest` characters.
    """
    size = F.least(F.length("text"), F.lit(training.longest))
    ids = (
        known.filter(F.col("text").rlike(r"\p{L}"))
        .groupBy("lang", "doc_id")
        .agg(F.min(size).alias("size"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    so_far = Window.partitionBy("lang").orderBy("rank")
    chosen = (
        least_of_each(ids, "lang", ["order", "doc_id"], training.others, salts=8)
        .withColumn("before", F.sum("size").over(so_far) - F.col("size"))
        .filter(F.col("before") < 2 * training.dictionary)
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    )
    part = F.greatest(F.lit(training.longest), (F.lit(training.dictionary) / F.col("n")).cast("int"))
    return (
        known.filter(F.col("text").rlike(r"\p{L}"))
        .join(F.broadcast(chosen), ["lang", "doc_id"])
        .groupBy("lang", "doc_id", "rank")
        .agg(F.min(F.substring(F.col("text"), F.lit(1), part)).alias("text"))
        .collect()
    )


class Classifier:
    """Compressors of one task."""

    def __init__(self, languages: Languages, narrow: float):
        self.names = languages.names
        self.narrow = narrow
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        fine = zstandard.ZstdCompressionParameters(
            min_match=3, strategy=zstandard.STRATEGY_BTOPT, window_log=18, chain_log=15,
            hash_log=15, search_log=2, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self.quick, self.fine = [], []
        for content in languages.dictionaries:
            if len(content) < 8:  # the library takes no shorter dictionary
                self.quick.append(zstandard.ZstdCompressor(level=5, **plain))
                self.fine.append(zstandard.ZstdCompressor(compression_params=fine))
                continue
            raw = zstandard.DICT_TYPE_RAWCONTENT
            d = zstandard.ZstdCompressionDict(content, dict_type=raw)
            d.precompute_compress(level=5)
            self.quick.append(zstandard.ZstdCompressor(level=5, dict_data=d, **plain))
            d = zstandard.ZstdCompressionDict(content, dict_type=raw)
            d.precompute_compress(compression_params=fine)
            self.fine.append(zstandard.ZstdCompressor(dict_data=d, compression_params=fine))

    def _smallest(self, compressors: list, text: bytes) -> tuple[int, int, int]:
        blocks = [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [s for i, s in enumerate(sizes) if i != best]
        return best, sizes[best], min(rest, default=len(text) + 1 + sizes[best])

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Label, score and whether it is rejected.

        Without a letter: (`und`, 0, True). Equal sizes go to the commoner label.
        """
        letters = letters_only(text) if text else b""
        if not letters or not self.names:
            return UNDETERMINED, 0.0, True
        best, size, second = self._smallest(self.quick, letters)
        rejected = False
        if second - size <= self.narrow * size:
            best, size, second = self._smallest(self.fine, letters)
            rejected = second - size <= self.narrow * size
        return self.names[best], 1.0 - 0.5 * 2.0 ** -min(second - size, 50), rejected


def identify(docs: DataFrame, languages: Languages, narrow: float = 0.002) -> DataFrame:
    """All columns of the documents, then lang_pred, lang_score and lang_rejected.

    Takes only `text`. Columns of these names in the input are replaced.
    narrow: margins of at most this share of the compressed size are narrow.
    """
    added = ["lang_pred", "lang_score", "lang_rejected"]
    kept = docs.drop(*added)
    at = kept.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(languages)
    schema = (
        StructType(list(kept.schema))
        .add("lang_pred", StringType())
        .add("lang_score", DoubleType())
        .add("lang_rejected", BooleanType())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value, narrow)
        for batch in slices(batches):
            found = [classifier.classify(t) for t in batch.column(at).to_pylist()]
            columns = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *added]
            )

    return kept.mapInArrow(run, schema)


def language_id(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Predicted language of every document, learned from two thirds of them.

    Takes doc_id, text and lang; other columns take no part. Returns doc_id,
    held_out, lang_pred, score and rejected. Rows whose crc32(doc_id) mod 3 is 1
    are held out of learning. Null, empty and letterless texts get `und`, score 0
    and are rejected; so is everything if no label can be learned. Repeated rows
    give repeated results, an empty table an empty one.
    """
    held_out = id_remainder(3) == 1
    languages = learn_languages(docs.filter(~held_out), training)
    return identify(docs.select("doc_id", "text"), languages).select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )
