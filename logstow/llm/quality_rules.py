"""Quality rules: a threshold table compiled into one projection.

Every measure is a column expression over the document's own words, lines and
characters, and every row of the table turns into one comparison. No user
function runs and nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstow.llm.tables import WORD, text_of, words_of

# Frequent function words of the four languages served.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he this are or from at an"
    " der die und das ist nicht ein eine mit von zu den auf sich als im des dem für auch"
    " le la les de des et un une du que est en dans pour pas sur au avec par ce"
    " el los las y una es por con para no se su lo del al como"
).split()

#: (measure, bound, limit): a document is kept if it meets every row.
RULES: tuple[tuple[str, str, float], ...] = (
    ("n_words", "min", 50),
    ("n_words", "max", 1_000_000),
    ("mean_word_chars", "min", 2.5),
    ("mean_word_chars", "max", 14.0),
    ("symbols_per_word", "max", 0.1),
    ("exclamations_per_word", "max", 0.2),
    ("stop_word_share", "min", 0.05),
    ("duplicate_line_share", "max", 0.5),
    ("repeated_word_share", "max", 0.5),
)


#: What the table may speak about: a count below, or the ratio of two.
MEASURES: dict[str, tuple[str, str | None]] = {
    "n_words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "exclamations_per_word": ("n_exclamations", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
}


def _measure(name: str) -> Column:
    """The measure as a number; nothing of nothing is 0."""
    part, whole = MEASURES[name]
    value = F.col(part).cast("double")
    if whole is None:
        return value
    return F.when(F.col(whole) > 0, value / F.col(whole)).otherwise(F.lit(0.0))


def verdict(rules: tuple[tuple[str, str, float], ...] = RULES) -> Column:
    """The table as one boolean expression."""
    return reduce(
        and_,
        [
            _measure(name) >= limit if bound == "min" else _measure(name) <= limit
            for name, bound, limit in rules
        ],
        F.lit(True),
    )


def _same_window(x: Column, y: Column) -> Column:
    equal = (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    return F.coalesce(equal, F.lit(False))


def _sorted_windows() -> Column:
    """All windows of three words with their position, equal windows side by side.

    The hash only makes comparing cheap; the words themselves decide.
    """
    w = F.col("words")

    def window(i: Column) -> Column:
        a, b, c = F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)
        return F.struct(
            F.xxhash64(a, b, c).alias("h"), a.alias("a"), b.alias("b"), c.alias("c"), i.alias("i")
        )

    last = F.size(w) - 3
    return F.when(
        last >= 0, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window))
    )


def _repeat_words() -> Column:
    """How many words lie in a window that occurs twice or more."""
    s = F.col("windows")
    starts = F.transform(
        F.filter(
            s, lambda x, i: _same_window(x, F.get(s, i + 1)) | _same_window(x, F.get(s, i - 1))
        ),
        lambda x: x["i"],
    )
    return F.transform(
        F.array(starts),
        lambda p: F.size(
            F.array_distinct(
                F.concat(p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2))
            )
        ),
    )[0]


def quality_rules(
    docs: DataFrame, rules: tuple[tuple[str, str, float], ...] = RULES
) -> DataFrame:
    """Counts and verdict for every document.

    Takes `doc_id` and `text`; other columns, whatever their names, take no part.
    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed and kept (boolean), then the further counts of the table.

    A null text has no words and counts as empty; such documents, and all of fewer
    than 50 words, have base_failed true and kept false. Repeated rows give
    repeated results, an empty table an empty one. Windows of a text that holds
    fewer than three words: none.
    """
    text = text_of()
    # F.filter keeps lines that have a word.
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    measured = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        words_of(F.col("text")).alias("words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).alias("n_exclamations"),
        lines.alias("lines"),
    )
    counted = measured.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.col("n_exclamations").cast("long").alias("n_exclamations"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        _sorted_windows().alias("windows"),
    )
    ready = counted.withColumn(
        "n_repeat_words", F.coalesce(_repeat_words(), F.lit(0)).cast("long")
    ).drop("windows")
    base_failed = (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    return ready.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & verdict(rules)).alias("kept"),
        "n_lines",
        "n_exclamations",
        "n_stop_words",
    )
