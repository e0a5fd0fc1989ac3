"""Mixing by iterative proportional fitting.

Documents fall into cells of source, language and topic. Each marginal value has a
target share of tokens; the cells' factors are raked to one marginal after the
other until all targets are met, or none can come closer with probabilities of at
most one. A document is then drawn with its cell's probability.
"""

from __future__ import annotations

import logging
import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from logstow.llm.tables import text_of, written

MARGINALS = ("source", "lang", "topic")
TOPICS = 8
LOG = logging.getLogger(__name__)
#: Stands for a null source or language.
MISSING = "\0"


@dataclass(frozen=True)
class Mix:
    """What to aim at.

    source, lang, topic: exponents; a value's target is its share of the tokens to
        this power, brought to a sum of one. One keeps a marginal as it is, zero
        makes its values equal.
    share: of all tokens that the sample has in expectation. A value with fewer
        tokens than its target is kept whole, cells stop at a probability of one, and
        the others are raked to the rest. None: the most at which no probability
        exceeds one, which the rarest cell decides.
    tolerance: largest relative distance from a target at which raking ends.
    sweeps: after so many, raking ends in any case.
    """

    source: float = 0.9
    lang: float = 0.9
    topic: float = 0.9
    share: float | None = 0.5
    tolerance: float = 1e-3
    sweeps: int = 30
    seed: int = 1


@F.pandas_udf(StructType().add("tokens", LongType()).add("topic", IntegerType()))
def _described(texts: pd.Series) -> pd.DataFrame:
    """Words of a text, and the group of words it uses most.

    Words of five letters or more fall into TOPICS groups by hash; the group with
    most uses is the topic, ties to the lower number, and 0 without such words.
    """
    tokens, topics = [], []
    for text in texts:
        counts = Counter(text.lower().split())
        groups = [0] * TOPICS
        for word, n in counts.items():
            if len(word) > 4:
                groups[zlib.crc32(word.encode("utf-8", "replace")) % TOPICS] += n
        tokens.append(sum(counts.values()))
        topics.append(groups.index(max(groups)))
    return pd.DataFrame({"tokens": tokens, "topic": topics})


def _cell() -> list[Column]:
    return [
        F.coalesce(F.col("source").cast("string"), F.lit(MISSING)).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(MISSING)).alias("_lang"),
        F.col("_described.topic").alias("_topic"),
        F.col("_described.tokens").alias("_tokens"),
    ]


def _targets(cells: DataFrame, marginal: str, power: float) -> DataFrame:
    """Target tokens of every value: the marginal's tempered shares of all tokens."""
    sums = cells.groupBy(marginal).agg(F.sum("tokens").alias("own"))
    # A value without a token keeps none, whatever the exponent.
    tempered = F.when(F.col("own") > 0, F.pow(F.col("own").cast("double"), F.lit(power)))
    sums = sums.withColumn("tempered", F.coalesce(tempered, F.lit(0.0)))
    whole, tempered = sums.agg(F.sum("own"), F.sum("tempered")).first()
    scale = (whole or 0) / tempered if tempered else 0.0
    return sums.select(marginal, "own", (F.col("tempered") * F.lit(float(scale))).alias("target"))


def _within(targets: DataFrame, share: float) -> DataFrame:
    """Targets for a sample of this share of all tokens, none above a value's own.

    A value whose target is more than all its tokens keeps them all; what it lacks is
    dealt to the others in proportion to their targets.
    """
    scale, full = share, -1
    while True:
        over = F.col("target") * F.lit(scale) >= F.col("own")
        row = targets.agg(
            F.sum("own").alias("whole"),
            F.count(F.when(over, 1)).alias("full"),
            F.sum(F.when(over, F.col("own"))).alias("kept"),
            F.sum(F.when(~over, F.col("target"))).alias("rest"),
        ).first()
        if row["full"] == full or not row["rest"]:
            break
        full = row["full"]
        scale = max(scale, (share * row["whole"] - (row["kept"] or 0)) / row["rest"])
    least = F.least(F.col("own").cast("double"), F.col("target") * F.lit(float(scale)))
    return targets.withColumn("target", least)


def _swept(
    cells: DataFrame, targets: dict[str, DataFrame], mix: Mix, start: float, most: float
) -> DataFrame:
    """Factors by raking, from `start` on and none above `most`.

    Cells at `most` stay there while their value is short of its target, and the
    others of the value are raked to what is left of it.
    """
    current, off = cells.withColumn("factor", F.lit(start)), 0.0
    full = F.col("factor") >= most
    amount = F.col("tokens") * F.col("factor")
    for _ in range(mix.sweeps):
        swept = current.withColumn("off", F.lit(0.0))
        for m in MARGINALS:
            sums = swept.groupBy(m).agg(
                F.sum(amount).alias("now"), F.sum(F.when(full, amount).otherwise(0.0)).alias("held")
            )
            short = F.col("target") > F.col("now")
            free = F.col("now") - F.col("held")
            ratio = sums.join(targets[m], m).select(
                m,
                F.when(~short & (F.col("now") > 0), F.col("target") / F.col("now"))
                .when(short & (free > 0), (F.col("target") - F.col("held")) / free)
                .alias("ratio"),
                F.when(F.col("now") > 0, F.abs(F.col("target") / F.col("now") - 1)).alias("away"),
            )
            by = F.coalesce("ratio", F.lit(1.0))
            swept = swept.join(ratio, m).select(
                *MARGINALS, "tokens", F.least(F.lit(most), F.col("factor") * by).alias("factor"),
                F.greatest("off", F.coalesce("away", F.lit(0.0))).alias("off"),
            )
        swept = written(swept, "mix-sweep")
        current = swept.drop("off")
        off = swept.agg(F.max("off")).first()[0] or 0.0
        if off <= mix.tolerance:
            return current
    LOG.warning("raking ended after %d sweeps, up to %.3g off its targets", mix.sweeps, off)
    return current


def _all_targets(cells: DataFrame, mix: Mix) -> dict[str, DataFrame]:
    return {m: written(_targets(cells, m, getattr(mix, m)), f"mix-{m}") for m in MARGINALS}


def rake(cells: DataFrame, mix: Mix) -> DataFrame:
    """Cells (source, lang, topic, tokens) with their factor, which may exceed one.

    Every sweep is a written table. Only the largest distance from a target comes
    to the driver. Cells and marginals are tables, so sources may be many.
    """
    return _swept(cells, _all_targets(cells, mix), mix, 1.0, math.inf)


def _probabilities(cells: DataFrame, mix: Mix) -> DataFrame:
    """Cells with their probability as `factor`."""
    if mix.share is None:
        raked = rake(cells, mix)
        most = raked.filter("tokens > 0").agg(F.max("factor")).first()[0]
        rate = 1 / most if most else 1.0
    else:
        targets = _all_targets(cells, mix)
        for m in MARGINALS:
            targets[m] = written(_within(targets[m], mix.share), f"mix-{m}-within")
        raked = _swept(cells, targets, mix, min(1.0, float(mix.share)), 1.0)
        rate = _rate(raked, mix.share)
    return raked.withColumn("factor", F.least(F.lit(1.0), F.col("factor") * rate))


def _rate(cells: DataFrame, share: float) -> float:
    """What probabilities are multiplied by, and cut to one, to give the share."""
    share = min(share, 1 - 1e-9)

    def sampled(rate: float) -> float:
        kept = F.least(F.lit(1.0), F.col("factor") * rate) * F.col("tokens")
        return cells.agg(F.sum(kept) / F.sum("tokens")).first()[0] or 0.0

    now = sampled(1.0)
    if now == 0 or abs(now - share) <= 1e-4 * share:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        if sampled(high) >= share or high > 1e12:
            break
        low, high = high, 2 * high
    for _ in range(20):
        middle = (low + high) / 2
        low, high = (middle, high) if sampled(middle) < share else (low, middle)
    return high


def distances(cells: DataFrame, mix: Mix) -> DataFrame:
    """Rows (marginal, value, tokens, target, expected, off) of cells (source, lang,
    topic, tokens): what a sample of the mix aims at and what it gets in expectation.

    The target is the value's tempered share of the sample's tokens; `off` is the
    relative distance from it, null for a value without tokens.
    """
    got = written(_probabilities(cells, mix), "mix-distances")
    expected = F.sum(F.col("tokens") * F.col("factor"))
    whole, kept = got.agg(F.sum("tokens"), expected).first()
    size = F.lit(float(kept / whole) if whole else 0.0)
    parts = []
    for m in MARGINALS:
        sums = got.groupBy(m).agg(expected.alias("expected"))
        parts.append(
            _targets(cells, m, getattr(mix, m)).join(sums, m).select(
                F.lit(m).alias("marginal"),
                F.col(m).cast("string").alias("value"),
                F.col("own").alias("tokens"),
                (F.col("target") * size).alias("target"),
                "expected",
            )
        )
    off = F.when(F.col("target") > 0, F.col("expected") / F.col("target") - 1)
    return reduce(DataFrame.unionByName, parts).withColumn("off", off)


def draw(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """All columns of the documents, then mix_tokens, mix_topic, mix_probability
    and mix_sampled, which replace columns of these names.

    Takes doc_id, text, source and lang. A document's draw is a hash of its id and
    text, so it is the same in every run, and for repeated rows. Null sources and
    languages are values of their own; null texts count as empty. Documents
    without a word have their cell's probability. An empty table gives an empty
    result.
    """
    added = ["mix_tokens", "mix_topic", "mix_probability", "mix_sampled"]
    kept = docs.drop(*added)
    described = kept.select("*", _described(text_of()).alias("_described")).select(
        *(F.col(f"`{c}`") for c in kept.columns), *_cell()
    )
    cells = written(
        described.groupBy("_source", "_lang", "_topic")
        .agg(F.sum("_tokens").alias("tokens"))
        .select(
            F.col("_source").alias("source"), F.col("_lang").alias("lang"),
            F.col("_topic").alias("topic"), "tokens",
        ),
        "mix-cells",
    )
    probabilities = _probabilities(cells, mix).select(
        *(F.col(m).alias(f"_{m}") for m in MARGINALS), F.col("factor").alias("mix_probability")
    )
    uniform = F.shiftrightunsigned(
        F.xxhash64(F.lit(mix.seed), "doc_id", text_of()), 11
    ) * F.lit(2.0**-53)
    same = reduce(
        lambda a, b: a & b, [described[f"_{m}"] == probabilities[f"_{m}"] for m in MARGINALS]
    )
    return described.join(probabilities, same).select(
        *(F.col(f"`{c}`") for c in kept.columns),
        F.col("_tokens").alias("mix_tokens"),
        described["_topic"].alias("mix_topic"),
        "mix_probability",
        (uniform < F.col("mix_probability")).alias("mix_sampled"),
    )


def sample(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents drawn, with their own columns."""
    return draw(docs, mix).filter("mix_sampled").select(*(F.col(f"`{c}`") for c in docs.columns))


def mixing(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and sampled of every document."""
    slim = docs.select("doc_id", "text", "source", "lang")
    return draw(slim, mix).select(
        "doc_id",
        "source",
        "lang",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_sampled").alias("sampled"),
    )
