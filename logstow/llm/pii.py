"""Personal data: patterns, and terms that give a protected entity away.

Patterns find the entities. Texts are cut into pieces, lines or parts of long ones,
and the context of an entity is its piece with the neighbours on both sides. With N
pieces in the corpus, n(e) that hold entity e, n(t) that hold term t, and n(e, t)
contexts of e that hold t, d(e, t) of them different, e carries log(N / n(e)) and t
tells log(p N / n(e)) of it, where p = n(e, t) / n(t) * d(e, t) / (d(e, t) + 1)
estimates how likely e is where t is. The last factor is for rarity: one context,
however often it is copied, counts as half. Every entity and term takes part. A term
that tells more than a set share of what an entity carries is generalised or removed
wherever it stands. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstow.llm.tables import text_of, written

# Kinds in the order of the digest. Possessive repeats and the looks
# behind keep matching linear; they match what the plain patterns
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)        each part at most 255
#   [0-9]([\x20-]?[0-9])+                       16 to 19 digits, Luhn
#   \+[0-9][\x20().0-9-]+[0-9]                  8 to 15 digits
# match, leftmost and without overlap, but for card runs of fewer than 16 digits.
PATTERNS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that every text with a match passes.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
KINDS = tuple(PATTERNS)
TERM_KIND = "term"
#: Words of three or more letters or digits; of scripts without letter case, any length.
TERM = r"[\p{L}\p{N}]{3,}|\p{Lo}+"
#: Rows and terms up to this number (about 40 MB) are broadcast, more are joined by shuffle.
BROADCAST_TERMS = 500_000

SPAN = "struct<no:int,kind:string,start:int,stop:int,value:string>"


@dataclass(frozen=True)
class Disclosure:
    """When a term gives an entity away.

    share: of the entity's information that a term may tell.
    piece: characters of a piece; longer lines are cut, at spaces where they have any,
        so that the terms and entities of a context stay few.
    """

    share: float = 0.9
    piece: int = 500


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _add(a: Column, b: Column) -> Column:
    return a + b


def _running(numbers: Column, step) -> Column:
    """Running sums or maxima (step) of numbers from 0 on.

    Blocks of about the root of their number are folded, then shifted by the fold
    of those before, so that arrays grown number by number stay short.
    """

    def fold(block: Column) -> Column:
        def more(done: Column, x: Column) -> Column:
            last = F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))
            return F.concat(done, F.array(step(last, x)))

        return F.aggregate(block, F.array().cast("array<int>"), more)

    def shifted(inner: Column, heads: Column) -> Column:
        def one(block: Column, k: Column) -> Column:
            return _let(
                F.coalesce(F.get(heads, k - 1), F.lit(0)),
                lambda head: F.transform(block, lambda x: step(x, head)),
            )

        return F.flatten(F.transform(inner, one))

    def run(all_: Column) -> Column:
        width = _block(all_)
        firsts = F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), width)
        folded = F.transform(firsts, lambda at: fold(F.slice(all_, at + 1, width)))
        return _let(
            folded,
            lambda inner: _let(
                fold(F.transform(inner, lambda x: F.get(x, F.size(x) - 1))),
                lambda heads: shifted(inner, heads),
            ),
        )

    return _let(numbers, run)


def _block(items: Column) -> Column:
    return F.greatest(F.ceil(F.sqrt(F.size(items))).cast("int"), F.lit(1))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: every second digit from the right is doubled."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * (1 + i % 2)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    positions = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(positions, F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Long parts are compared as text without their zeros.
        return F.forall(
            F.split(value, r"\."),
            lambda p: _let(
                F.regexp_replace(p, "^0+", ""),
                lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255")),
            ),
        )
    n = F.length(_digits(value))
    if kind == "phone":
        return n.between(8, 15)
    return n.between(16, 19) & _luhn(_digits(value))


def _holding(kind: str):
    return lambda span: _holds(kind, span["value"])


def _all_matches(text: Column, pattern: Column, no: int, kind: str) -> Column:
    """Matches of a pattern as spans in code points, end exclusive.

    What lies between the matches, and they themselves, add up to the positions.
    """

    def span(value: Column, stop: Column) -> Column:
        return F.struct(
            F.lit(no).alias("no"),
            F.lit(kind).alias("kind"),
            (stop - F.length(value)).alias("start"),
            stop.alias("stop"),
            value.alias("value"),
        ).cast(SPAN)

    def spans(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        sizes = F.zip_with(gaps, found, lambda gap, value: F.length(gap) + F.length(value))
        return F.zip_with(found, _running(sizes, _add), span)

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), spans)


def base_spans(text: Column) -> Column:
    """Spans of all four kinds, by kind and then start."""
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        matches = _all_matches(text, F.lit(pattern), no, kind)
        good = F.filter(matches, _holding(kind))
        hint = text.contains("@") if kind == "email" else text.rlike(HINTS[kind])
        parts.append(F.when(hint, good).otherwise(none))
    return F.concat(*parts)


def _entity(span: Column) -> Column:
    """What a span stands for, however it is written."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(
        F.lower(span["value"])
    )
    return F.concat(span["kind"], F.lit(":"), plain)


def _rewritten(text: Column, spans: Column, label) -> Column:
    """The text with label(span, before) in place of its spans, in order of their start.

    `before` is how far the spans in front reach. The text is cut into blocks of about
    the root of the number of spans first, as cutting costs what lies in front.
    """

    def cut(all_: Column, reach: Column) -> Column:
        width = _block(all_)

        def before(i: Column) -> Column:
            return F.coalesce(F.get(reach, i - 1), F.lit(0))

        def block(first: Column) -> Column:
            begin, last = before(first), F.least(first + width, F.size(all_))
            part = F.substring(text, begin + 1, before(last) - begin)

            def piece(rest: Column, head: Column) -> Column:
                def one(s: Column, j: Column) -> Column:
                    return _let(
                        before(first + j),
                        lambda b: F.concat(
                            F.substring(rest, b - head + 1, F.greatest(s["start"] - b, F.lit(0))),
                            label(s, b),
                        ),
                    )

                return F.array_join(F.transform(F.slice(all_, first + 1, width), one), "")

            return _let(part, lambda rest: _let(begin, lambda head: piece(rest, head)))

        firsts = F.sequence(F.lit(0), F.size(all_) - 1, width)
        return F.concat(
            F.array_join(F.transform(firsts, block), ""),
            F.substring(text, before(F.size(all_)) + 1, F.length(text)),
        )

    ordered = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["no"].alias("no"), s["stop"].alias("stop"),
                s["kind"].alias("kind"), s["value"].alias("value"),
            ),
        )
    )
    whole = _let(
        ordered,
        lambda all_: _let(
            _running(F.transform(all_, lambda s: s["stop"]), F.greatest),
            lambda reach: cut(all_, reach),
        ),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _masked(text: Column, spans: Column) -> Column:
    """The text with a space for every character of its spans."""

    def blank(s: Column, before: Column) -> Column:
        return F.repeat(F.lit(" "), F.greatest(s["stop"], before) - F.greatest(s["start"], before))

    return _rewritten(text, spans, blank)


def _words(text: Column) -> Column:
    """Different terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _terms(piece: Column) -> Column:
    """Different terms of a piece outside all matches, failing ones included."""
    rest = piece
    for pattern in PATTERNS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    return _words(rest)


def _pieces(text: Column, size: int) -> Column:
    """Lines that are not empty; those longer than `size` are cut, at spaces if possible."""
    pattern = rf"[^\n]{{1,{size}}}(?![^\x20\n])|[^\n]{{1,{size}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _contexts(text: Column, size: int) -> Column:
    """(piece, context) for the pieces that may hold an entity."""

    def of(pieces: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(pieces) - 1, F.lit(0)))
        hinted = F.filter(
            places, lambda i: F.get(pieces, i).rlike(r"[@+]|[0-9][\x20.-]?[0-9]")
        )
        return F.transform(
            hinted,
            lambda i: F.struct(
                F.get(pieces, i).alias("piece"),
                F.concat_ws(
                    "\n", F.get(pieces, i - 1), F.get(pieces, i), F.get(pieces, i + 1)
                ).alias("context"),
            ),
        )

    return _let(_pieces(text, size), of)


def disclosing_terms(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The terms that disclose an entity, one row (term) each.

    The corpus is read three times: for contexts of entities, to number the pieces,
    and to count the terms of all pieces, pre-aggregated in every task. Copies of a
    context are one weighted row before its terms are paired with its entities.
    """
    texts = docs.select(text_of().alias("text"))
    pieces = texts.select(F.explode(_pieces(F.col("text"), rule.piece)).alias("piece"))
    n = float(max(pieces.count(), 1))
    meeting = written(
        texts.select(F.explode(_contexts(F.col("text"), rule.piece)).alias("c"))
        .select(
            "c.context",
            F.explode(
                F.array_distinct(F.transform(base_spans(F.col("c.piece")), _entity))
            ).alias("entity"),
        )
        .groupBy("context", "entity")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("context")
        .agg(F.collect_list(F.struct("entity", "n")).alias("entities"))
        .select(F.explode("entities").alias("e"), _terms(F.col("context")).alias("terms"))
        .select("e.entity", "e.n", "terms"),
        "pii-contexts",
    )
    entities = (
        meeting.groupBy("entity")
        .agg(F.sum("n").alias("n_e"))
        # What an estimate must pass to tell the share: p N / n(e) > (N / n(e)) ** share.
        .withColumn("least", F.pow(F.col("n_e") / F.lit(n), F.lit(1.0 - rule.share)))
    )
    pairs = written(
        meeting.select("entity", "n", F.explode("terms").alias("term"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("d_et"))
        .withColumn("sure", F.col("d_et") / (F.col("d_et") + 1))
        .join(entities, "entity")
        .filter((F.col("n_e") < n) & (F.col("sure") > F.col("least"))),
        "pii-candidates",
    )
    counted = written(
        # Counted first: what is joined is a row for each term, not for each occurrence.
        pieces.select(F.explode(_terms(F.col("piece"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_t"))
        .join(pairs.select("term").distinct(), "term", "left_semi"),
        "pii-terms",
    )
    # A term may stand in more contexts than pieces, as contexts overlap.
    chance = F.least(F.col("n_et") / F.col("n_t"), F.lit(1.0)) * F.col("sure")
    return pairs.join(counted, "term").filter(chance > F.col("least")).select("term").distinct()


def flagged_terms(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Rows (doc_id, text_hash, terms): disclosing terms of the documents that hold any."""
    flagged = written(disclosing_terms(docs, rule), "pii-flagged")
    if flagged.count() <= BROADCAST_TERMS:
        flagged = F.broadcast(flagged)
    text = text_of()
    return (
        docs.select(
            "doc_id",
            F.xxhash64(text).alias("text_hash"),
            F.explode(_words(_masked(text, base_spans(text)))).alias("term"),
        )
        .join(flagged, "term", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))
    )


def find_personal_data(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """All columns of the documents, and pii_base and pii_spans after them.

    pii_base has the spans of the patterns by kind and start; pii_spans those and
    the terms that disclose, wherever they stand outside the former. Spans are
    (no, kind, start, stop, value) in code points. Takes doc_id and text; columns of
    these two names are replaced. Terms belong to the very text they were found in, so
    documents that share an id do not mix. A null text counts as empty and has no span.
    """
    terms = written(flagged_terms(docs, rule), "pii-documents").select(
        F.col("doc_id").alias("_pii_id"), F.col("text_hash").alias("_pii_hash"), F.col("terms").alias("_pii_terms")
    )
    held = terms.agg(F.coalesce(F.sum(F.size("_pii_terms") + 1), F.lit(0))).first()[0]
    if held <= BROADCAST_TERMS:
        # The texts stay where they are.
        terms = F.broadcast(terms)
    kept = docs.drop("pii_base", "pii_spans")
    text = text_of()
    same = kept["doc_id"].eqNullSafe(terms["_pii_id"]) & (F.xxhash64(text) == terms["_pii_hash"])
    pattern = F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("_pii_terms", "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    none = F.array().cast(f"array<{SPAN}>")
    term_spans = _all_matches(
        _masked(text, F.col("pii_base")), pattern, len(KINDS), TERM_KIND
    )
    return (
        kept.join(terms, same, "left")
        .withColumn("pii_base", base_spans(text))
        .withColumn(
            "pii_spans",
            F.concat(
                "pii_base", F.when(F.col("_pii_terms").isNotNull(), term_spans).otherwise(none)
            ),
        )
        .drop("_pii_id", "_pii_hash", "_pii_terms")
    )


def _label(span: Column) -> Column:
    """Entities give way to their kind, numbers to a sign for them, words to nothing."""
    return (
        F.when(span["kind"] != TERM_KIND, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        .when(span["value"].rlike("^[0-9]+$"), F.lit("[NUMBER]"))
        .otherwise(F.lit(""))
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans hidden; of overlapping ones the first names them all."""
    return _rewritten(
        text, spans, lambda s, before: F.when(s["start"] >= before, _label(s)).otherwise(F.lit(""))
    )


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The same documents and columns with personal data hidden in `text`.

    Texts without any are left as they are, null included. `n_chars`, where there
    is such a column, follows the texts that change.
    """
    found = find_personal_data(docs, rule)
    changed = F.size("pii_spans") > 0
    columns = [
        F.when(changed, redacted(F.col("text"), F.col("pii_spans"))).otherwise(F.col("text")).alias("text")
        if c == "text"
        else F.col(c)
        for c in docs.columns
    ]
    out = found.select(*columns, changed.alias("_pii_changed"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars",
            F.when(F.col("_pii_changed"), F.length("text").cast(kind)).otherwise(F.col("n_chars")),
        )
    return out.drop("_pii_changed")


def pii(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Counts and digests of the spans of every document.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.
    Repeated rows give repeated results, an empty table an empty one; a text
    without spans has the digest of the empty string.
    """

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
            ),
            ",",
        )

    def count(kind: str) -> Column:
        return (
            F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        )

    found = find_personal_data(docs.select("doc_id", "text"), rule)
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"),
        listed(F.col("pii_spans")).alias("spans"),
        count(TERM_KIND),
    )
