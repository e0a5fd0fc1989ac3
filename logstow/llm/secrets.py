"""Secret scan: fixed patterns, and grammars inferred from what they find.

Credentials found by the patterns are labelled strings. From those of a kind, a
prefix tree is built and states whose next symbols are statistically alike are
merged, until a small probabilistic automaton is left; others are inferred from
ordinary words and numbers. Every token of every document that is long enough for a
credential is then scored: by how many bits its best format is likelier than a word.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.llm.tables import least_of_each, slices, text_of

# Kinds in the order of the digest, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
GRAMMAR = "grammar"
#: Whole tokens of the least length that any kind allows.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_LEAST)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{4,}")
#: What is learned from tokens outside credentials, by their form; words are all others.
#: Rare forms are kinds of their own, as a sample of all tokens has few of them.
FORMS = {
    "number": re.compile(r"[0-9+/_.=-]+"),
    "upper": re.compile(r"[A-Z+/_.=-]+"),
    "joined": re.compile(r"[a-z0-9]+(?:[/_.-][a-z0-9]+)+"),
}
ORDINARY = ("word", *FORMS)
#: Symbols of the automata: classes of characters, with how many each has.
CLASSES = {
    "d": "0123456789",
    "h": "abcdef",
    "l": "ghijklmnopqrstuvwxyz",
    "H": "ABCDEF",
    "U": "GHIJKLMNOPQRSTUVWXYZ",
    **{c: c for c in "+/_.=-"},
}
TO_CLASS = str.maketrans({c: name for name, chars in CLASSES.items() for c in chars})
# Scores that a task remembers, and the longest token it remembers one of.
REMEMBERED = 1 << 16
REMEMBERED_LENGTH = 64
CLASS_BITS = {name: math.log2(len(chars)) for name, chars in CLASSES.items()}


@dataclass(frozen=True)
class Inference:
    """Bounds and levels of learning.

    values: different credentials of a kind, and tokens of a form, that are learned from.
    longest: characters of a value that may be learned from (whole).
    words_from: documents whose words may be learned from, in expectation.
    alpha: a smaller level merges more states.
    bits: by which a credential format must beat ordinary words.
    """

    values: int = 500
    longest: int = 200
    words_from: int = 2000
    alpha: float = 0.05
    bits: float = 16.0


class Automaton:
    """Deterministic automaton with counts of arrivals, ends and transitions."""

    def __init__(self):
        self.arrived: list[int] = [0]
        self.ended: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]

    def add(self, string: str) -> None:
        state = 0
        self.arrived[0] += 1
        for symbol in string:
            target = self.next[state].get(symbol)
            if target is None:
                target = len(self.arrived)
                self.next[state][symbol] = target
                self.arrived.append(0)
                self.ended.append(0)
                self.next.append({})
                self.taken.append({})
            self.taken[state][symbol] = self.taken[state].get(symbol, 0) + 1
            self.arrived[target] += 1
            state = target
        self.ended[state] += 1

    def _alike(self, a: int, b: int, alpha: float) -> bool:
        """Whether frequencies from two states agree within Hoeffding's bound, all the way."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        todo = deque([(a, b)])
        while todo:
            a, b = todo.popleft()
            n, m = self.arrived[a], self.arrived[b]
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for symbol in self.next[a].keys() | self.next[b].keys():
                x, y = self.taken[a].get(symbol, 0), self.taken[b].get(symbol, 0)
                if abs(x / n - y / m) > bound:
                    return False
                if x and y:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the states from a on."""
        todo = deque([(a, b)])
        while todo:
            a, b = todo.popleft()
            self.arrived[a] += self.arrived[b]
            self.ended[a] += self.ended[b]
            for symbol, target in self.next[b].items():
                self.taken[a][symbol] = self.taken[a].get(symbol, 0) + self.taken[b][symbol]
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], target))
                else:
                    self.next[a][symbol] = target

    def merged(self, alpha: float) -> Automaton:
        """Merge compatible states, nearest to the root first."""
        red = [0]
        waiting = deque((0, s) for s in sorted(self.next[0]))
        while waiting:
            source, symbol = waiting.popleft()
            blue = self.next[source][symbol]
            if blue in red:
                continue
            for state in red:
                if self._alike(state, blue, alpha):
                    self.next[source][symbol] = state
                    self._fold(state, blue)
                    # Folding can give red states new ways on.
                    queued = set(waiting)
                    waiting.extend(
                        (r, s)
                        for r in red
                        for s in sorted(self.next[r])
                        if self.next[r][s] not in red and (r, s) not in queued
                    )
                    break
            else:
                red.append(blue)
                waiting.extend((blue, s) for s in sorted(self.next[blue]))
        return self._only(red)

    def _only(self, states: list[int]) -> Automaton:
        number = {s: i for i, s in enumerate(states)}
        out = Automaton()
        out.arrived = [self.arrived[s] for s in states]
        out.ended = [self.ended[s] for s in states]
        out.next = [{c: number[t] for c, t in self.next[s].items()} for s in states]
        out.taken = [dict(self.taken[s]) for s in states]
        return out

    def bits(self, classes: str) -> float:
        """log2 likelihood of a string; symbols never seen in a state keep to it."""
        state, total = 0, 0.0
        for symbol in classes:
            n = self.arrived[state] + 0.5 * (len(CLASSES) + 1)
            seen = self.taken[state].get(symbol, 0)
            total += math.log2((seen + 0.5) / n) - CLASS_BITS[symbol]
            state = self.next[state].get(symbol, state)
        n = self.arrived[state] + 0.5 * (len(CLASSES) + 1)
        return total + math.log2((self.ended[state] + 0.5) / n)


    def walk(self) -> dict:
        """The start state, for `bits_along`: what each symbol costs and where it leads,
        and under the empty symbol what it costs to end."""
        states: list[dict] = [{} for _ in self.arrived]
        for i, state in enumerate(states):
            n = self.arrived[i] + 0.5 * (len(CLASSES) + 1)
            for symbol, width in CLASS_BITS.items():
                cost = math.log2((self.taken[i].get(symbol, 0) + 0.5) / n) - width
                state[symbol] = (cost, states[self.next[i].get(symbol, i)])
            state[""] = math.log2((self.ended[i] + 0.5) / n)
        return states[0]


def bits_along(state: dict, classes: str) -> float:
    """`Automaton.bits`, with every logarithm taken beforehand."""
    total = 0.0
    for symbol in classes:
        cost, state = state[symbol]
        total += cost
    return total + state[""]


def infer(strings: Iterable[str], alpha: float) -> Automaton:
    tree = Automaton()
    for s in sorted(set(strings)):
        tree.add(s.translate(TO_CLASS))
    return tree.merged(alpha) if tree.arrived[0] else tree


@dataclass(frozen=True)
class Grammars:
    """Automata of the credential kinds that had strings, and of ordinary tokens."""

    formats: dict[str, Automaton]
    ordinary: dict[str, Automaton]

    def score(self, token: str) -> float:
        """Bits by which the best format beats the best ordinary token.

        Minus infinity without formats; an even choice of characters stands for
        ordinary tokens where there are none.
        """
        classes = token.translate(TO_CLASS)
        even = -math.log2(sum(map(len, CLASSES.values()))) * len(token)
        best = max((a.bits(classes) for a in self.formats.values()), default=-math.inf)
        return best - max((a.bits(classes) for a in self.ordinary.values()), default=even)


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, credential) by start and kind; leftmost per kind."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= ASSIGN_LEAST:
                found.append((m.start(), m.end(), 0, m.group(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append((m.start(), m.end(), 1, m.group()))
    for m in HEX.finditer(text):
        found.append((m.start(), m.end(), 2, m.group()))
    return sorted(found)


def _apart(text: str, spans: list[tuple], pattern: re.Pattern) -> Iterator[re.Match]:
    """Matches that overlap no span; both come by start."""
    ends, at = -1, 0
    for m in pattern.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            ends = max(ends, spans[at][1])
            at += 1
        if ends <= m.start():
            yield m


def form_of(token: str) -> str:
    """Which of ORDINARY a token is."""
    return next((name for name, form in FORMS.items() if form.fullmatch(token)), "word")


def learn_grammars(docs: DataFrame, how: Inference = Inference()) -> Grammars:
    """Automata from the corpus' own pattern matches and words.

    All documents are searched; of what is found, the values of least hash are
    learned from, so copies count once. At most `values` strings a kind come to
    the driver.
    """
    n = docs.count()
    share = int((1 << 20) * min(1.0, how.words_from / max(n, 1)))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share
    names = (*KINDS, *ORDINARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen = set()
            for text, words in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                spans = base_matches(text)
                seen.update((names[s[2]], s[3]) for s in spans if len(s[3]) <= how.longest)
                if words.as_py():
                    own = {m.group() for m in _apart(text, spans, TOKEN)}
                    seen.update((form_of(w), w) for w in own if len(w) <= how.longest)
            seen = sorted(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in seen], pa.string()) for i in (0, 1)],
                names=["kind", "value"],
            )

    values = (
        docs.select(text_of(), F.coalesce(picked, F.lit(False)))
        .mapInArrow(run, "kind string, value string")
        .distinct()
    )
    hashed = values.withColumn("order", F.xxhash64("value"))
    rows = least_of_each(hashed, "kind", ["order", "value"], how.values).collect()
    by_kind = {k: [r["value"] for r in rows if r["kind"] == k] for k in names}
    formats = {k: infer(by_kind[k], how.alpha) for k in KINDS if by_kind[k]}
    ordinary = {k: infer(by_kind[k], how.alpha) for k in ORDINARY if by_kind[k]}
    return Grammars(formats, ordinary)


def remembering(grammars: Grammars) -> Callable[[str], float]:
    """The score, kept for the short tokens seen last: words of running text repeat, and
    still more so do their classes, which are all that a score depends on."""
    formats = [a.walk() for a in grammars.formats.values()]
    ordinary = [a.walk() for a in grammars.ordinary.values()]
    even = -math.log2(sum(map(len, CLASSES.values())))

    def of_classes(classes: str) -> float:
        best = max((bits_along(a, classes) for a in formats), default=-math.inf)
        return best - max((bits_along(a, classes) for a in ordinary), default=even * len(classes))

    kept = lru_cache(REMEMBERED)(of_classes)
    short = lru_cache(REMEMBERED)(lambda token: kept(token.translate(TO_CLASS)))

    def score(token: str) -> float:
        if len(token) <= REMEMBERED_LENGTH:
            return short(token)
        return of_classes(token.translate(TO_CLASS))

    return score


def find_secrets(
    text: str, score_of: Callable[[str], float], bits: float
) -> tuple[list[tuple], float]:
    """All spans (start, end, kind), by start and kind, and the best score of any token."""
    base = base_matches(text)
    spans = [(s, e, k) for s, e, k, _ in base]
    best = max((score_of(value) for *_, value in base), default=0.0)
    for m in _apart(text, base, CANDIDATE):
        score = score_of(m.group())
        best = max(best, score)
        if score >= bits:
            spans.append((m.start(), m.end(), len(KINDS)))
    return sorted(spans, key=lambda s: (s[0], s[2])), best


def secret_scan(docs: DataFrame, how: Inference = Inference()) -> DataFrame:
    """Secrets of every document.

    Takes doc_id and text. Returns doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_grammar and best_score. Spans are kind:start:end in code points, by
    start and kind. Null and empty texts have none, and so do texts without tokens of
    six characters; without any credential in the corpus no grammar is learned and only
    the patterns count. Repeated rows give repeated results, an empty table an
    empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn_grammars(docs, how))
    names = (*KINDS, GRAMMAR)

    def listed(spans: Iterable[tuple]) -> str:
        return ",".join(f"{names[k]}:{s}:{e}" for s, e, k in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = remembering(shared.value)
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in names]
            digests, lists, scores = [], [], []
            for text in batch.column(1):
                spans, best = find_secrets(text.as_py(), score_of, how.bits)
                for k, out in enumerate(counts):
                    out.append(sum(s[2] == k for s in spans))
                base = listed(s for s in spans if s[2] < len(KINDS))
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                lists.append(listed(spans))
                scores.append(max(best, -1e9))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(c, pa.int64()) for c in counts[:3]]
                + [pa.array(digests, pa.string()), pa.array(lists, pa.string())]
                + [pa.array(counts[3], pa.int64()), pa.array(scores, pa.float64())],
                names=[
                    "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                    "n_grammar", "best_score",
                ],
            )

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string,"
        " spans string, n_grammar long, best_score double",
    )
