"""SentencePiece encoding and decoding with byte spans of the original text.

The model file is read here: pieces, scores and the compiled character map. A
text is normalised by longest prefixes of that map, noting for every normalised
byte the original byte it comes from; the merges of byte pair encoding run on
the normalised text, and every piece is projected back to original bytes.

No piece continues past a space, or from other characters to certain marks, so
merging works on stretches between such places, and the same stretch always gives
the same pieces. Each worker keeps those it has seen, in two generations of
bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from logstow.llm.tables import slices, text_of

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
REPLACEMENT = "�".encode()
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Stretches remembered by each of the two generations of a task's memory.
REMEMBERED = 70_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class CharacterMap:
    """Compiled character map: a double-array trie and its replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4 if blob else 0)
        self.units = self.units.tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest prefix at a position, and that prefix's length."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._child_base(units[0])
        for n in range(at, len(data)):
            node ^= data[n]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[n]:
                break
            node ^= self._child_base(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, n + 1 - at)
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]

    @staticmethod
    def _child_base(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)


def _char_length(data: bytes, at: int) -> int:
    """Bytes of the UTF-8 character at a position; 0 if it is not valid."""
    lead = data[at]
    n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    try:
        data[at : at + n].decode("utf-8")
    except UnicodeDecodeError:
        return 0
    return n


class Codec:
    """A BPE model with byte fallback; encodes with spans, and decodes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.pieces: list[str] = []
        self.types: list[int] = []
        scores: list[float] = []
        trainer: dict = {}
        normaliser: dict = {}
        with open(path, "rb") as file:
            model = file.read()
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("only BPE models with byte fallback and leading spaces are served")
        if {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("user-defined and unused pieces are not served")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.trim = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        self.charmap = CharacterMap(normaliser.get(2, b""))
        self.id = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.rank = {p: -scores[i] for p, i in self.id.items()}
        self.byte_id = {
            int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE
        }
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("pieces that go on past a space are not served")
        self.stretch = self._stretches()
        self.remembered = remembered
        # Pieces that stand for their own text: id in decimal, and original bytes if
        # spaces stand for spaces.
        self.plain = {
            p: (str(i), len(p.encode()) - 2 * p.count(SPACE)) for p, i in self.id.items()
        }
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _stretches(self) -> re.Pattern:
        """Stretches across whose borders no piece reaches.

        A mark is ASCII punctuation that no piece holds right after an ASCII letter;
        letters are all but those some piece holds before a mark. So letters that
        end before a mark, a space or the text's end are a stretch, and so are marks
        before a space or the end. A line feed is one if no longer piece has it.
        """
        before: dict[str, set[str]] = {}
        for piece in self.id:
            for a, b in zip(piece, piece[1:], strict=False):
                before.setdefault(b, set()).add(a)
        letters = set(string.ascii_letters)
        marks = [c for c in string.punctuation if not before.get(c, set()) & letters]
        odd = {a for c in marks for a in before.get(c, ()) if re.match(r"[^\W\d_]", a)}
        alone = "" if any("\n" in p and len(p) > 1 for p in self.id) else "\n"
        mark = re.escape("".join(marks))
        letter = rf"[^\W\d_{re.escape(''.join(sorted(odd)))}]"
        parts = [f"{SPACE}*+{letter}++(?=[{SPACE}{alone}{mark}]|\\Z)"] if marks else []
        parts += [f"{SPACE}*+[{mark}]++(?=[{SPACE}{alone}]|\\Z)"] if marks else []
        parts += [alone] if alone else []
        return re.compile("|".join([*parts, f"{SPACE}*+[^{SPACE}{alone}]++", f"{SPACE}++"]))

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """Normalised text, and the original byte at which each of its bytes begins.

        The array has one more element, the end of the text. None stands for the
        simple case in which only spaces change: a normalised space is one original
        byte, a leading one of the model's own none, everything else itself.
        """
        simple = not self.charmap.units and not self.trim and self.escape
        if simple and SPACE not in text:
            if not text:
                return "", None
            return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE), None
        data = text.encode("utf-8", "replace")
        out, source, at = bytearray(), [], 0

        def prefix(position: int) -> tuple[bytes, int]:
            found = self.charmap.longest(data, position)
            if found is not None:
                return found
            n = _char_length(data, position)
            return (data[position : position + n], n) if n else (REPLACEMENT, 1)

        if self.trim:
            while at < len(data) and prefix(at)[0] == b" ":
                at += prefix(at)[1]
        if at == len(data):
            return "", np.zeros(1, dtype=np.int64)
        space = SPACE_BYTES if self.escape else b" "

        def put(piece: bytes, begin: int) -> None:
            out.extend(piece)
            source.extend([begin] * len(piece))

        if self.dummy_prefix:
            put(space, at)
        after_space = self.trim
        while at < len(data):
            piece, used = prefix(at)
            if self.trim and after_space:
                piece = piece.lstrip(b" ")
            if piece:
                for part in re.findall(rb" |[^ ]+", piece):
                    put(space if part == b" " else part, at)
                after_space = self.trim and piece.endswith(b" ")
            at += used
        end = len(data)
        if self.trim:
            while out.endswith(space):
                del out[-len(space) :]
                end = source[len(out)]
                del source[len(out) :]
        return out.decode(), np.array([*source, end], dtype=np.int64)

    def _merge(self, stretch: str) -> list[str]:
        """Symbols left when no neighbours make a piece; best score first, then leftmost."""
        if len(stretch) > 64:
            return self._merge_long(stretch)
        get, none = self.rank.get, float("inf")
        parts = list(stretch)
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, stretch: str) -> list[str]:
        """The same by a queue, which is faster for long stretches."""
        symbols: list[str | None] = list(stretch)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, heap = self.rank, []

        def offer(i: int, j: int) -> None:
            both = symbols[i] + symbols[j]
            if both in rank:
                heapq.heappush(heap, (rank[both], i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if symbols[i] is None or symbols[j] is None or right[i] != j:
                continue
            if symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)
        return [s for s in symbols if s is not None]

    def _learn(self, stretch: str) -> tuple:
        """ids as text, original byte lengths of the pieces if spaces stand for spaces,
        and the decoded text where it is not the stretch itself."""
        symbols = self._merge(stretch)
        entries = [self.plain.get(symbol) for symbol in symbols]
        if None not in entries:
            return ",".join([e[0] for e in entries]), bytes([e[1] for e in entries]), None
        ids, plain = [], []
        for symbol in symbols:
            size = len(symbol.encode())
            spaces = 2 * symbol.count(SPACE)
            known = self.id.get(symbol)
            if known is None:
                # The bytes of an unknown character; all but the last cover nothing.
                ids.extend(self.byte_id[b] for b in symbol.encode())
                plain.extend([0] * (size - 1))
            else:
                ids.append(known)
            plain.append(size - spaces)
        text = self._surface(ids)
        text = None if text == stretch.replace(SPACE, " ") else text
        return ",".join(map(str, ids)), bytes(plain), text

    def _wide(self, stretch: str) -> bytes:
        """Normalised byte lengths of the pieces, spaces being three bytes."""
        lengths = []
        for symbol in self._merge(stretch):
            size = len(symbol.encode())
            lengths += [size] if symbol in self.id else [0] * (size - 1) + [size]
        return bytes(lengths)

    def _surface(self, ids: list[int]) -> str:
        """Text of pieces, without treating the first one specially."""
        out, run = [], bytearray()
        for i in ids:
            kind = self.types[i]
            if kind == BYTE:
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(_replaced(bytes(run)))
                run.clear()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(_replaced(bytes(run)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return self._without_prefix(self._surface(ids))

    def _without_prefix(self, text: str) -> str:
        if self.trim:
            return text.lstrip(" ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def _known(self, stretch: str) -> tuple:
        """Entry of a stretch that the young generation lacks."""
        entry = self.old.get(stretch) or self._learn(stretch)
        if len(self.young) >= self.remembered:
            self.old, self.young = self.young, {}
        if len(stretch) <= 64:
            self.young[stretch] = entry
        return entry

    def encode(self, text: str) -> tuple[str, np.ndarray, np.ndarray, str]:
        """ids joined by commas, first and last original byte (exclusive) per piece,
        and the text that decoding the ids gives."""
        normalised, source = self.normalise(text)
        get, known = self.young.get, self._known
        stretches = self.stretch.findall(normalised)
        rows = [get(s) or known(s) for s in stretches]
        ids = ",".join([r[0] for r in rows])
        if source is None:
            lengths = b"".join([r[1] for r in rows])
        else:
            lengths = b"".join(map(self._wide, stretches))
        ends = np.cumsum(np.frombuffer(lengths, dtype=np.uint8), dtype=np.int64)
        if source is not None:
            begins = source[np.concatenate(([0], ends[:-1]))] if len(ends) else ends
            ends = source[ends] if len(ends) else ends
        else:
            # The model's own leading space covers no original byte.
            ends = np.maximum(ends - self.dummy_prefix, 0)
            begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        if all([r[2] is None for r in rows]):
            decoded = normalised.replace(SPACE, " ")
        else:
            decoded = "".join(
                [s.replace(SPACE, " ") if r[2] is None else r[2]
                 for s, r in zip(stretches, rows, strict=True)]
            )
        return ids, begins, ends, self._without_prefix(decoded)


def _replaced(run: bytes) -> str:
    """UTF-8 decoding in which every invalid byte becomes one replacement mark."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        n = _char_length(run, at)
        out.append(run[at : at + n].decode() if n else "�")
        at += n or 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """One codec per Python worker and model, so its memory serves later tasks."""
    return Codec(path)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Every document with its pieces.

    Takes `text`; all columns are kept, and piece_ids (array<int>), piece_begins
    and piece_ends (array<long>, bytes of the original text) follow, replacing
    columns of these names. A null or empty text has empty arrays.
    """
    added = ["piece_ids", "piece_begins", "piece_ends"]
    kept = docs.drop(*added)
    at = kept.columns.index("text")
    schema = (
        StructType(list(kept.schema))
        .add("piece_ids", ArrayType(IntegerType()))
        .add("piece_begins", ArrayType(LongType()))
        .add("piece_ends", ArrayType(LongType()))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for small in slices(batches):
            found = [codec.encode(t or "") for t in small.column(at).to_pylist()]
            counts = [len(x[1]) for x in found]
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            joined = ",".join([x[0] for x in found if x[0]])
            ids = np.fromstring(joined, dtype=np.int32, sep=",")
            lists = [ids] + [
                np.concatenate([x[k] for x in found]).astype(np.int64) for k in (1, 2)
            ]
            yield pa.RecordBatch.from_arrays(
                [*small.columns]
                + [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in lists],
                names=[*small.schema.names, *added],
            )

    return kept.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, model: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of ids, decoded text and spans.

    The same encoding as `encode_documents`, with digests in place of arrays: of
    decimal ids joined by commas, of the decoded text in UTF-8, and of the begins
    followed by the ends as little-endian 64-bit numbers. Takes doc_id and text.
    Null counts as empty, which has no token. Repeated rows give repeated
    results, an empty table an empty one.
    """

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in slices(batches):
            counts, ids, decoded, spans = [], [], [], []
            for text in batch.column(1):
                joined, begins, ends, plain = codec.encode(text.as_py())
                counts.append(len(begins))
                ids.append(sha(joined.encode()))
                decoded.append(sha(plain.encode("utf-8", "replace")))
                spans.append(
                    sha(begins.astype("<i8").tobytes() + ends.astype("<i8").tobytes())
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())]
                + [pa.array(x, pa.string()) for x in (ids, decoded, spans)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string,"
        " spans_sha256 string",
    )
