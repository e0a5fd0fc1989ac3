import hashlib
import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from logstow.llm.sentencepiece_codec import CharacterMap, Codec, digest_documents, encode_documents

from .conftest import LONG, by_id

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH, remembered=50)


def same(codec, library, text):
    ids, begins, ends, decoded = codec.encode(text)
    want = library.encode(text)
    assert [int(i) for i in ids.split(",") if i] == want
    assert decoded == library.decode(want) == codec.decode(want)
    size = len(text.encode())
    if want:
        assert begins[0] == 0 and ends[-1] == size and (begins[1:] == ends[:-1]).all()
    else:
        assert len(begins) == 0


@settings(max_examples=600, deadline=None)
@given(st.text("ab éñ▁ \n\t😀漢<s>0x1.,!THEthe ²»'\"", max_size=60) | st.text(max_size=30))
def test_same_as_the_library(codec, library, text):
    if text.encode("utf-8", "replace").decode() == text:
        same(codec, library, text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "\n", "▁", "▁▁ x", "</s><unk><0x41>", "x" * 5000, " " * 700, "\x00a", "ﬁ １２", LONG],
)
def test_special_texts(codec, library, text):
    same(codec, library, text)


def test_spans_cover_the_pieces(codec):
    text = "  Ünïcode, words"
    ids, begins, ends, _ = codec.encode(text)
    data = text.encode()
    pieces = [codec.pieces[int(i)] for i in ids.split(",")]
    for piece, b, e in list(zip(pieces, begins, ends, strict=True))[1:]:
        assert data[b:e].decode() == piece.replace("▁", " ")


def double_array(entries):
    """A compiled map by hand: a double-array trie over the keys, and the strings."""
    strings, at = b"", {}
    for key, value in entries.items():
        at[key] = len(strings)
        strings += value + b"\0"
    units, base = [0] * 4096, 256
    def place(node, prefix, keys):
        nonlocal base
        own = base
        base += 512
        leaf = prefix in at
        # offset from the node's own place to its children's base
        units[node] |= (own ^ node) << 10 | (1 << 8 if leaf else 0)
        if leaf:
            units[own] = at[prefix] | 1 << 31
        for c in sorted({k[len(prefix)] for k in keys if len(k) > len(prefix)}):
            units[own ^ c] = c
            place(own ^ c, prefix + bytes([c]), [k for k in keys if k.startswith(prefix + bytes([c]))])
    place(0, b"", list(at))
    packed = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(packed)) + packed + strings


def test_character_map_takes_the_longest_prefix_and_keeps_sources(codec):
    blob = double_array({b"a": b"A", b"ab": b"XYZ", "é".encode(): b"e"})
    charmap = CharacterMap(blob)
    assert charmap.longest(b"abc", 0) == (b"XYZ", 2)
    assert charmap.longest(b"ac", 0) == (b"A", 1)
    assert charmap.longest(b"zab", 0) is None
    own = Codec(PATH)
    own.charmap = charmap
    text, source = own.normalise("ab é")
    assert text == "▁XYZ▁e"
    # The model's space, three bytes from the first two, the space, and e from é.
    assert source.tolist() == [0, 0, 0, 0, 0, 0, 2, 2, 2, 3, 5]


def test_trimming_models(codec):
    own = Codec(PATH)
    own.trim = True
    text, source = own.normalise("  a   b  ")
    assert text == "▁a▁b" and source[-1] == 7
    assert own.normalise("   ")[0] == "" and own.decode(own._known("▁a")[0] and [264]) == "a"


def test_documents(spark, awkward, nothing, library):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    got = digest_documents(awkward, PATH).drop("spans_sha256").collect()
    want = []
    for r in awkward.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert by_id(got) == by_id(want)
    full = encode_documents(awkward, PATH)
    assert full.columns == [*awkward.columns, "piece_ids", "piece_begins", "piece_ends"]
    for r in full.collect():
        assert r.piece_ids == library.encode(r.text or "")
        assert len(r.piece_begins) == len(r.piece_ends) == len(r.piece_ids)
    assert digest_documents(nothing, PATH).collect() == encode_documents(nothing, PATH).collect() == []
