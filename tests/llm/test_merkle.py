"""The manifest and its verification against a plain climb in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from logstow.llm.merkle import build_manifest, merkle_manifest, verify

from .conftest import DOCUMENTS, by_id


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return digest("".join(parts))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def plain(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row.lang, []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [(r.doc_id is not None, r.doc_id or 0, row_digest(r, r.text), r) for r in by_lang[lang]]
        own.sort(key=lambda x: x[:3])
        trees[lang] = ([x[3] for x in own], levels([x[2] for x in own]))
    top = levels([trees[lang][1][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for i, row in enumerate(trees[lang][0]):
            text, own_id = row.text, "" if row.doc_id is None else str(row.doc_id)
            if text is not None and zlib.crc32(own_id.encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded, proof = row_digest(row, text), ""
            for tree, at in ((trees[lang][1], i), (top, j)):
                for nodes in tree[:-1]:
                    run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
                    proof += "".join(x for k, x in enumerate(run) if k != at % 8)
                    run[at % 8] = folded
                    folded, at = digest("".join(run)), at // 8
            low = trees[lang][1]
            out.append(
                (row.doc_id, low[0][i], low[-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0])
            )
    return out


def test_awkward_rows(awkward):
    assert by_id(merkle_manifest(awkward).collect()) == by_id(plain(awkward.collect()))


@pytest.mark.parametrize("languages, rows", [(1, 9), (8, 8), (9, 30), (70, 150)])
def test_trees_of_many_shapes(spark, languages, rows):
    made = [(i, f"Text {i} of Many", f"l{i % languages}", "s", i) for i in range(rows)]
    docs = spark.createDataFrame(made, DOCUMENTS).repartition(5)
    assert by_id(merkle_manifest(docs).collect()) == by_id(plain(docs.collect()))


def test_few_rows(small, nothing):
    assert merkle_manifest(nothing).collect() == []
    for n in (1, 2):
        docs = small.orderBy("doc_id").limit(n)
        assert by_id(merkle_manifest(docs).collect()) == by_id(plain(docs.collect()))


def test_nodes_know_their_parents(small):
    manifest = build_manifest(small)
    nodes = {r.node: r for r in manifest.nodes.collect()}
    assert [r.digest for r in nodes.values() if r.parent is None] == [manifest.root]
    for row in nodes.values():
        if row.parent is not None:
            assert nodes[row.parent].children[row.ordinal] == row.digest
    for leaf in manifest.leaves.collect():
        assert nodes[leaf.parent].children[leaf.ordinal] == leaf.leaf
    assert verify(manifest).filter(F.col("folded") != F.lit(manifest.root)).count() == 0
