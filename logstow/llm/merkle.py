"""A Merkle manifest of documents, verified by a recursive climb.

Every row is a leaf. Leaves of a language in order of id are hashed run by run,
eight children to a node, level by level, up to the language's subroot; subroots
in order of language likewise, up to the root. The built levels are stored as
rows that know their parent and hold their children's digests. A recursive query
ascends from every leaf along these rows, appends the siblings it passes and folds
the digest that the leaf has now into the root it would give.

The leaves of one run pass the same nodes, so they ascend as one row: one list of
siblings, one folded digest for each leaf.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstow.llm.ranking import ranked
from logstow.llm.tables import id_remainder, written

FANOUT = 8
#: What a leaf is the digest of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A node's id is 64 times the position of its first leaf, and its level.
LEVELS = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Manifest:
    """The stored tree.

    leaves: doc_id, leaf, claimed (what the row hashes to now), subroot, parent, ordinal.
    nodes: node, parent, ordinal, digest, children (digests left to right); the root
        has no parent, as has the only leaf of a table with one row.
    root: the root's digest, None for an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: bytes | None


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _joined(digests: Column) -> Column:
    """Binary digests as one."""
    return F.aggregate(digests, F.lit(b""), lambda all_, one: F.concat(all_, one))


def _node_digest(children: Column) -> Column:
    return _digest(F.lower(F.hex(_joined(children))))


def row_digest(text: Column) -> Column:
    """The digest of a row, with `text` in the place of its text."""

    def part(name: str) -> Column:
        value = text if name == "text" else F.col(name).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(sized, F.lit("-"))

    return _digest(F.concat(*[part(name) for name in FIELDS]))


def _parent(first: Column, index: Column, level: int, sign: int) -> Column:
    """Id of the node above a node with this index on this level of its tree."""
    begin = first + F.floor(index / FANOUT) * FANOUT ** (level + 1)
    return (sign * (begin * LEVELS + level + 1)).cast("long")


def _levels(base: DataFrame, label: str, sign: int) -> tuple[DataFrame, DataFrame]:
    """Inner nodes of all trees of a forest, and the top node of each tree.

    base: (first, size, index, digest, id) of the lowest nodes; `first` names the tree.
    Nodes are (first, size, index, id, digest, children), size being that of their
    level; those on which nothing stands have size 1.
    """
    inner, tops, level = [], [base.filter("size = 1")], 0
    largest = base.agg(F.max("size")).first()[0] or 0
    nodes = base
    while largest > 1:
        above = (
            nodes.filter("size > 1")
            .groupBy("first", "size", F.floor(F.col("index") / FANOUT).alias("above"))
            .agg(F.array_sort(F.collect_list(F.struct("index", "digest"))).alias("run"))
            .select(
                "first",
                F.ceil(F.col("size") / FANOUT).alias("size"),
                F.col("above").alias("index"),
                _parent(F.col("first"), F.col("run")[0]["index"], level, sign).alias("id"),
                _node_digest(F.col("run.digest")).alias("digest"),
                F.col("run.digest").alias("children"),
            )
        )
        nodes = written(above, f"{label}-{level + 1}")
        inner.append(nodes.withColumn("level", F.lit(level + 1)))
        tops.append(nodes.filter("size = 1").select(*base.columns))
        level, largest = level + 1, -(-largest // FANOUT)
    if not inner:
        children = F.array().cast("array<binary>").alias("children")
        inner = [base.limit(0).select("*", children, F.lit(0).alias("level"))]
    return reduce(DataFrame.unionByName, inner), reduce(DataFrame.unionByName, tops)


def _linked(nodes: DataFrame, sign: int) -> DataFrame:
    """Inner nodes with their parent and their place in its run."""
    begin = F.col("first") + F.floor(F.col("index") / FANOUT) * F.pow(
        F.lit(FANOUT), F.col("level") + 1
    ).cast("long")
    parent = (sign * (begin * LEVELS + F.col("level") + 1)).cast("long")
    return nodes.select(
        "first",
        F.col("id").alias("node"),
        F.when(F.col("size") > 1, parent).alias("parent"),
        F.when(F.col("size") > 1, F.col("index") % FANOUT).cast("int").alias("ordinal"),
        "digest",
        "children",
    )


def build_manifest(docs: DataFrame, text_now: Column | None = None) -> Manifest:
    """Hash the documents into a stored tree.

    docs: doc_id, source, lang, n_chars, text; other columns play no part. Nulls hash
        as `-`. Rows without language form the first tree; without id they come first
        in theirs. Rows that share an id are in order of their digests; rows that are
        the same in every field are leaves of their own.
    text_now: the text as it is when the manifest is verified, if not as it was.
    """
    text = F.col("text")
    hashed = written(
        docs.select(
            F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit("")).alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            row_digest(text).alias("leaf"),
            (row_digest(text_now) if text_now is not None else F.lit(None).cast("binary")).alias(
                "claimed"
            ),
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    placed = ranked(hashed, "tree", ["doc_id", "leaf", "row"], "merkle")
    first, index = F.col("group_start"), F.col("position")
    leaves = placed.select(
        first.alias("first"),
        F.col("group_size").alias("size"),
        index.alias("index"),
        F.col("leaf").alias("digest"),
        ((first + index) * LEVELS).alias("id"),
    )
    inner, subroots = _levels(leaves, "merkle-level", 1)
    forest = ranked(
        written(subroots.withColumn("all", F.lit(0)), "merkle-subroots"), "all", ["first"], "merkle-top"
    ).select(
        F.col("first").alias("tree_first"),
        F.lit(0).cast("long").alias("first"),
        F.col("group_size").alias("size"),
        F.col("position").alias("index"),
        "digest",
        "id",
    )
    top, roots = _levels(forest.drop("tree_first"), "merkle-top-level", -1)
    found = roots.select("digest").collect()
    root = bytes(found[0].digest) if found else None
    # Where the top node of each language hangs.
    hooks = written(
        forest.select(
            F.col("tree_first").alias("first"),
            F.col("digest").alias("subroot"),
            F.when(F.col("size") > 1, _parent(F.lit(0), F.col("index"), 0, -1)).alias("hook"),
            F.when(F.col("size") > 1, F.col("index") % FANOUT).cast("int").alias("hook_ordinal"),
        ),
        "merkle-hooks",
    )

    def hung(nodes: DataFrame) -> DataFrame:
        return (
            nodes.join(hooks, "first")
            .withColumn("ordinal", F.coalesce("ordinal", "hook_ordinal"))
            .withColumn("parent", F.coalesce("parent", "hook"))
        )

    columns = ["node", "parent", "ordinal", "digest", "children"]
    nodes = written(
        hung(_linked(inner, 1)).select(*columns).unionByName(_linked(top, -1).select(*columns)),
        "merkle-nodes",
    )
    own = placed.select(
        first.alias("first"),
        "doc_id",
        "leaf",
        F.coalesce("claimed", "leaf").alias("claimed"),
        F.when(F.col("group_size") > 1, _parent(first, index, 0, 1)).alias("parent"),
        F.when(F.col("group_size") > 1, index % FANOUT).cast("int").alias("ordinal"),
    )
    return Manifest(
        hung(own).select("doc_id", "leaf", "claimed", "subroot", "parent", "ordinal"), nodes, root
    )


def _others(children: str, ordinal: str) -> str:
    """SQL for the digests of a run but one, as one value."""
    return f"aggregate(filter({children}, (x, i) -> i <> {ordinal}), X'', (a, x) -> concat(a, x))"


def _fold(children: str, ordinal: str, digest: str) -> str:
    """SQL for a node's digest with another one in the place of one of its children."""
    run = f"transform({children}, (x, i) -> if(i = {ordinal}, {digest}, x))"
    return f"unhex(sha2(lower(hex(aggregate({run}, X'', (a, x) -> concat(a, x)))), 256))"


# From each run of leaves up to the root. A row takes its node's children, puts the
# digest it brings in its place among them, and hashes; the others are its siblings.
# LIMIT ALL lifts the bound on rows that recursion has by default.
CLIMB = f"""
WITH RECURSIVE climb(run, up, ordinal, folds, path) AS (
  SELECT run, up, ordinal,
         transform(leaves, l -> {_fold("children", "l.ordinal", "l.claimed")}), X''
  FROM {{runs}}
  UNION ALL
  SELECT c.run, n.parent, n.ordinal,
         transform(c.folds, f -> {_fold("n.children", "c.ordinal", "f")}),
         concat(c.path, {_others("n.children", "c.ordinal")})
  FROM climb c JOIN {{nodes}} n ON c.up = n.node
)
SELECT run, folds, path FROM climb WHERE up IS NULL LIMIT ALL
"""


def verify(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof and the root that its claimed digest gives.

    Returns doc_id, leaf, claimed, subroot, proof (the siblings' binary digests from
    the leaf's run to the root's, left to right, as one value) and folded. A table's
    only leaf is the root itself, and its proof empty.
    """
    leaf = F.struct("ordinal", "leaf", "doc_id", "claimed", "subroot")
    runs = written(
        manifest.leaves.filter("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("run"))
        .agg(F.array_sort(F.collect_list(leaf)).alias("leaves"))
        .join(
            manifest.nodes.select(
                F.col("node").alias("run"), F.col("parent").alias("up"), "ordinal", "children"
            ),
            "run",
        ),
        "merkle-runs",
    )
    nodes = manifest.nodes.select("node", "parent", "ordinal", "children")
    climbed = runs.sparkSession.sql(
        CLIMB, runs=runs.select("run", "up", "ordinal", "children", "leaves"), nodes=nodes
    )
    many = (
        runs.select("run", "children", "leaves")
        .join(climbed, "run")
        .select("children", "folds", "path", F.posexplode("leaves").alias("place", "own"))
        .select(
            "own.doc_id",
            "own.leaf",
            "own.claimed",
            "own.subroot",
            F.concat(F.expr(_others("children", "own.ordinal")), F.col("path")).alias("proof"),
            F.get("folds", F.col("place")).alias("folded"),
        )
    )
    alone = manifest.leaves.filter("parent IS NULL").select(
        "doc_id", "leaf", "claimed", "subroot", F.lit(b"").alias("proof"),
        F.col("claimed").alias("folded"),
    )
    return many.unionByName(alone)


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of the documents, verified after some texts were lower-cased.

    The letters A-Z of texts whose id's crc32 is divisible by 3 are lower-cased; a null
    id counts as the empty text there. Returns doc_id, leaf, subroot, root, proof_sha256,
    folded_root (digests in lowercase hex) and verified. One row per row of the
    documents, none for an empty table; nulls, ties and repeated rows as
    `build_manifest` has them.
    """
    text = F.col("text")
    tampered = F.when(id_remainder(3) == 0, F.translate(text, UPPER, LOWER)).otherwise(text)
    manifest = build_manifest(docs, tampered)

    def shown(digest: Column) -> Column:
        return F.lower(F.hex(digest))

    root = shown(F.lit(manifest.root))
    return verify(manifest).select(
        "doc_id",
        shown(F.col("leaf")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(shown(F.col("proof")), 256).alias("proof_sha256"),
        shown(F.col("folded")).alias("folded_root"),
        (shown(F.col("folded")) == root).alias("verified"),
    )
