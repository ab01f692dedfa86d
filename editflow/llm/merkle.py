"""Manifest of a dataset: a tree of hashes over its documents, with a proof for each of them.

Documents are leaves. Within a source they are ranked by id, and every FANOUT consecutive
nodes of a level become one node of the next, until one is left: the source's subroot.
Subroots, ranked by source, grow the same kind of tree up to the root.

Every node carries the interval of leaf ranks [lo, hi) that it covers, so the tree is a set
of nested intervals. Ancestors are attached from the top down, level by level: a node and
its parent fall into the same bucket of FANOUT ** (level + 1) ranks, and the parent's
interval contains the node's. The difference of the two intervals, below and above the
node, is covered by its siblings, whose digests the parent holds in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.functions.skew import numbered
from editflow.llm.tables import stored

FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
BITS = 4
FANOUT = 1 << BITS
TAMPERED_ONE_IN = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest_of(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(text: Column | None = None) -> Column:
    """Of all fields; each is '-' if null, else its number of bytes, a colon and its value."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest_of(*parts)


def lowered(text: Column) -> Column:
    """The text with A to Z in lower case and all else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def tampered(doc_id: Column) -> Column:
    """Whether the id's CRC-32, written in decimals, chooses the row for a trial of the proofs."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % TAMPERED_ONE_IN == 0, F.lit(False))


def manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """One row per row of docs (FIELDS): doc_id, source, lo, leaf, subroot, root, path, found.

    lo is the leaf's rank in its source, from 0. path lists, level by level up to the root,
    what the siblings' digests on the left and on the right are, concatenated. `found`, if
    given, is the digest of the document as found later (an expression over docs; null: as
    it was), see `folded`.

    A null field hashes as '-', an empty text as '0:'. Null sources are one source, ranked
    first; sources go by their UTF-8 bytes. Rows without doc_id come first in their source;
    rows with equal doc_id are ordered by leaf, so equal rows are leaves side by side. An
    empty table has no rows, hence no root. Other columns of docs are ignored.
    """
    typed = docs.select(*[F.col(name).cast(kind).alias(name) for name, kind in FIELDS.items()])
    later = F.lit(None).cast("string") if found is None else found
    # A source gets a sign in front, so that null is neither lost in joins nor equal to ''.
    tree = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    leaves = typed.select("doc_id", "source", tree.alias("tree"), leaf_digest().alias("digest"), later.alias("found"))
    leaves = _ranked(leaves, ["doc_id", "digest"], ["tree"])
    levels, tops = _grow(leaves)
    sources = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.col("level").alias("height"))
    sources = _ranked(sources, ["name"], [])
    above, summit = _grow(sources)
    root = summit.select("digest").first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    summit = summit.withColumns({"path": none, "subroot": F.col("digest")})
    tops = _descend(sources, above, summit).select(
        F.col("name").alias("tree"), F.col("height").alias("level"), "path", F.col("digest").alias("subroot")
    )
    rows = _descend(leaves, levels, stored(tops, "subroots"))
    return rows.select(
        "doc_id",
        "source",
        "lo",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root and root["digest"]).cast("string").alias("root"),
        "path",
        "found",
    )


def proof(path: Column) -> Column:
    """Digest of all siblings, from the leaf's level up, left to right."""
    return digest_of(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest_of(s["left"], node, s["right"]))


def trial(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs.

    Rows that `tampered` chooses are verified with their text in lower case: they fail
    unless it was so before. All other rows are verified as they are. See `manifest` for
    nulls, ties and empty tables.
    """
    found = F.when(tampered(F.col("doc_id")), leaf_digest(lowered(F.col("text"))))
    rows = manifest(docs, found)
    folds = folded(F.coalesce("found", "leaf"), F.col("path"))
    rows = rows.withColumns({"proof_sha256": proof(F.col("path")), "folded_root": folds})
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified)


def _ranked(nodes: DataFrame, order: list[str], keys: list[str]) -> DataFrame:
    """Level 0: each node covers its own rank, counted from 0 in `order`, per key."""
    rows = numbered(nodes, order, "hi", keys)
    return stored(rows.withColumn("lo", F.col("hi") - 1), "leaves")


def _bucket(lo: Column, level: int) -> Column:
    return F.shiftright(lo, BITS * level)


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels from 1 up (tree, lo, hi, digests of children, digest), and each tree's top (tree, digest, level).

    The first node of a level that has a single child would be the parent of a tree's only
    node: that child is the top.
    """
    rows, levels, tops = nodes, [], []
    while True:
        level = len(levels) + 1
        node = F.struct("lo", "hi", "digest")
        parents = rows.groupBy("tree", _bucket(F.col("lo"), level).alias("bucket")).agg(
            F.sort_array(F.collect_list(node)).alias("children")  # FANOUT at most
        )
        parents = parents.select(
            "tree",
            F.col("children")[0]["lo"].alias("lo"),
            F.array_max("children.hi").alias("hi"),
            F.col("children.digest").alias("digests"),
            digest_of(F.array_join("children.digest", "")).alias("digest"),
        )
        parents = stored(parents, "nodes")
        only = (F.col("lo") == 0) & (F.size("digests") == 1)
        top = F.col("digests")[0].alias("digest")
        tops.append(parents.where(only).select("tree", top, F.lit(level - 1).alias("level")))
        rows = parents.where(~only)
        if rows.isEmpty():
            break
        levels.append(rows)
    every = tops[0]
    for some in tops[1:]:
        every = every.unionByName(some)
    return levels, every


def _descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """leaves with the path and subroot of each, attached from the tops (tree, level, path, subroot) down."""
    above = None
    for level in range(len(levels), -1, -1):
        nodes = levels[level - 1] if level else leaves
        # A top covers its whole tree, so it begins at 0.
        own = tops.where(F.col("level") == level).select("tree", "path", "subroot")
        first = nodes.where("lo = 0").join(own, "tree")
        found = first if above is None else first.unionByName(_contained(nodes, above, level))
        if level:
            found = stored(found, "paths")
        above = found
    return above


def _contained(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """nodes of a level, each with the path through the parent that contains it."""
    up = parents.select(
        F.col("tree").alias("_tree"),
        F.col("lo").alias("_from"),
        F.col("hi").alias("_upto"),
        F.col("digests").alias("_children"),
        F.col("path").alias("_above"),
        "subroot",
    )
    lo, hi, start = F.col("lo"), F.col("hi"), F.col("_from")
    near = (F.col("tree") == F.col("_tree")) & (_bucket(lo, level + 1) == _bucket(start, level + 1))
    inside = (lo >= start) & (hi <= F.col("_upto"))
    # The interval difference [from, lo) is covered by so many children on the left; the rest follow the node.
    left = F.shiftright(lo - start, BITS * level).cast("int")
    siblings = F.struct(
        F.array_join(F.slice("_children", F.lit(1), left), "").alias("left"),
        F.array_join(F.slice("_children", left + 2, F.lit(FANOUT)), "").alias("right"),
    )
    joined = nodes.join(up, near & inside)
    path = F.concat(F.array(siblings), F.col("_above"))
    return joined.select(*nodes.columns, path.alias("path"), "subroot")
