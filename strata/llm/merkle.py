"""Merkle manifest of a dataset: blocks of hashes in van Emde Boas order.

Leaves are rows, in one tree per language; the trees' roots are the leaves of a
last tree. A run of two consecutive nodes becomes their hash; a node alone at
the end of its level is hashed by itself.

1. Rows are range-sorted by (tree, doc_id, leaf) and written; a leaf's position
   in its tree is its place in its piece plus the rows of earlier pieces (one
   summary row per piece and tree), so no tree passes through one task.
2. A tree is cut into aligned subtrees (blocks) of 2^``HEIGHT`` leaves. Each is
   built in one task and stored as one array in van Emde Boas order: the
   complete tree is split at half its height, the top half is stored first, then
   each bottom tree, all by the same rule again. A root-to-leaf walk of a block
   so touches few cache lines or disk pages, whatever their size. The address of
   a node needs only its depth's three numbers (see ``Layout``), both for
   building and for reading siblings.
3. Block roots are the leaves of the next tier, until a tree has one block:
   three tiers reach 2^36 leaves.
4. Proofs go back down: a block's siblings above it are the siblings read from
   its parent block and those above that. The rows meet their block and the
   block's own proof by cogrouping on (tree, block), at most 2^``HEIGHT`` rows a
   group.

Hashes travel as 32 bytes; they are hashed as lowercase hex text.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import with_places, write_once

HEIGHT = 12
# Columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Key of the tree whose leaves are the other trees' roots.
TOP = ""

BLOCK = "tree string, tier int, block long, leaves int, nodes array<binary>, root binary"
PROOF = "digests array<binary>, lefts array<boolean>"


def _hash(*digests: bytes) -> bytes:
    """H of digests: SHA-256 of their hex texts in a row."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


class Layout:
    """Addresses of a complete binary tree of ``depth`` levels below its root.

    For each depth d, the nodes at d are roots of bottom trees in one of the
    recursive splits: ``top`` is the size of that split's top tree, ``bottom``
    the size of each of its bottom trees and ``at`` the depth of the top tree's
    root. The node that is number i (from 1, by levels) has the address of its
    ancestor at depth ``at``, plus the top tree, plus as many bottom trees as
    stand before its own, which the low bits of i tell.
    """

    def __init__(self, depth: int):
        self.depth = depth
        self.size = (2 << depth) - 1
        self.top, self.bottom, self.at = [0] * (depth + 1), [0] * (depth + 1), [0] * (depth + 1)
        self._split(0, depth + 1)

    def _split(self, first: int, levels: int) -> None:
        if levels == 1:
            return
        upper = levels // 2
        root = first + upper
        self.top[root], self.bottom[root], self.at[root] = (1 << upper) - 1, (1 << levels - upper) - 1, first
        self._split(first, upper)
        self._split(root, levels - upper)

    def addresses(self, d: int, places: np.ndarray) -> np.ndarray:
        """Addresses of the nodes of depth d at the given places from the left."""
        if d == 0:
            return np.zeros(len(places), np.int64)
        above = self.addresses(self.at[d], places >> d - self.at[d])
        number = places + (1 << d)
        return above + self.top[d] + (number & self.top[d]) * self.bottom[d]


@lru_cache(maxsize=64)
def layout(depth: int) -> Layout:
    return Layout(depth)


def build_block(leaves: list[bytes], depth: int) -> list[bytes | None]:
    """The block of ``leaves`` after ``depth`` levels of hashing, in van Emde Boas
    order; places that no node takes are None. The root is at address 0."""
    shape = layout(depth)
    nodes: list[bytes | None] = [None] * shape.size
    level = list(leaves)
    for d in range(depth, -1, -1):
        for address, digest in zip(shape.addresses(d, np.arange(len(level))).tolist(), level):
            nodes[address] = digest
        level = [_hash(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return nodes


def siblings(nodes: list[bytes | None], place: int, depth: int) -> list[bytes | None]:
    """Siblings of the leaf at ``place`` of a block, from the leaf's level up;
    None where the node is alone in its run."""
    shape = layout(depth)
    return [nodes[int(shape.addresses(d, np.array([place >> depth - d ^ 1]))[0])] for d in range(depth, 0, -1)]


def _all_siblings(nodes: list[bytes | None], places: np.ndarray, depth: int) -> list[list[bytes | None]]:
    """``siblings`` of many leaves: one list per level."""
    shape = layout(depth)
    return [[nodes[a] for a in shape.addresses(d, places >> depth - d ^ 1).tolist()] for d in range(depth, 0, -1)]


def fold(digest: bytes, proof: list[tuple[bytes | None, bool]]) -> bytes:
    """The root that a leaf and its siblings (digest or None, whether it stands
    to the left) lead to."""
    for other, left in proof:
        digest = _hash(digest) if other is None else _hash(other, digest) if left else _hash(digest, other)
    return digest


def _depth(leaves: int, only: bool, height: int) -> int:
    """Levels that a block is hashed: all of them where its tree goes on above,
    else until one node is left."""
    return (leaves - 1).bit_length() if only else height


# ---- leaves --------------------------------------------------------------------------


def leaf_hash(docs: DataFrame, **changed: Column) -> Column:
    """SHA-256 of a row's columns, each as ``-`` (null) or length:value."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(c) for c in LEAF_COLUMNS]), 256))


def dataset_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, tampered`` per row. Where 7 divides the CRC-32 of the
    decimal doc_id, ``tampered`` is the leaf of the row with ``n_chars`` + 1;
    elsewhere null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        "doc_id",
        # The null language sorts first, the others by their bytes.
        F.coalesce(F.concat(F.lit("1"), F.col("lang")), F.lit("0")).alias("tree"),
        leaf_hash(docs).alias("leaf"),
        F.when(chosen, leaf_hash(docs, n_chars=more)).alias("tampered"),
    )


# ---- blocks ----------------------------------------------------------------------------


def _builder(tier: int, height: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        depth = _depth(len(rows), bool(rows["only"].iloc[0]), height)
        nodes = build_block(rows["leaf"].tolist(), depth)
        return pd.DataFrame(
            [(rows["tree"].iloc[0], tier, rows["block"].iloc[0], len(rows), nodes, nodes[0])],
            columns=["tree", "tier", "block", "leaves", "nodes", "root"],
        )

    return build


def build_tiers(leaves: DataFrame, name: str, height: int = HEIGHT) -> list[DataFrame]:
    """Blocks of the trees of ``leaves`` (``tree, place, leaf``), one written
    frame per tier from the bottom, each with the ``depth`` of its blocks."""
    counts = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    counts = write_once(counts, f"{name}-counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    nodes = leaves.select("tree", "place", "leaf")
    width = 1
    while not tiers or most > width:
        width <<= height
        cut = nodes.join(counts, "tree").select(
            "tree", F.shiftright("place", height).alias("block"), "place", "leaf", (F.col("n") <= width).alias("only")
        )
        tier = len(tiers)
        blocks = write_once(cut.groupBy("tree", "block").applyInPandas(_builder(tier, height), BLOCK), f"{name}-tier{tier}")
        tiers.append(blocks)
        # Trees of one block end here; the roots of the others are the next leaves.
        several = blocks.join(counts.filter(F.col("n") > width), "tree", "left_semi")
        nodes = several.select("tree", F.col("block").alias("place"), F.col("root").alias("leaf"))
    return tiers


def _unpacked(row: pd.Series) -> tuple[list, list[bool]]:
    return list(row["digests"]), [bool(x) for x in row["lefts"]]


def _lister(height: int):
    """Per leaf of a block, the proof from it to the top: the block's siblings,
    then those of the block itself."""

    def run(keys: tuple, blocks: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame(columns=["tree", "place", "digests", "lefts"])
        row = blocks.iloc[0]
        n, nodes = int(row["leaves"]), list(row["nodes"])
        depth = (len(nodes) + 1).bit_length() - 2
        digests, lefts = _unpacked(above.iloc[0]) if len(above) else ([], [])
        own = _all_siblings(nodes, np.arange(n), depth)
        out = [
            (keys[0], (int(keys[1]) << height) + k, [level[k] for level in own] + digests, [bool(k >> i & 1) for i in range(depth)] + lefts)
            for k in range(n)
        ]
        return pd.DataFrame(out, columns=["tree", "place", "digests", "lefts"])

    return run


def upper_proofs(tiers: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``tree, place, digests, lefts``: for each block of the lowest tier (its
    number is ``place``), the siblings from its root to the top. ``above``: those
    of whole trees (``tree, digests, lefts``)."""
    known = None
    for tier in reversed(tiers):
        # Trees that end at this tier have one block here, and none above.
        ends = tier.filter("block = 0").select("tree")
        if known is not None:
            ends = ends.join(known.filter("place = 0"), "tree", "left_anti")
        asked = ends.join(above, "tree").select("tree", F.lit(0).cast("long").alias("place"), "digests", "lefts")
        asked = asked if known is None else known.unionByName(asked)
        if tier is not tiers[0]:
            known = write_once(_leaf_proofs(tier, asked, height), "merkle-proofs")
    return asked


def _leaf_proofs(tier: DataFrame, proofs: DataFrame, height: int) -> DataFrame:
    """Proofs of the leaves of a tier's blocks from those of the blocks."""
    # Named apart: both sides may come from one frame.
    blocks = proofs.select(F.col("tree").alias("owner"), F.col("place").alias("number"), "digests", "lefts").groupBy("owner", "number")
    return tier.groupBy("tree", "block").cogroup(blocks).applyInPandas(_lister(height), f"tree string, place long, {PROOF}")


def _prover(height: int):
    def run(keys: tuple, rows: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        if not len(rows):
            return pd.DataFrame(columns=columns)
        row = blocks.iloc[0]
        nodes = list(row["nodes"])
        depth = (len(nodes) + 1).bit_length() - 2
        above = list(zip(*_unpacked(row)))
        places = (rows["place"] - (int(keys[1]) << height)).to_numpy()
        own = _all_siblings(nodes, places, depth)
        rest = "".join(d.hex() for d, _ in above if d is not None).encode()
        out = []
        for k, (place, doc_id, leaf, tampered) in enumerate(zip(places.tolist(), rows["doc_id"], rows["leaf"], rows["tampered"])):
            proof = [(level[k], bool(place >> i & 1)) for i, level in enumerate(own)]
            said = "".join(d.hex() for d, _ in proof if d is not None).encode() + rest
            folded = fold(leaf if tampered is None else tampered, proof + above)
            out.append((doc_id, leaf.hex(), row["subroot"].hex(), row["top"].hex(), hashlib.sha256(said).hexdigest(), folded.hex()))
        return pd.DataFrame(out, columns=columns)

    return run


def merkle_manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``.

    The trees are built over the rows as they are. ``folded_root`` is recomputed
    from the row's leaf, or the tampered one where the row was chosen for
    tampering (see ``dataset_leaves``), and the siblings read from the stored
    blocks; ``verified`` tells whether it is the root.

    Defined cases: a null column is hashed as ``-``; the null language has a
    tree of its own, first; rows of one language with equal doc_ids go by their
    leaf hash, a null doc_id first and never chosen for tampering; a null
    ``n_chars`` stays null when tampered; a tree of one leaf has that leaf as its
    root, and a proof without siblings is the hash of nothing; repeated rows
    are leaves of their own; extra columns aren't read; an empty table gives an
    empty result.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")],
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    hashed = write_once(dataset_leaves(plain), "merkle-leaves")
    leaves = write_once(with_places(hashed, "tree", ["doc_id", "leaf"], "merkle-sorted"), "merkle-places")
    tiers = build_tiers(leaves, "merkle", height)
    # A tree's root is that of the highest tier it reaches, where it has one block.
    top = tiers[-1].select("tree", "tier", "root")
    for tier in tiers[:-1]:
        top = top.unionByName(tier.select("tree", "tier", "root"))
    subroots = write_once(top.groupBy("tree").agg(F.max_by("root", "tier").alias("subroot")), "merkle-subroots")
    ordered = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("member"), F.col("subroot").alias("leaf"))
    members = write_once(with_places(ordered, "tree", ["member"], "merkle-trees"), "merkle-members")
    upper = build_tiers(members, "merkle-top", height)
    empty = [F.array().cast(f"array<{kind}>").alias(c) for c, kind in (("digests", "binary"), ("lefts", "boolean"))]
    none = upper[-1].select("tree", *empty)
    tops = _leaf_proofs(upper[0], upper_proofs(upper, none, height), height)
    whole = upper[-1].select("tree", F.col("root").alias("top"))
    above = members.join(tops, ["tree", "place"]).join(whole, "tree").select(F.col("member").alias("tree"), "digests", "lefts", "top")
    above = write_once(above.join(subroots, "tree"), "merkle-above")
    proofs = upper_proofs(tiers, above.select("tree", "digests", "lefts"), height).withColumnRenamed("place", "block")
    blocks = tiers[0].select("tree", "block", "nodes").join(proofs, ["tree", "block"]).join(above.select("tree", "subroot", "top"), "tree")
    # As text: pandas would make a column of longs with a null one of doubles.
    rows = leaves.withColumns({"block": F.shiftright("place", height), "doc_id": F.col("doc_id").cast("string")})
    out = rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(
        _prover(height), "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return out.withColumns({"doc_id": F.col("doc_id").cast("long"), "verified": F.col("folded_root") == F.col("root")})
