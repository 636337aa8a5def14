r"""Merkle manifest of a dataset: a postorder append log, and proofs read from it.

Every row is a leaf: SHA-256 over its columns, each as ``-`` if null and
otherwise as its UTF-8 byte count, ``:`` and its value.  The leaves of one
group (a language, say) ascend by id and make one tree: every two
consecutive nodes, the last alone if their number is odd, become the hash
of their hex digests, until one is left.  These subroots, ordered by group,
make the top tree in the same way.

A tree's log holds its nodes in completion order: a node is written once
its last leaf is there, so what is written never changes while leaves are
appended at the end.  No pointers are kept, for places follow from subtree
sizes: before leaf ``e`` stand the nodes of the full subtrees over the
leaves before it, ``2e - popcount(e)`` of them, so node ``j`` of height
``h``, whose last leaf is ``e``, stands at ``2e - popcount(e) + h``
(`position`).

Builders are aligned: a task gets the ``2**HEIGHT`` leaves of one block and
writes the block's part of the log.  The block roots are the leaves of the
next tier, until each tree is one block.  A proof is read the same way: the
siblings of a leaf within its block are addressed in the block's own log,
and those above are the proof of the block's root in the next tier, found
once a block.  A group of any size is spread over its blocks; the order of
leaves comes from a range-partitioned rank, never from one task.

Defined results: a null id comes before all others; rows of one id are
ordered by their digest, and repeated rows are leaves of their own; a null
group is a group, before all others; an empty text is a value of no bytes;
a tree of one leaf has that leaf as its subroot; an empty table has no
leaves, and its root is null.  Other columns play no part, whatever their
names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import global_row_number
from ..session import materialize
from .common import broadcast_if_small

#: A builder makes subtrees of this height: blocks of 1,024 leaves.
HEIGHT = 10
_HEX = 64

_TEXTS = T.ArrayType(T.StringType())
_PROOFS = T.ArrayType(T.StructType([T.StructField("proof", T.StringType()), T.StructField("folded", T.StringType())]))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 over the columns, each with its byte count, ``-`` for null."""
    def coded(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[coded(c) for c in columns]), 256)


def position(height, index, n_leaves):
    """Place, from 0, of node ``index`` of ``height`` in the log of a tree of ``n_leaves`` leaves."""
    last = np.minimum((np.asarray(index, np.int64) + 1) << np.int64(height), n_leaves) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + height


def tree_height(n_leaves: int) -> int:
    return int(n_leaves - 1).bit_length()


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def build_log(leaves: Sequence[str], height: int) -> list[str]:
    """Digests of a block in completion order: its leaves and the nodes over them up to ``height``."""
    log, open_ = [], [None] * (height + 1)  # a node of each height that waits for its right sibling
    last = len(leaves) - 1
    for i, node in enumerate(leaves):
        log.append(node)
        for h in range(height):
            left, open_[h] = open_[h], None
            if left is not None:
                node = _hash(left, node)
            elif i == last:
                node = _hash(node)
            else:
                open_[h] = node
                break
            log.append(node)
    return log


@functools.lru_cache(maxsize=16)
def _sibling_places(n: int, height: int) -> list[list[tuple[str, int]]]:
    """Of each of ``n`` leaves, its siblings' sides and places in the block's log, from below."""
    leaf = np.arange(n)
    columns = []
    for h in range(height):
        j = leaf >> h
        there = (j ^ 1) << h < n
        columns.append(zip(np.where(j & 1, "L", np.where(there, "R", "N")).tolist(),
                           np.where(there, position(h, j ^ 1, n), -1).tolist()))
    return [list(x) for x in zip(*columns)] if columns else [[] for _ in range(n)]


def sibling_steps(log: Sequence[str], n: int, height: int, i: int) -> list[str]:
    """Leaf ``i``'s siblings in a block's log, from below: ``L`` or ``R`` and a digest, ``N`` for none."""
    return [side if side == "N" else side + log[at] for side, at in _sibling_places(n, height)[i]]


def split_steps(path: str) -> list[str]:
    steps, at = [], 0
    while at < len(path):
        size = 1 if path[at] == "N" else 1 + _HEX
        steps.append(path[at:at + size])
        at += size
    return steps


def fold(leaf: str, steps: Sequence[str]) -> str:
    """The root that ``leaf`` and its siblings lead to."""
    node = leaf
    for s in steps:
        node = _hash(node) if s == "N" else _hash(s[1:], node) if s[0] == "L" else _hash(node, s[1:])
    return node


def _siblings(steps: Sequence[str]) -> list[str]:
    return [s[1:] for s in steps if s != "N"]


@F.pandas_udf(_TEXTS)
def _logs(leaves: pd.Series, height: pd.Series) -> pd.Series:
    return pd.Series([build_log(x, h) for x, h in zip(leaves, height)])


def _blocks(leaves: DataFrame, name: str) -> DataFrame:
    """Aligned blocks of (tree, idx, n, digest, carry): grouped by place, at most 2**HEIGHT leaves each."""
    grouped = leaves.groupBy("tree", F.shiftright("idx", HEIGHT).alias("block"), "n").agg(
        F.array_sort(F.collect_list(F.struct("idx", "digest", "carry"))).alias("leaves"))
    lone = F.when(F.col("n") == 1, 0).when(F.col("n") <= 1 << HEIGHT, F.length(F.bin(F.col("n") - 1)))
    return materialize(grouped.withColumn("height", F.coalesce(lone, F.lit(HEIGHT)))
                       .withColumn("log", _logs(F.col("leaves.digest"), F.col("height"))), name)


def build(leaves: DataFrame) -> list[DataFrame]:
    """The log's tiers over (tree, idx, n, digest, carry): leaf ``idx`` from 0 of ``n`` of each tree.

    A tier is a stored table (tree, block, n, leaves, height, log) of blocks:
    ``log`` is a block's part in completion order, ``leaves`` holds idx,
    digest and carry (anything kept with a leaf) in order.
    """
    tiers = []
    while True:
        blocks = _blocks(leaves, f"log-tier-{len(tiers)}")
        tiers.append(blocks)
        more = blocks.where(F.col("n") > 1 << HEIGHT)
        if more.isEmpty():
            return tiers
        # the block roots, of a number known from n, are the leaves of the next tier
        leaves = more.select("tree", F.col("block").alias("idx"),
                             F.ceil(F.col("n") / (1 << HEIGHT)).cast("long").alias("n"),
                             F.element_at("log", -1).alias("digest"), F.lit(None).cast("string").alias("carry"))


def _ends(tier: DataFrame) -> DataFrame:
    """The blocks of a tier that are a whole tree: their root is the tree's."""
    return tier.where(F.col("n") <= 1 << HEIGHT)


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest): the root of every tree."""
    each = [_ends(t).select("tree", F.element_at("log", -1).alias("digest")) for t in tiers]
    return functools.reduce(DataFrame.unionByName, each)


def _log_places(tier: int):
    def places(block: pd.Series, count: pd.Series, height: pd.Series, size: pd.Series) -> pd.Series:
        rows = []
        for b, n, top, total in zip(block, count, height, size):
            at = np.empty(position(top, 0, n) + 1, np.int64)
            for h in range(top + 1):
                j = np.arange(-(-n // (1 << h)))
                # the leaves of a higher tier are the block roots of the one below, which holds them
                at[position(h, j, n)] = -1 if tier and not h else position(
                    tier * HEIGHT + h, (b << (HEIGHT - h)) + j, total)
            rows.append(at)
        return pd.Series(rows)
    return F.pandas_udf(places, T.ArrayType(T.LongType()))


def log_nodes(tiers: list[DataFrame]) -> DataFrame:
    """(tree, position, digest): every tree's log, numbered from 0 in completion order."""
    sizes = tiers[0].groupBy(F.col("tree").alias("tree_")).agg(F.max("n").alias("size"))
    out = []
    for k, tier in enumerate(tiers):
        numbered = tier.join(sizes, F.col("tree").eqNullSafe(F.col("tree_"))).withColumn(
            "at", _log_places(k)("block", F.size("leaves"), "height", "size"))
        each = numbered.select("tree", F.explode(F.arrays_zip("at", "log")).alias("node")).where("node.at >= 0")
        out.append(each.select("tree", F.col("node.at").alias("position"), F.col("node.log").alias("digest")))
    return functools.reduce(DataFrame.unionByName, out)


@F.pandas_udf(_TEXTS)
def _paths(log: pd.Series, n: pd.Series, height: pd.Series, above: pd.Series) -> pd.Series:
    """Path of each leaf of a block: its steps within, then those of the block's root."""
    return pd.Series([["".join(sibling_steps(g, m, h, i)) + up for i in range(m)]
                      for g, m, h, up in zip(log, n, height, above)])


def _met(blocks: DataFrame, paths: DataFrame, *keys: str) -> DataFrame:
    """``blocks`` with ``up``, the path of the rows of ``paths`` with equal keys (null equals null)."""
    named = paths.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("path").alias("up"))
    on = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    return blocks.join(broadcast_if_small(named, 64), on)


def block_paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Stored (tree, block, path): of each block of the first tier, the steps from its root up.

    ``above`` (tree, path) holds what follows each tree's own root.
    """
    down = None
    for tier in reversed(tiers):
        here = _met(_ends(tier), above, "tree").select("tree", "block", F.col("up").alias("path"))
        paths = materialize(here if down is None else here.unionByName(down), "block-paths")
        found = _met(tier, paths, "tree", "block").select(
            "tree", F.col("leaves.idx").alias("block"), _paths("log", F.size("leaves"), "height", "up").alias("path"))
        down = found.select("tree", F.explode(F.arrays_zip("block", "path")).alias("x")).select("tree", "x.block", "x.path")
    return paths


def _indexed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add idx (from 0) and n within each tree."""
    ranked = global_row_number(rows, ["tree", *order], out="rn")
    per = materialize(ranked.groupBy(F.col("tree").alias("tree_")).agg(F.min("rn").alias("first"),
                                                                       F.count("*").alias("n")), "tree-sizes")
    return ranked.join(broadcast_if_small(per, 64), F.col("tree").eqNullSafe(F.col("tree_"))).withColumn(
        "idx", F.col("rn") - F.col("first"))


@dataclass
class Manifest:
    """Tiers of the group trees (carry: id and what else came) and of the top tree over the subroots (carry: group)."""
    groups: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame     # stored (tree, digest)
    root: str | None


_LEAF = ["tree", "idx", "n", "digest", "carry"]


def manifest(rows: DataFrame) -> Manifest:
    """Build both logs over (tree, id, digest, carry); ``carry`` is kept with its leaf."""
    # equal rows are told apart by a number that is stored with them before they are sorted
    leaves = _indexed(rows.withColumn("at", F.monotonically_increasing_id()), ["id", "digest", "at"])
    groups = build(leaves.withColumn("carry", F.struct("id", "carry")).select(*_LEAF))
    subroots = materialize(roots(groups), "subroots")
    named = subroots.select(F.lit("all").alias("tree"), "digest", F.col("tree").alias("carry"))
    top = build(_indexed(named, ["carry"]).select(*_LEAF))
    root = roots(top).first()
    return Manifest(groups, top, subroots, root["digest"] if root else None)


def subroot_paths(m: Manifest) -> DataFrame:
    """Stored (tree, path): the steps from each subroot to the root."""
    above = m.subroots.sparkSession.createDataFrame([("all", "")], "tree string, path string")
    found = _met(m.top[0], block_paths(m.top, above), "tree", "block").select(
        F.col("leaves.carry").alias("tree"), _paths("log", F.size("leaves"), "height", "up").alias("path"))
    return materialize(found.select(F.explode(F.arrays_zip("tree", "path")).alias("x")).select("x.tree", "x.path"),
                       "subroot-paths")


@F.pandas_udf(_PROOFS)
def _proofs(log: pd.Series, height: pd.Series, above: pd.Series, tried: pd.Series) -> pd.Series:
    """Of each leaf of a block: the digest of its siblings, and the root that ``tried`` folds to."""
    out = []
    for g, h, up, leaves in zip(log, height, above, tried):
        shared = split_steps(up)
        tail = "".join(_siblings(shared))
        rows = []
        for i, leaf in enumerate(leaves):
            own = sibling_steps(g, len(leaves), h, i)
            rows.append({"proof": _hash("".join(_siblings(own)) + tail), "folded": fold(leaf, own + shared)})
        out.append(rows)
    return pd.Series(out)


def prove(m: Manifest) -> DataFrame:
    """(tree, id, leaf, subroot, proof_sha256, folded_root) of every leaf.

    A leaf's ``carry``, if any, is the digest to fold in its place (of a
    row that was changed, say); without one the leaf itself is folded.
    """
    kept = F.transform("leaves", lambda x: F.struct(
        x["digest"].alias("leaf"), x["carry"]["id"].alias("id"),
        F.coalesce(x["carry"]["carry"], x["digest"]).alias("tried")))
    rows = _met(m.groups[0], block_paths(m.groups, subroot_paths(m)), "tree", "block").select(
        "tree", "log", "height", "up", kept.alias("rows"))
    made = rows.select("tree", "rows", _proofs("log", "height", "up", F.col("rows.tried")).alias("p"))
    sub = m.subroots.select(F.col("tree").alias("tree_"), F.col("digest").alias("subroot"))
    out = made.join(broadcast_if_small(sub, 64), F.col("tree").eqNullSafe(F.col("tree_"))).select(
        "tree", "subroot", F.explode(F.arrays_zip("rows", "p")).alias("x"))
    return out.select("tree", "x.rows.id", "x.rows.leaf", "subroot", F.col("x.p.proof").alias("proof_sha256"),
                      F.col("x.p.folded").alias("folded_root"))


def audit(docs: DataFrame, changed: Column, doc_id: str = "doc_id", source: str = "source", lang: str = "lang",
          n_chars: str = "n_chars", text: str = "text") -> DataFrame:
    """Manifest and proofs of documents, checked against rows of which some were tampered with.

    ``changed`` tells, over column ``doc_id``, the rows whose ``n_chars`` is
    one more than when the manifest was made.  Returns doc_id, leaf, subroot,
    root, proof_sha256, folded_root (from the row as it is now and the
    original siblings) and verified (whether that is the root).
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"),
                        F.col(lang).alias("lang"), F.col(n_chars).alias("n_chars"), F.col(text).alias("text"))
    digest = lambda n: leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")])
    tampered = F.when(F.coalesce(changed, F.lit(False)) & F.col("n_chars").isNotNull(), digest(F.col("n_chars") + 1))
    m = manifest(named.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"),
                              digest(F.col("n_chars")).alias("digest"), tampered.alias("carry")))
    root = F.lit(m.root).cast("string")
    return prove(m).select(F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256",
                           "folded_root", (F.col("folded_root") == root).alias("verified"))
