"""Merkle dataset manifest with incremental witnesses.

Every row is a leaf; the leaves of a tree (a value of one column) ascend by an
order column and are numbered by a range sort, so no tree, however large, sits
in one task. A block is an aligned run of ``2 ** LEVELS`` leaves. Inside it,
leaves are appended one after the other to a stack of open subtrees; every
leaf of an open subtree carries the witness of its level, and when a sibling
subtree completes, the witnesses on both sides are extended by the other's
digest. The roots of the blocks are the leaves of the next round of blocks,
and their witnesses extend those of all rows below them. The roots of the
trees are appended to one more tree in the same way.

While a level has more than one node, every two neighbours become the digest
of their concatenated hexadecimal digests; a last single one becomes the
digest of itself alone.

Defined results: nulls are part of a leaf (see ``leaf_digest``); a null tree
value is a tree of its own and comes first; null order values come first, and
rows of equal order value ascend by their leaf; repeated rows are leaves of
their own; a tree of one leaf has that leaf as its root and an empty witness;
texts of any length are hashed whole; an empty table gives no rows. ``keep``
columns that are named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandops.llm.common import cut, global_rank, release

LEVELS = 8               #: a block holds 2^8 leaves
#: Rows (at most some 2 kB each: digests of one path) of a block table that is
#: broadcast to the rows below it; beyond it the join shuffles.
BROADCAST_BLOCKS = 10_000

RESULTS = ("leaf", "position", "siblings", "tree_position", "tree_siblings", "subroot", "root")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class OpenSubtrees:
    """Streaming aligned append: the open subtrees (level, digest, first leaf,
    leaf after the last), largest first, and the witness of every leaf so far:
    the sibling of each level, None where a node had none."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int, int]] = []
        self.witness: list[list[str | None]] = []

    def append(self, leaf: str) -> None:
        n = len(self.witness)
        self.witness.append([])
        self.open.append((0, leaf, n, n + 1))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._complete()

    def _complete(self) -> None:
        """The last two subtrees are siblings: both sides' witnesses grow."""
        level, right, middle, end = self.open.pop()
        _, left, start, _ = self.open.pop()
        for w in self.witness[start:middle]:
            w.append(right)
        for w in self.witness[middle:end]:
            w.append(left)
        self.open.append((level + 1, digest(left + right), start, end))

    def _alone(self) -> None:
        """The last subtree has no sibling on its level."""
        level, node, start, end = self.open.pop()
        for w in self.witness[start:end]:
            w.append(None)
        self.open.append((level + 1, digest(node), start, end))

    def close(self, levels: int | None = None) -> str:
        """The root: of the whole tree, or, if more blocks stand beside this
        one, of the block raised to ``levels``."""
        while len(self.open) > 1 or levels is not None and self.open[0][0] < levels:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._complete()
            else:
                self._alone()
        return self.open[0][1]


def _stream(levels: int):
    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_pos")
        subtrees = OpenSubtrees()
        for leaf in rows["_digest"].to_pylist():
            subtrees.append(leaf)
        alone = rows["_n"][0].as_py() <= 1 << levels
        top = subtrees.close(None if alone else levels)
        return (rows.append_column("_siblings", pa.array(subtrees.witness, pa.list_(pa.string())))
                .append_column("_top", pa.array([top] * rows.num_rows, pa.string())))
    return block


def grow(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (_tree, _pos dense from 0, _digest, any others) with
    _siblings (bottom to top) and _top, the root of the tree."""
    sizes = leaves.groupBy("_tree").agg(F.max("_pos").alias("_n")).withColumn("_n", F.col("_n") + 1)
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    joined = leaves.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_BLOCKS else sizes, "_tree")
    rounds = []
    while True:
        block = F.shiftright("_pos", levels)
        fields = [*joined.schema.fields, T.StructField("_siblings", T.ArrayType(T.StringType())),
                  T.StructField("_top", T.StringType())]
        rounds.append(cut(joined.groupBy("_tree", block.alias("_block")).applyInArrow(
            _stream(levels), T.StructType(fields)), "merkle-blocks"))
        if largest <= 1 << levels:
            break
        # the blocks' roots are the next leaves, of trees that have more than one
        joined = (rounds[-1].filter(F.col("_n") > 1 << levels)
                  .filter(F.col("_pos").bitwiseAND(F.lit((1 << levels) - 1)) == 0)
                  .select("_tree", block.alias("_pos"), F.col("_top").alias("_digest"),
                          F.shiftright(F.col("_n") + ((1 << levels) - 1), levels).alias("_n")))
        largest = -(-largest // (1 << levels))
    above = None
    for now in reversed(rounds):
        if above is not None:
            count = above.count()
            up = above.select("_tree", F.col("_pos").alias("_block"), F.col("_siblings").alias("_more"),
                              F.col("_top").alias("_root"))
            now = (now.withColumn("_block", F.shiftright("_pos", levels))
                   .join(F.broadcast(up) if count <= BROADCAST_BLOCKS else up, ["_tree", "_block"], "left")
                   .withColumn("_siblings", F.when(F.col("_more").isNull(), F.col("_siblings"))
                               .otherwise(F.concat("_siblings", "_more")))
                   .withColumn("_top", F.coalesce("_root", "_top")).drop("_block", "_more", "_root"))
        above = now
    return above.drop("_n")


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns, each its UTF-8 length, a colon and its value,
    or ``-`` for null."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(field, columns)), 256)


def fold(leaf: Column, position: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give: where the position has a
    one, the sibling stands on the left."""
    steps = F.transform(siblings, lambda s, i: F.struct(
        s.alias("digest"), F.call_function("shiftright", position, i).bitwiseAND(F.lit(1)).alias("right")))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(
        F.when(s["digest"].isNull(), node).when(s["right"] == 1, F.concat(s["digest"], node))
        .otherwise(F.concat(node, s["digest"])), 256))


def fold_to_root(leaf: Column) -> Column:
    """``fold`` over a manifest's row: through its tree and the tree of trees."""
    subroot = fold(leaf, F.col("position"), F.col("siblings"))
    return fold(subroot, F.col("tree_position"), F.col("tree_siblings"))


def proof_digest() -> Column:
    """SHA-256 of all siblings of a manifest's row, bottom to top."""
    return F.sha2(F.array_join(F.concat("siblings", "tree_siblings"), ""), 256)


def manifest(rows: DataFrame, leaf: Column, tree: str, order: str, keep: Sequence[str] = (),
             levels: int = LEVELS) -> DataFrame:
    """``keep`` columns of ``rows`` with leaf, position in its tree, siblings,
    tree_position, tree_siblings, subroot and root."""
    t = F.col(f"`{tree}`").cast("string")
    names = {f"_keep{i}": k for i, k in enumerate(keep) if k.lower() not in RESULTS}
    # narrow rows are written first: the range sort samples them, not the texts
    hashed = cut(rows.select(F.coalesce(F.concat(F.lit("="), t), F.lit("")).alias("_tree"),
                             F.col(f"`{order}`").alias("_order"), leaf.alias("_digest"),
                             *[F.col(f"`{k}`").alias(n) for n, k in names.items()]), "leaves")
    ranked = global_rank(hashed, ["_tree", "_order", "_digest"], "_rank", "leaf-ranks")
    first = ranked.groupBy("_tree").agg(F.min("_rank").alias("_first"))
    n_trees = first.count()
    small = n_trees <= BROADCAST_BLOCKS
    placed = (ranked.join(F.broadcast(first) if small else first, "_tree")
              .withColumn("_pos", F.col("_rank") - F.col("_first")).drop("_rank", "_first", "_order"))
    grown = grow(placed, levels)
    subroots = cut(grown.filter("_pos = 0").select("_tree", F.col("_top").alias("_digest")), "subroots")
    trees = global_rank(subroots, ["_tree"], "_pos", "tree-ranks").withColumnRenamed("_tree", "_name")
    top = grow(trees.withColumn("_tree", F.lit("")), levels).select(
        F.col("_name").alias("_tree"), F.col("_pos").alias("tree_position"),
        F.col("_siblings").alias("tree_siblings"), F.col("_top").alias("root"))
    out = grown.join(F.broadcast(top) if small else top, "_tree").select(
        *[F.col(n).alias(k) for n, k in names.items()], F.col("_digest").alias("leaf"),
        F.col("_pos").alias("position"), F.col("_siblings").alias("siblings"), "tree_position",
        "tree_siblings", F.col("_top").alias("subroot"), "root")
    release(hashed)
    return out
