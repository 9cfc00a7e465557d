"""Parent-child links to full hierarchies.

Every node has at most one parent. Ancestors are reached by pointer doubling: after round k a node points 2^k steps up,
so a chain of depth d takes log2(d) rounds and no recursion. Trees that fit into a task are then numbered in one pass each:
subtree sizes upward, sibling ranges downward by prefix sums. Larger trees do the same over the doubled pointers, spread
over all tasks. (root, preorder, size) is a nested-set numbering. Nodes that no round finishes lie on a cycle or lead into
one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..runtime import Scratch, broadcast_if_small, spread

#: Nodes of a tree that one task may number; larger trees are numbered in rounds.
TREE_ROWS = 100_000
#: Children of one parent that a single window task may order; larger families are numbered in blocks.
FAMILY_BLOCK = 100_000
#: Preorder numbers unfolded from one range at a time.
RANGE_STEP = 10_000


@dataclass
class Ascent:
    """Result of climb(). `ends`: id, root_id, depth. `steps[k]`: id, ptr = the ancestor 2^k steps up, for nodes of
    finite depth that have one. `loops`: id, root_id (smallest id on the loop reached)."""

    base: DataFrame
    ends: DataFrame
    steps: list[DataFrame]
    loops: DataFrame | None
    scratch: Scratch


def links(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """One row per id: id, parent_raw, parent (null if there is none or it is not in the table).

    Rows with null id are no nodes. If an id occurs with several parents, the greatest counts; repeated rows count once.
    """
    nodes = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(parent_col).cast("long")).alias("parent_raw"))
    known = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("parent")).distinct()
    return nodes.join(known, nodes.parent_raw == known.parent, "left").select("id", "parent_raw", "parent")


def climb(df: DataFrame, id_col: str, parent_col: str) -> Ascent:
    """Root and depth of every node by pointer doubling. A row whose parent is missing is a root. An empty table gives
    empty results. A round is one job: what is left over is counted while it is written."""
    scratch = Scratch(df.sparkSession)
    base = scratch.keep(links(df, id_col, parent_col))
    open_ = F.col("ptr").isNotNull()
    now, left = scratch.counted(base.select("id", F.col("parent").alias("ptr"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("dist"), F.when(F.col("parent").isNull(), F.col("id")).alias("root_id")), open_)
    finished, active, steps = now.where(~open_), now.where(open_), []
    stuck, n_stuck = None, 0
    while left:
        steps.append((active.select("id", "ptr"), left))
        there = finished.unionByName(active).select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"), F.col("root_id").alias("root2"))
        before = left
        now, left = scratch.counted(active.drop("root_id").join(there, "ptr").select("id", F.col("ptr2").alias("ptr"), (F.col("dist") + F.col("dist2")).alias("dist"), F.col("root2").alias("root_id")), open_)
        finished, active = finished.unionByName(now.where(~open_)), now.where(open_)
        if left == before:  # depths are without gaps: a round that finishes nobody leaves only loops
            stuck, n_stuck = active.select("id", "ptr"), left
            break
    ends = finished.select("id", "root_id", F.col("dist").alias("depth"))
    finite = [s for s, n in steps if n > n_stuck]  # who never ends is active in every round
    if stuck is None:
        return Ascent(base, ends, finite, None, scratch)
    lost = broadcast_if_small(scratch.keep(stuck.select("id")))
    return Ascent(base, ends, [s.join(lost, "id", "left_anti") for s in finite], _loops(base, stuck, scratch), scratch)


def _loops(base: DataFrame, stuck: DataFrame, scratch: Scratch) -> DataFrame:
    """For nodes that never reach a root: the smallest id on the loop they reach."""
    image = stuck.select("ptr").distinct().count()
    while True:  # the image of the 2^k-th step shrinks until it is exactly the nodes on loops
        there = stuck.select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"))
        stuck = scratch.keep(stuck.join(there, "ptr").select("id", F.col("ptr2").alias("ptr")))
        before, image = image, stuck.select("ptr").distinct().count()
        if image == before:
            break
    on = stuck.select(F.col("ptr").alias("id")).distinct()
    ring = scratch.keep(base.join(on, "id").select("id", F.col("parent").alias("ptr"), F.col("id").alias("least")))
    while True:
        there = ring.select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("least").alias("least2"))
        after, fell = scratch.counted(ring.join(there, "ptr").select("id", F.col("ptr2").alias("ptr"), F.least("least", "least2").alias("least"), (F.col("least2") < F.col("least")).alias("fell")), F.col("fell"))
        ring = after.drop("fell")
        if not fell:
            break
    return stuck.join(ring.select(F.col("id").alias("ptr"), F.col("least").alias("root_id")), "ptr").select("id", "root_id")


def roots_and_depths(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """id, root_id, depth of every node; depth -1 and the smallest id of the loop where no root is reached."""
    up = climb(df, id_col, parent_col)
    return up.ends if up.loops is None else up.ends.unionByName(up.loops.withColumn("depth", F.lit(-1).cast("long")))


_NUMBERED = "id long, parent long, root_id long, depth long, lo long, hi long, n_descendants long, path array<long>"


def _numbered(with_path: bool):
    """Whole trees, sorted by root, depth and id, to their numbering; one tree is held at a time."""

    def tree(rows: list[tuple[int, int | None, int, int]]) -> Iterator[tuple]:
        place = {row[0]: i for i, row in enumerate(rows)}
        above = [-1 if row[3] == 0 else place[row[1]] for row in rows]
        size = [1] * len(rows)
        for i in range(len(rows) - 1, 0, -1):  # upward: children come after their parents
            size[above[i]] += size[i]
        lo, free, paths = [0] * len(rows), [1] * len(rows), [[row[0]] for row in rows] if with_path else None
        for i, (id_, parent, root, depth) in enumerate(rows):  # downward: each child takes the next free range of its parent
            if i:
                lo[i] = free[above[i]]
                free[above[i]] += size[i]
                free[i] = lo[i] + 1
                if with_path:
                    paths[i] = paths[above[i]] + paths[i]
            yield id_, parent, root, depth, lo[i], lo[i] + size[i] - 1, size[i] - 1, paths[i] if with_path else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        made: list = []
        frame = lambda rows: pd.DataFrame(rows, columns=[c.split()[0] for c in _NUMBERED.split(", ")]).astype({"parent": "Int64"})
        for pdf in batches:
            for row in zip(pdf["id"].tolist(), pdf["parent"].astype("Int64").tolist(), pdf["root_id"].tolist(), pdf["depth"].tolist()):
                if held and held[0][2] != row[2]:
                    made.extend(tree(held))
                    held.clear()
                    if len(made) >= 10_000:
                        yield frame(made)
                        made = []
                held.append(row)
        if held:
            made.extend(tree(held))
        yield frame(made)

    return run


def nested_sets(df: DataFrame, id_col: str, parent_col: str, path: bool = True, tree_rows: int = TREE_ROWS) -> DataFrame:
    """id, parent, root_id, depth, lo, hi, n_descendants and, if asked for, path (ids from the root to the node).

    Within a root, lo is the preorder number from 0 and the descendants of a node are exactly the nodes with
    lo < number <= hi. Nodes on or behind a loop come out with depth -1 and null lo, hi, n_descendants and path.
    """
    up = climb(df, id_col, parent_col)
    placed = up.scratch.keep(up.base.join(up.ends, "id").select("id", "parent", "root_id", "depth"))
    large, n_large = up.scratch.counted(placed.groupBy("root_id").agg(F.count("*").alias("n")).where(F.col("n") > tree_rows).select("root_id"), F.lit(True))
    large = broadcast_if_small(large)
    small = placed.join(large, "root_id", "left_anti") if n_large else placed
    out = spread(small, "root_id").sortWithinPartitions("root_id", "depth", "id").select("id", "parent", "root_id", "depth").mapInPandas(_numbered(path), _NUMBERED)
    if n_large:
        out = out.unionByName(_in_rounds(up, placed.join(large, "root_id", "left_semi"), path))
    if up.loops is not None:
        none = {"lo": "long", "hi": "long", "n_descendants": "long", "path": T.ArrayType(T.LongType())}
        lost = up.loops.join(up.base, "id").select("id", "parent", "root_id", F.lit(-1).cast("long").alias("depth"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
        out = out.unionByName(lost)
    return out if path else out.drop("path")


def _in_rounds(up: Ascent, placed: DataFrame, path: bool) -> DataFrame:
    """The numbering of large trees, whose nodes are `placed`, over the pointers of the climb."""
    keep = up.scratch.keep
    steps = [step.join(placed.select("id"), "id", "left_semi") for step in up.steps]
    size = keep(placed.select("id", F.lit(1).cast("long").alias("size")))
    for step in steps:  # those exactly 2^k steps below bring what they have gathered within 2^k steps
        more = step.join(size, "id").groupBy(F.col("ptr").alias("id")).agg(F.sum("size").alias("more"))
        size = keep(size.join(more, "id", "left").select("id", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    members = keep(placed.join(size, "id").select("id", "parent", "root_id", "depth", "size"))
    children = members.where("parent is not null")
    family = children.groupBy("parent").agg(F.ceil(F.count("*") / F.lit(FAMILY_BLOCK)).alias("blocks"))
    children = children.join(family, "parent").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    blocks = children.groupBy("parent", "block").agg(F.sum("size").alias("block_size"))
    earlier = W.Window.partitionBy("parent").orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1)
    blocks = blocks.select("parent", "block", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("start"))
    before = W.Window.partitionBy("parent", "block").orderBy("id").rowsBetween(W.Window.unboundedPreceding, -1)
    offset = children.select("id", "parent", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("within")).join(blocks, ["parent", "block"])
    offset = offset.select("id", "parent", (F.col("start") + F.col("within") + 1).alias("lo"))
    whole = members.select("id", "parent").join(offset.select("id", "lo"), "id", "left")
    now = keep(whole.select("id", F.col("parent").alias("ptr"), F.coalesce("lo", F.lit(0)).cast("long").alias("lo"), F.array("id").alias("path")))
    done, active = now.where("ptr is null"), now.where("ptr is not null")
    for _ in steps:  # as many rounds as the climb took
        there = done.unionByName(active).select(F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("lo").alias("lo2"), F.col("path").alias("path2"))
        now = keep(active.join(there, "ptr").select("id", F.col("ptr2").alias("ptr"), (F.col("lo") + F.col("lo2")).alias("lo"), (F.concat("path2", "path") if path else F.array("id")).alias("path")))
        done, active = done.unionByName(now.where("ptr is null")), now.where("ptr is not null")
    return members.join(done.select("id", "lo", "path"), "id").select("id", "parent", "root_id", "depth", "lo", (F.col("lo") + F.col("size") - 1).alias("hi"), (F.col("size") - 1).alias("n_descendants"), "path")


def descendants(sets: DataFrame) -> DataFrame:
    """ancestor_id, descendant_id for every node of nested_sets(): each range is unfolded and met by (root, number), so
    the work is the size of the result and no range join is needed. Long ranges are unfolded in pieces."""
    wide = sets.where("hi > lo").select(F.col("id").alias("ancestor_id"), "root_id", "hi", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"), F.lit(RANGE_STEP).cast("long"))).alias("at"))
    numbers = wide.select("ancestor_id", "root_id", F.explode(F.sequence("at", F.least("hi", F.col("at") + RANGE_STEP - 1))).alias("lo"))
    return numbers.join(sets.where("lo is not null").select("root_id", "lo", F.col("id").alias("descendant_id")), ["root_id", "lo"]).select("ancestor_id", "descendant_id")
