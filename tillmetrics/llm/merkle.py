"""A Merkle manifest of a table, with a witness for every row, by streaming appends.

A node is H of its children: the lower-case hex SHA-256 of their digests' hex text, two
children each, the last node of a level by itself if it has no neighbour. Rows of one group
make one tree; the roots of the groups, in the groups' order, make another, whose root
stands for the table.

Leaves are appended in order to a list of open subtrees. Each open subtree keeps the
witnesses of its leaves as far as they are known: the siblings on the way from the leaf to
the subtree's root. When two neighbours of one height are complete they close to one, and
the witnesses of either side grow by the root of the other. Appends are aligned to blocks of
``2**BLOCK_LEVELS`` leaves, so blocks are streamed apart from each other, each in one
task; the roots of the blocks are then appended to a stream of their own in the same way,
and so on until a group has one root.

Positions come from a range partitioning of the order and the counts of its parts, so a
group with most rows is spread over tasks; no step holds more than a block.

Defined results: rows of a group ascend by its order, nulls first; rows alike in the order
are interchangeable, so that the witnesses of repeated rows are dealt among them. A null
column of a row goes into its leaf as ``-``, a null group is a group, and comes first. A
table without rows has no root and no witnesses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.llm.tables import stored

BLOCK_LEVELS = 12  # a block has 4096 leaves, a few MB with their witnesses
LEFT, RIGHT, NONE = "l", "r", "-"  # where a level's sibling stands
DIGEST_BYTES = 32


def leaf_of(columns: Iterable[Column]) -> Column:
    """The digest of a row: of each value its UTF-8 length, a colon and its text."""
    texts = [c.cast("string") for c in columns]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent(*children: bytes) -> bytes:
    """The digest over the children's hex texts."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


class Witness:
    """Siblings of one leaf, from the bottom up, as far as they are known."""

    __slots__ = ("sides", "siblings")

    def __init__(self) -> None:
        self.sides: list[str] = []
        self.siblings: list[bytes] = []

    def extend(self, side: str, sibling: bytes = b"") -> None:
        self.sides.append(side)
        self.siblings.append(sibling)


class Stream:
    """Leaves appended one by one to open subtrees, their witnesses growing with them."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, list[Witness]]] = []  # heights fall from left to right

    def append(self, digest: bytes) -> Witness:
        witness = Witness()
        self._add(0, digest, [witness])
        return witness

    def _add(self, height: int, digest: bytes, members: list[Witness]) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, left_members = self.open.pop()
            for w in left_members:
                w.extend(RIGHT, digest)
            for w in members:
                w.extend(LEFT, left)
            digest, members, height = parent(left, digest), left_members + members, height + 1
        self.open.append((height, digest, members))

    def finish(self, height: int | None = None) -> bytes:
        """Close what is open, the last nodes by themselves, up to ``height`` or one root."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            level, digest, members = self.open.pop()
            for w in members:
                w.extend(NONE)
            self._add(level + 1, parent(digest), members)
        return self.open[0][1]


def fold(leaf: bytes, sides: str, siblings: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    at = 0
    for side in sides:
        if side == NONE:
            leaf = parent(leaf)
            continue
        other = siblings[at : at + DIGEST_BYTES]
        at += DIGEST_BYTES
        leaf = parent(other, leaf) if side == LEFT else parent(leaf, other)
    return leaf


@F.pandas_udf(T.BinaryType())
def folded(leaves: pd.Series, sides: pd.Series, siblings: pd.Series) -> pd.Series:
    """The root of each row's leaf and witness; null for a null leaf."""
    return pd.Series(
        [None if x is None else fold(x, s, b) for x, s, b in zip(leaves, sides, siblings)], dtype=object
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows (grp, key, digest, row) with their position ``at`` in their group, and its ``size``."""
    # The last key deals rows that are otherwise alike to different parts.
    keys = ["grp", "key", "digest", "tie"]
    numbered = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie", "key")
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("place", 33).alias("part")  # the id's upper bits number the part
    parts = ordered.groupBy("grp", part).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # One row per part and group: at most as many per group as there are parts.
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("grp").alias("in_grp"),
        F.col("part").alias("in_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("grp")).alias("size"),
    )
    same = (part == F.col("in_part")) & F.col("grp").eqNullSafe(F.col("in_grp"))
    return ordered.join(starts, same).select(
        "grp", "digest", "row", (F.col("place") + F.col("shift")).alias("at"), "size"
    )


def _streamed(rows: DataFrame) -> DataFrame:
    """Each row with its block, the block's root, and its witness as far as that."""
    rows = rows.withColumn("block", F.shiftright("at", BLOCK_LEVELS))
    schema = T.StructType(
        rows.schema.fields
        + [T.StructField(c, T.BinaryType()) for c in ("block_root", "siblings")]
        + [T.StructField("sides", T.StringType())]
    )

    def appended(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        stream = Stream()
        found = [stream.append(d) for d in block["digest"].to_pylist()]
        alone = block["size"][0].as_py() <= 1 << BLOCK_LEVELS
        root = stream.finish(None if alone else BLOCK_LEVELS)
        block = block.append_column("block_root", pa.array([root] * len(found), pa.binary()))
        block = block.append_column("siblings", pa.array([b"".join(w.siblings) for w in found], pa.binary()))
        return block.append_column("sides", pa.array(["".join(w.sides) for w in found], pa.string()))

    return stored(rows.groupBy("grp", "block").applyInArrow(appended, schema), "merkle-level")


def _tree(rows: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of blocks over placed rows, and each group's root."""
    levels = []
    while True:
        levels.append(_streamed(rows))
        roots = levels[-1].filter(F.col("at") % (1 << BLOCK_LEVELS) == 0).select(
            "grp",
            F.col("block_root").alias("digest"),
            F.col("block").alias("at"),
            F.ceil(F.col("size") / (1 << BLOCK_LEVELS)).alias("size"),
        )
        if (roots.agg(F.max("size")).first()[0] or 0) <= 1:  # one number
            return levels, roots.select("grp", "digest")
        rows = roots


def _continued(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first level's rows, their witnesses continued by those of ``tops``, one per group."""
    above, same = tops, F.lit(True)
    for level in reversed(levels):
        upper = above.withColumnsRenamed({c: f"upper_{c}" for c in above.columns})
        joined = level.join(upper, F.col("grp").eqNullSafe(F.col("upper_grp")) & same)
        above = joined.select(
            *[c for c in ("grp", "digest", "row", "at") if c in level.columns],
            *[F.concat(c, f"upper_{c}").alias(c) for c in ("sides", "siblings")],
            *[F.col(f"upper_{c}").alias(c) for c in ("subroot", "root")],
        )
        same = F.col("block") == F.col("upper_at")
    return above


def witnesses(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Each row's path to the root of all: (row, digest, subroot, root, sides, siblings).

    ``rows`` have a ``digest`` (the leaf, binary). ``row`` is a struct of their columns,
    ``subroot`` the root of its group. ``sides`` has a letter per level from the leaf to the
    root, ``siblings`` the siblings' digests one after another.
    """
    packed = rows.select(
        F.col(group).alias("grp"), F.struct(*order).alias("key"), "digest", F.struct(*rows.columns).alias("row")
    )
    levels, subroots = _tree(_placed(packed))
    # The groups' roots are appended in their turn, in the order of their names.
    named = subroots.select(
        F.lit(0).alias("grp"), F.struct("grp").alias("key"), "digest", F.struct("grp").alias("row")
    )
    upper_levels, roots = _tree(_placed(named))
    top = roots.select(
        "grp",
        F.lit("").alias("sides"),
        F.lit(b"").alias("siblings"),
        F.lit(None).cast("binary").alias("subroot"),
        F.col("digest").alias("root"),
    )
    tops = _continued(upper_levels, top).select(
        F.col("row.grp").alias("grp"), "sides", "siblings", F.col("digest").alias("subroot"), "root"
    )
    return _continued(levels, tops).select("row", "digest", "subroot", "root", "sides", "siblings")


def verified(path: DataFrame, leaf: Column) -> DataFrame:
    """``path`` with the root that ``leaf`` folds to, and whether that is the root of all."""
    found = path.withColumn("folded_root", folded(leaf, F.col("sides"), F.col("siblings")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))
