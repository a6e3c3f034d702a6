"""Hard negatives for embedding training: near misses of each anchor, in a window per positive.

For an anchor, its positives are the best scored other rows of its label. A positive with
score p admits the rows of other labels whose score lies between ``low`` and ``high`` hundredths
of p; of these the best ``negatives`` are wanted for each positive. The windows of one anchor
overlap, so they are not searched one by one: the positives' upper limits, in falling order,
cut the scores into disjoint slots. A task keeps only the best few rows of each slot, Spark
merges these per slot, and a walk from the lowest slot up holds the best rows of every
suffix of slots, which is the answer for the positive whose limit opens the suffix, down to
its lower limit.

Anchors are dealt to blocks of at most ``BLOCK_BYTES`` by a running number. A block is
collected, sent to all tasks as it is bounded, and all rows are read past it, where they
lie, once for the positives and once for the slots; the blocks follow one another, and what
each finds is written before the next. So rows are never shuffled, nothing is
paired but a block with a batch, and a task holds a block, a batch of rows and what it keeps.

Scores are inner products of whole numbers, ``floor(scale * x)`` for each component x, and
are exact: products are taken in single or double precision only where no sum can leave
the whole numbers these hold, else in Python's integers.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part. Higher scores come first, ties by the smaller id. "Other" rows are those with
another id; rows repeating an id are rows of their own, and an anchor repeated has its
results repeated. Vectors of different length never meet. Without positives, or with none
whose window holds a row (a negative score's window is empty), an anchor has no rows. Only
the named columns are read. A score beyond a BIGINT fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored

BLOCK_BYTES = 16 << 20  # of anchors' components, as sent to the tasks
BATCH_ROWS = 4096
ANCHORS_AT_ONCE = 256  # whose scores with a batch a task holds
TASKS_PER_CORE = 4  # each task returns its best rows of every slot, so tasks are long rather than many
FOUND = "anchor bigint, slot int, id bigint, score bigint"
RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
)


@dataclass(frozen=True)
class Rule:
    """How many positives and negatives, and the window in hundredths of the positive's score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256


@dataclass
class Vectors:
    """Ids, labels and whole-numbered components of rows of one length."""

    ids: np.ndarray
    labels: np.ndarray
    parts: np.ndarray  # int64, or Python integers where these are larger


def _whole(vectors: pa.Array, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the vectors, and floor(scale * x) of all their components in one array."""
    lengths = np.asarray(pc.list_value_length(vectors))
    scaled = np.floor(np.asarray(vectors.flatten(), dtype=np.float64) * rule.scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        return lengths, np.array([int(x) for x in scaled], dtype=object)
    return lengths, scaled.astype(np.int64)


def by_length(ids: pa.Array, labels: pa.Array, vectors: pa.Array, rule: Rule) -> dict[int, Vectors]:
    """Rows by the length of their vector, ascending by id within."""
    lengths, parts = _whole(vectors, rule)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    ids, labels = np.asarray(ids), np.asarray(labels)
    out = {}
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        own = own[np.argsort(ids[own], kind="stable")]
        places = starts[own][:, None] + np.arange(n)[None, :]
        out[int(n)] = Vectors(ids[own], labels[own], parts[places])
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products, exactly."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), dtype=np.int64)
    # By Cauchy and Schwarz no partial sum of products is larger than this.
    norms = [max(float((m.astype(np.float64) ** 2).sum(axis=1).max()), 0.0) ** 0.5 for m in (left, right)]
    bound = norms[0] * norms[1] * 1.001
    for kind, limit in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if bound < limit:
            return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)
    return left.astype(object) @ right.astype(object).T


def best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by the smaller id, best first."""
    if len(ids) > 4 * n:  # leave out what is below the n-th score, then sort the rest
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        return near[best_order(ids[near], scores[near])[:n]]
    return best_order(ids, scores)[:n]


def best_order(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[by_id], kind="stable")]


class Kept:
    """The best rows of one anchor's slots so far."""

    __slots__ = ("n", "ids", "scores")

    def __init__(self, n: int, slots: int):
        self.n = n
        self.ids = [np.empty(0, np.int64)] * slots
        self.scores = [np.empty(0, np.int64)] * slots

    def least(self, slot: int):
        """The score that a further row of the slot must reach; None while there is room."""
        return self.scores[slot][-1] if len(self.ids[slot]) == self.n else None

    def add(self, slot: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate((self.ids[slot], ids))
        scores = np.concatenate((self.scores[slot], scores))
        top = best(ids, scores, self.n)
        self.ids[slot], self.scores[slot] = ids[top], scores[top]


def limits(scores: list[int], rule: Rule) -> list[tuple[int, int, int]]:
    """Slots of an anchor, highest first: above which score, up to which, and the least of use.

    ``scores`` are those of its positives, falling. Slot i holds scores of at most the i-th upper
    limit and above the next one; windows that reach into it end at the i-th lower limit at best.
    """
    upper = [rule.high * p // 100 for p in scores]
    lower = [-(-rule.low * p // 100) for p in scores]
    below = [*upper[1:], None]
    return [(b, u, lo) for b, u, lo in zip(below, upper, lower)]


@dataclass
class Block:
    """Anchors of one pass: numbers by length of their vectors, beside them, and their slots."""

    numbers: dict[int, np.ndarray]
    vectors: dict[int, Vectors]
    slots: dict[int, list[tuple[int, int, int]]]  # by anchor number, in the second pass


def _batches(tables: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[dict[int, Vectors]]:
    for table in tables:
        for at in range(0, table.num_rows, BATCH_ROWS):
            part = table.slice(at, BATCH_ROWS)
            yield by_length(part["id"], part["label"], part["vector"], rule)


def _records(kept: dict[int, Kept]) -> Iterator[pa.RecordBatch]:
    for number, own in kept.items():
        for slot, (ids, scores) in enumerate(zip(own.ids, own.scores)):
            if len(ids):
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * n, pa.int64()),
                        pa.array([slot] * n, pa.int32()),
                        pa.array(ids.tolist(), pa.int64()),
                        pa.array(scores.tolist(), pa.int64()),
                    ],
                    ["anchor", "slot", "id", "score"],
                )


def _meetings(block: Block, tables: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[tuple]:
    """A few anchors and a batch at a time, of vectors of one length: (numbers, anchors, rows)."""
    for rows in _batches(tables, rule):
        for length, own in rows.items():
            if length not in block.vectors:
                continue
            whole, numbers = block.vectors[length], block.numbers[length]
            for at in range(0, len(numbers), ANCHORS_AT_ONCE):
                part = slice(at, at + ANCHORS_AT_ONCE)
                yield numbers[part], Vectors(whole.ids[part], whole.labels[part], whole.parts[part]), own


def nearest_alike(block: Block, tables: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The best rows of each anchor's label, among the rows of a task."""
    kept: dict[int, Kept] = {}
    for numbers, anchors, rows in _meetings(block, tables, rule):
        for label in np.intersect1d(anchors.labels, rows.labels):
            left = np.flatnonzero(anchors.labels == label)
            right = np.flatnonzero(rows.labels == label)
            scores = products(anchors.parts[left], rows.parts[right])
            ids = rows.ids[right]
            for i, a in enumerate(left):
                mine = kept.setdefault(int(numbers[a]), Kept(rule.positives, 1))
                least = mine.least(0)
                useful = ids != anchors.ids[a]
                if least is not None:
                    useful &= scores[i] >= least
                mine.add(0, ids[useful], scores[i][useful])
    yield from _records(kept)


def slot_members(block: Block, tables: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The best rows of other labels in each slot of each anchor, among the rows of a task."""
    kept: dict[int, Kept] = {}
    for numbers, anchors, rows in _meetings(block, tables, rule):
        scores = products(anchors.parts, rows.parts)
        for a, number in enumerate(numbers.tolist()):
            slots = block.slots.get(number, [])
            mine = kept.setdefault(number, Kept(rule.negatives, len(slots)))
            useful = np.flatnonzero((rows.labels != anchors.labels[a]) & (rows.ids != anchors.ids[a]))
            near, ids = scores[a][useful], rows.ids[useful]
            for slot, (below, upper, lower) in enumerate(slots):
                least = mine.least(slot)
                inside = (near <= upper) & (near >= (lower if least is None else max(lower, least)))
                if below is not None:
                    inside &= near > below
                found = np.flatnonzero(inside)
                if len(found):
                    mine.add(slot, ids[found], near[found])
    yield from _records(kept)


def usable(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part; ``vector`` is an array of floats or doubles."""
    named = rows.select(vec_id.cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def _block(rows: list, rule: Rule, slots: dict) -> Block:
    """Anchors as arrays; ``rows`` are (anchor, id, label, vector)."""
    out = Block({}, {}, slots)
    for length in {len(r["vector"]) for r in rows}:
        own = sorted((r for r in rows if len(r["vector"]) == length), key=lambda r: (r["id"], r["anchor"]))
        column = pa.array([r["vector"] for r in own], pa.list_(pa.float64()))
        found = by_length(pa.array([r["id"] for r in own]), pa.array([r["label"] for r in own]), column, rule)
        out.vectors[length] = found[length]
        out.numbers[length] = np.array([r["anchor"] for r in own])
    return out


def _numbered(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with a running number and their block, and how many blocks there are."""
    numbers = anchors.agg(F.sum(F.size("vector") + 4)).first()[0] or 0
    blocks = max(1, -(-8 * numbers // BLOCK_BYTES))
    marked = anchors.withColumn("anchor", F.monotonically_increasing_id())
    return stored(marked.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks))), "anchors"), blocks


def _top(found: DataFrame, n: int) -> DataFrame:
    """The best ``n`` rows of each slot of each anchor, with their rank."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, anchors: Column, rule: Rule = Rule()) -> DataFrame:
    """Of the ``usable`` rows, the negatives of each (anchor, positive), by rank.

    ``anchors`` says which rows are anchors.
    """
    numbered, blocks = _numbered(rows.filter(anchors))
    spark = rows.sparkSession
    rows = rows.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    parts = []
    for b in range(blocks):
        mine = numbered.filter(F.col("block") == b)
        collected = mine.select("anchor", "id", "label", "vector").collect()  # BLOCK_BYTES, near enough
        if not collected:
            continue
        shared = spark.sparkContext.broadcast(_block(collected, rule, {}))
        alike = rows.mapInArrow(lambda tables, s=shared: nearest_alike(s.value, tables, rule), FOUND)
        positives = stored(_top(alike, rule.positives), "positives")
        scores: dict[int, list[int]] = {}
        for r in positives.collect():  # a few per anchor of the block
            scores.setdefault(r["anchor"], []).append(r["score"])
        slots = {a: limits(sorted(s, reverse=True), rule) for a, s in scores.items()}
        shared.unpersist()
        shared = spark.sparkContext.broadcast(_block(collected, rule, slots))
        members = rows.mapInArrow(lambda tables, s=shared: slot_members(s.value, tables, rule), FOUND)
        members = stored(_top(members, rule.negatives), "slots")
        shared.unpersist()
        parts.append(_answers(mine.select("anchor", F.col("id").alias("anchor_id")), positives, members, rule))
    if not parts:
        return spark.createDataFrame([], RESULT)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _answers(anchors: DataFrame, positives: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Suffix merges: per anchor, from the lowest slot up, what each positive's window holds."""
    row = F.struct((-F.col("score")).alias("worse"), "id", "slot")
    slots = members.groupBy("anchor").agg(F.array_sort(F.collect_list(row)).alias("members"))  # n per slot
    found = positives.join(slots, "anchor").join(anchors, "anchor")
    # The slots do not overlap, so in falling order a suffix of them is what has a higher number.
    suffix = F.filter("members", lambda m: m["slot"] >= F.col("rank") - 1)
    lower = F.ceil(F.col("score") * rule.low / F.lit(100).cast("decimal(3,0)"))
    window = F.slice(F.filter(suffix, lambda m: -m["worse"] >= lower), 1, rule.negatives)
    return found.select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(window)
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("col.id").alias("negative_id"),
        "positive_score",
        (-F.col("col.worse")).alias("negative_score"),
    )
