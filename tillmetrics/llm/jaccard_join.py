"""Documents whose word n-gram sets are alike, exactly, and the groups they form.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of
distinct word n-grams. No link between different sets is lost:

1.  All n-grams are put in one order: by a hash, those that a sample shows to be frequent
    last. (Any order is right; this one keeps common passages out of the way.) Two linked
    sets share one of the first ``n - ceil(percent * n / 100) + 1`` n-grams of either; these
    are a set's keys. Documents that share a key may link.
2.  Sets that share three neighbouring keys are joined star-wise, each to the least such
    document, never in pairs. Where a key is still shared by several of the groups that
    result, its sets are held against each other across groups: by size, then by the bit
    count of their bitmap signatures, which bounds the overlap from above. What passes
    joins groups; only edges that join are returned. Groups that are joined in the end are
    clusters: every link lies within one, though not all their sets need link.
3.  Clusters are cut into tiles of bounded size, ordered by size bands. In a tile a set is held
    against those of a size that may link, again signatures first; what passes is decided
    by intersecting the sorted n-gram arrays. Sets already connected are not compared
    again, and a tile returns only the links that connect. A cluster larger than a tile is
    cut into blocks: neighbouring blocks first, then only what its largest group has not
    taken in against all blocks.

Equal sets share a class and are compared once. Component ids are the least doc_id that
links reach. n-grams are compared as 64-bit hashes of their words.

Defined results: a document without words, or with null text, has an empty set and
links with nothing. Rows that share a doc_id are one document as far as links go, each
with its own n-gram count. A null doc_id links with nothing and has a null component.
Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.components import components
from tillmetrics.llm.memory import give_back, trimmed
from tillmetrics.llm.tables import stored

BAND_GROWTH = 5 / 4  # sizes of a band, from the least to the next band's least
HOT_SAMPLE = 20_000  # about as many documents show which n-grams are frequent ...
HOT_COPIES = 3  # ... those that as many of them have
HOT_GRAMS = 1 << 18  # at most, the most frequent ones
STARS = 8  # runs of three keys of a set that are looked up
ROWS_AT_ONCE = 20_000  # documents among which a task drops repeated sets
KEY_TILE = 4096  # sets of a key compared at once
KEY_ROWS = 50_000  # rows of less frequent keys handled together
CHARS_AT_ONCE = 400_000  # of text; smaller arrays are given back to the system when freed
ROWS_OUT = 2000  # in a batch that a task hands on
TILE_SETS = 4096
TILE_GRAMS = 4_000_000
SIGNATURE_BITS = 64  # at least
BITS_PER_DIFFERENCE = 4.5  # bits for each n-gram in which linked sets may differ, or more

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Rule:
    words: int = 5
    percent: int = 80


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _space_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32  # A-Z
    table[[9, 10, 11, 12, 13]] = 32
    return table


def gram_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and size < CHARS_AT_ONCE:
            part.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            size += len(part[-1])
            at += 1
        out += _gram_sets(part, words)
    return out


def _gram_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    data = _space_table()[data]
    ends_at = np.cumsum([len(t) + 1 for t in texts])  # behind each text's separator
    inside = data != 32
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    first, behind = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return [np.zeros(0, np.uint64) for _ in texts]
    # A word's hash adds up a hash of each of its bytes and their places.
    since = np.concatenate([[0], first]) if first[0] else first
    place = np.arange(len(data)) - np.repeat(since, np.diff(np.append(since, len(data))))
    place = place.astype(np.uint64)
    hashed = _mix((data.astype(np.uint64) + np.uint64(1)) * _A + place * _C)
    hashed[~inside] = 0
    word = _mix(np.add.reduceat(hashed, first) + (behind - first).astype(np.uint64))
    owner = np.searchsorted(ends_at, first, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    # The n-gram that begins at each word, and whether its words are all of one text.
    gram, n = word.copy(), len(word)
    for j in range(1, words):
        gram[: n - j] = _mix(gram[: n - j] * _A + word[j:]) if n > j else gram[: n - j]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rank = np.arange(n) - starts[owner]
    whole = rank + words <= counts[owner]
    gram, owner = gram[whole], owner[whole]
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    out = np.split(gram, np.searchsorted(owner, np.arange(1, len(texts))))
    for i in np.flatnonzero((counts > 0) & (counts < words)):  # all its words are one n-gram
        h = np.uint64(counts[i])
        for w in word[starts[i] : starts[i] + counts[i]]:
            h = _mix(np.array([h]) * _B + w)[0]
        out[i] = np.array([h], np.uint64)
    return out


def differing(a: int, b: int, percent: int) -> int:
    """n-grams in which sets of these sizes differ at most if they link."""
    return (a + b) * (100 - percent) // (100 + percent)


def prefix_keys(grams: np.ndarray, percent: int, hot: np.ndarray) -> np.ndarray:
    """The first n-grams of a set in the common order: two sets that link share one."""
    size = len(grams)
    wanted = size - (percent * size + 99) // 100 + 1
    order = _mix(grams * _A)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        order = (order >> np.uint64(1)) | ((hot[at] == grams).astype(np.uint64) << np.uint64(63))
    if wanted < size:
        first = np.argpartition(order, wanted - 1)[:wanted]
    else:
        first = np.arange(size)
    return grams[first[np.argsort(order[first], kind="stable")]]


def star_keys(keys: np.ndarray) -> np.ndarray:
    """A hash of each of the first runs of three keys."""
    if len(keys) < 3:
        return _mix(_mix(keys[:1] * _B) + keys[-1:])
    a = keys[: STARS + 2]
    return _mix(_mix(_mix(a[:-2] * _B) + a[1:-1]) * _C + a[2:])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digest(grams: np.ndarray) -> tuple[int, int]:
    """Two independent sums over the set."""
    if not len(grams):
        return 0, 0
    a, b = _mix(grams ^ _A).sum(dtype=np.uint64), _mix(grams * _C + _B).sum(dtype=np.uint64)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))


SET_SCHEMA = (
    "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, stars array<bigint>, keys array<bigint>, mark binary"
)


def hot_grams(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The n-grams that are frequent in a sample of documents, sorted; HOT_GRAMS at most."""
    rows = max(1, docs.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in trimmed(batches):
            for at in range(0, len(batch), 500):
                sets = gram_sets(batch["text"].iloc[at : at + 500].tolist(), rule.words)
                yield pd.DataFrame({"gram": _signed(np.concatenate(sets))})

    sample = docs.filter(draw < HOT_SAMPLE / rows).select("text").mapInPandas(grams, "gram bigint")
    counts = sample.groupBy("gram").count().filter(F.col("count") >= HOT_COPIES)
    found = counts.orderBy(F.desc("count"), "gram").limit(HOT_GRAMS).collect()
    return np.sort(np.array([r["gram"] for r in found], np.int64).view(np.uint64))


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Of each document the size and digest of its set; of one document for each set of a
    task also its keys and signature."""
    hot = docs.sparkSession.sparkContext.broadcast(hot_grams(docs, rule))  # HOT_GRAMS numbers at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []
        for batch in trimmed(batches):
            at = 0
            ids = [None if x is None else int(x) for x in batch["doc_id"]]
            texts = batch["text"].tolist()
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and size < CHARS_AT_ONCE:
                    size += len(texts[stop] or "")
                    stop += 1
                for i, grams in zip(ids[at:stop], gram_sets(texts[at:stop], rule.words)):
                    keys = prefix_keys(grams, rule.percent, hot.value) if len(grams) else grams
                    mark = signature(grams, rule.percent).tobytes() if len(grams) else None
                    waiting.append((i, len(grams), *_digest(grams), _signed(star_keys(keys)), _signed(keys), mark))
                at = stop
                if len(waiting) >= ROWS_AT_ONCE:
                    yield from _gathered(waiting)
                    waiting = []
        if waiting:
            yield from _gathered(waiting)

    wanted = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), "text")
    return wanted.mapInPandas(run, SET_SCHEMA)


def _gathered(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    """Let the least document stand for each set; the others have no keys."""
    stands: dict = {}
    for row in rows:
        if row[0] is not None and row[1]:
            name = row[1:4]
            stands[name] = min(row[0], stands.get(name, row[0]))
    none = np.zeros(0, np.int64)
    for at in range(0, len(rows), ROWS_OUT):
        some = rows[at : at + ROWS_OUT]
        kept = [row[0] is not None and stands.get(row[1:4]) == row[0] for row in some]
        yield pd.DataFrame(
            {
                "doc_id": pd.array([r[0] for r in some], dtype="Int64"),
                "n_shingles": [r[1] for r in some],
                "d1": [r[2] for r in some],
                "d2": [r[3] for r in some],
                "stars": [r[4] if k else none for r, k in zip(some, kept)],
                "keys": [r[5] if k else none for r, k in zip(some, kept)],
                "mark": [r[6] if k else None for r, k in zip(some, kept)],
            }
        )


def _sharing(sets: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows (key, doc_id), and the keys that several documents have, with the least."""
    keys = sets.filter(F.size(column) > 0).select("doc_id", F.explode(column).alias("key"))
    least = keys.groupBy("key").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("c")).filter("b < c")
    return keys, least.select("key", "b")


def star_edges(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of each document and the least one that has the same run of keys."""
    keys, least = _sharing(sets, "stars")
    return keys.join(least, "key").select(F.col("doc_id").alias("a"), "b").filter("a <> b").distinct()


def key_edges(sets: DataFrame, stars: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that share a key and pass the signatures, enough to connect all such
    pairs of documents that ``stars`` (node, label) leaves apart."""
    keys, least = _sharing(sets, "keys")
    rows = keys.join(least.select("key"), "key")
    rows = rows.join(stars, rows["doc_id"] == stars["node"], "left").select(
        "key", "doc_id", F.coalesce("label", "doc_id").alias("label")
    )
    rows = stored(rows, "shared-keys")
    buckets = 1 + rows.count() // KEY_ROWS
    apart = rows.groupBy("key").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.expr(f"cast(ceil(count(*) / {KEY_TILE}) as int)").alias("blocks")
    )
    rows = rows.join(apart.filter("x < y").select("key", "blocks"), "key")
    marks = sets.filter("mark is not null").select(F.col("doc_id").alias("of"), F.col("n_shingles").alias("n"), "mark")
    rows = rows.join(marks, rows["doc_id"] == marks["of"]).drop("of")
    # Keys of few documents share tiles; one of many is cut into blocks, every two of which meet.
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    rows = rows.withColumn("block", block).select("*", other.alias("other"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    tile = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), bucket)).otherwise(
        F.concat_ws("/", F.col("key"), F.least("block", "other"), F.greatest("block", "other"))
    )
    rows = rows.select(tile.alias("tile"), "key", "doc_id", "label", "n", "mark")

    def run(name: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        part = part.drop_duplicates(["key", "doc_id"]).reset_index(drop=True)
        marks = [np.frombuffer(m, np.uint64) for m in part["mark"]]
        docs, labels, sizes = (part[c].to_numpy(np.int64) for c in ("doc_id", "label", "n"))
        done: set = set()
        for places in part.groupby("key", sort=False).indices.values():
            found = _joining(sizes[places], [marks[i] for i in places], labels[places], rule.percent)
            edges = {(int(docs[places[x]]), int(docs[places[y]])) for x, y in found}
            out += edges - done
            done |= edges
        give_back()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("tile").applyInPandas(run, LINK_SCHEMA).distinct()


def _groups(labels: np.ndarray) -> np.ndarray:
    """Of each place the first place with its label."""
    _, at, which = np.unique(labels, return_index=True, return_inverse=True)
    return at[which]


def signature(grams: np.ndarray, percent: int) -> np.ndarray:
    """For each bit, whether an odd number of n-grams falls on it, as numbers of 64 bits.

    Two sets differ in at least as many n-grams as their signatures do in bits. The bits
    are a power of two, so that a longer signature folds to a shorter one.
    """
    wanted = int(BITS_PER_DIFFERENCE * differing(len(grams), len(grams), percent))
    bits = max(SIGNATURE_BITS, 1 << wanted.bit_length())
    odd = np.bincount(((grams >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


class Signatures:
    """Signatures of sets in order of size, folded to that of the smaller one in a pair."""

    def __init__(self, sizes: np.ndarray, marks: list[np.ndarray], percent: int):
        self.sizes, self.percent = sizes, percent
        lengths = np.array([len(m) for m in marks])
        self.levels = lengths
        self.tables: dict[int, tuple[int, np.ndarray]] = {}
        reach = np.searchsorted(sizes, sizes * 100 // percent, side="right")
        for level in np.unique(lengths):
            own = np.flatnonzero(lengths == level)
            rows = [self._folded(marks[i], int(level)) for i in range(own[0], max(own[-1] + 1, reach[own[-1]]))]
            self.tables[int(level)] = (int(own[0]), np.stack(rows))

    @staticmethod
    def _folded(mark: np.ndarray, level: int) -> np.ndarray:
        while len(mark) > level:
            half = len(mark) // 2
            mark = mark[:half] ^ mark[half:]
        return mark

    def may_link(self, i: int, j: np.ndarray) -> np.ndarray:
        """Those of places j behind i that may link with it, by the bound on the overlap.

        |A and B| = (|A| + |B| - differing) / 2, and as many n-grams differ as bits do, or more.
        """
        first, rows = self.tables[int(self.levels[i])]
        apart = np.bitwise_count(rows[j - first] ^ rows[i - first]).sum(axis=1, dtype=np.int64)
        both = self.sizes[j] + self.sizes[i]
        return j[apart <= both * (100 - self.percent) // (100 + self.percent)]


def _joining(sizes: np.ndarray, marks: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of places that may link, enough of them to join all groups that may."""
    order = np.argsort(sizes, kind="stable")
    sizes, up = sizes[order], _groups(labels[order])
    stop = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    marks = Signatures(sizes, [marks[i] for i in order], percent)
    out = []
    for i in range(len(order)):
        j = np.arange(i + 1, stop[i])
        j = j[up[j] != up[i]]
        if not len(j):
            continue
        for k in marks.may_link(i, j):
            if up[k] != up[i]:
                up[up == max(up[k], up[i])] = min(up[k], up[i])
                out.append((int(order[i]), int(order[k])))
    return out


def _find(up: np.ndarray, i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _links(sets: list[np.ndarray], left: np.ndarray, percent: int, same: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places that link, enough of them to connect what links connect.

    Only pairs with a member marked in ``left`` count; ``same`` holds groups already known.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    marks = Signatures(sizes, [signature(sets[i], percent) for i in order], percent)
    left, same = left[order], same[order]
    up = _groups(same)
    out = []
    stop = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    for i in range(len(order)):
        j = np.arange(i + 1, stop[i])
        if not left[i]:
            j = j[left[j]]
        if not len(j):
            continue
        j = marks.may_link(i, j)
        a = sets[order[i]]
        for k in j:
            x, y = _find(up, i), _find(up, int(k))
            if x == y:
                continue
            b = sets[order[k]]
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if 100 * both >= percent * (len(a) + len(b) - both):
                up[max(x, y)] = min(x, y)
                out.append((int(order[i]), int(order[k])))
    return out


LINK_SCHEMA = "a bigint, b bigint"


def tile_links(members: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) within tiles, from rows (tile, cluster, doc_id, left, same, text)."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # The same document may come twice to a tile of two blocks.
        rows = rows.drop_duplicates(["cluster", "doc_id", "text"]).reset_index(drop=True)
        sets = gram_sets(rows["text"].tolist(), rule.words)
        docs = rows["doc_id"].to_numpy(np.int64)
        left, same = rows["left"].to_numpy(bool), rows["same"].to_numpy(np.int64)
        out = []
        for places in rows.groupby("cluster", sort=False).indices.values():
            places = np.sort(places)
            own = [sets[i] for i in places]
            out += [(docs[places[x]], docs[places[y]]) for x, y in _links(own, left[places], rule.percent, same[places])]
        give_back()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return members.groupBy("tile").applyInPandas(run, LINK_SCHEMA)


def _first_tiles(members: DataFrame, sizes: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Rows per tile: small clusters whole, several to a tile; large ones by blocks."""
    buckets = max(1, small)
    whole = members.join(sizes.filter("not large").select("cluster"), "cluster").select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(buckets))).alias("tile"), "cluster", "doc_id", "n"
    )
    bands = F.expr(f"cast(floor(ln(n) / ln({BAND_GROWTH})) as int)")
    large = members.join(sizes.filter("large").select("cluster"), "cluster").withColumn("band", bands)
    blocks = large.groupBy("cluster", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    blocks = blocks.select(
        "cluster",
        "band",
        F.expr(f"cast(greatest(1, ceil(sets / {TILE_SETS / 2}), ceil(grams / {TILE_GRAMS / 2})) as int)").alias("blocks"),
    )
    large = large.join(blocks, ["cluster", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    )
    return whole, large


def links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """Links between class representatives, enough to connect whatever links connect."""
    members = classes.join(clusters, classes["doc_id"] == clusters["node"]).select(
        "doc_id", "n", F.col("label").alias("cluster")
    )
    sizes = members.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n").alias("grams")).filter("sets > 1")
    sizes = stored(sizes.withColumn("large", F.expr(f"sets > {TILE_SETS} or grams > {TILE_GRAMS}")), "clusters")
    members = stored(members.join(sizes.select("cluster"), "cluster"), "members")
    total = sizes.agg(
        F.coalesce(F.sum(F.expr("if(large, 0, sets)")), F.lit(0)).alias("sets"),
        F.coalesce(F.sum(F.expr("if(large, 0, grams)")), F.lit(0)).alias("grams"),
        F.count_if("large").alias("large"),
    ).first()
    small = math.ceil(max(total["sets"] / (TILE_SETS / 2), total["grams"] / (TILE_GRAMS / 2)))
    whole, large = _first_tiles(members, sizes, small)
    none = {"left": F.lit(True), "same": F.col("doc_id")}
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if not total["large"]:
        return tile_links(whole.withColumns(none).join(texts, "doc_id"), rule)

    # Large clusters: each block with the next of its band, and the first of the next band.
    large = stored(large, "blocks")
    name = [F.lit("l"), F.col("cluster"), F.col("band"), F.col("block")]
    turns = F.array(
        F.concat_ws("/", *name),
        F.concat_ws("/", *name[:3], F.pmod(F.col("block") + 1, F.col("blocks"))),
        F.when(F.col("block") == 0, F.concat_ws("/", *name[:2], F.col("band") + 1, F.lit(0))),
    )
    first = large.select(
        F.explode(F.array_distinct(F.array_compact(turns))).alias("tile"), "cluster", "doc_id", "n"
    )
    found = stored(tile_links(whole.union(first).withColumns(none).join(texts, "doc_id"), rule), "links")
    # Then every set outside its cluster's largest group against all of the cluster.
    groups = stored(components(found, "groups"), "groups")
    large = large.join(groups, large["doc_id"] == groups["node"], "left").select(
        large["*"], F.coalesce("label", "doc_id").alias("same")
    )
    counts = large.groupBy("cluster", "same").count()
    largest = counts.groupBy("cluster").agg(F.max_by("same", F.struct("count", "same")).alias("main"))
    large = stored(large.join(largest, "cluster").withColumn("left", F.expr("same <> main")), "large")
    rest = large.filter("left")
    shares = rest.groupBy("cluster").agg(
        F.expr(f"cast(greatest(1, ceil(count(*) / {TILE_SETS / 2}), ceil(sum(n) / {TILE_GRAMS / 2})) as int)").alias("shares")
    )
    grid = large.select("cluster", "band", "block").distinct()
    rest = rest.join(shares, "cluster").withColumn("share", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("shares")))
    tile = F.concat_ws("/", F.lit("g"), "cluster", "band", "block", "share")
    columns = ["cluster", "doc_id", "n", "left", "same"]
    against = large.join(shares, "cluster").withColumn("share", F.explode(F.expr("sequence(0, shares - 1)")))
    sides = against.select(tile.alias("tile"), *columns).union(
        rest.drop("band", "block").join(grid, "cluster").select(tile.alias("tile"), *columns)
    )
    return found.union(tile_links(sides.drop("n").join(texts, "doc_id"), rule))


def groups_of(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    sets = stored(describe(docs, rule), "sets")
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("d1", "d2", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("doc_id"))
    classes = stored(classes, "classes")
    stars = stored(components(star_edges(sets), "stars"), "star-labels")
    joined = stars.select(F.col("node").alias("a"), F.col("label").alias("b")).union(key_edges(sets, stars, rule))
    clusters = stored(components(joined, "clusters"), "cluster-labels")
    found = links(docs, classes.select("doc_id", "n").distinct(), clusters, rule)
    # Rows that share a doc_id but not a set connect their classes.
    several = full.groupBy("doc_id").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).filter("x <> y")
    same = full.join(several.select("doc_id"), "doc_id", "left_semi").select("d1", "d2", F.col("doc_id").alias("a"))
    same = same.join(classes.select("d1", "d2", F.col("doc_id").alias("b")), ["d1", "d2"]).select("a", "b")
    labels = stored(components(found.union(same), "links"), "labels")
    named = classes.join(labels, classes["doc_id"] == labels["node"], "left").select(
        "d1", "d2", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id")
    )
    out = sets.join(named, ["d1", "d2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
    return out


def one_of_each_group(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` whose document has the least doc_id of its group.

    Rows without a doc_id stay. Of rows equal in doc_id and text one stays.
    """
    groups = groups_of(docs.select("doc_id", "text"), rule)
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(stored(kept, "kept"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.filter("doc_id is null")).select(*docs.columns)
