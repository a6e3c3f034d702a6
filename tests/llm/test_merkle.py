"""The manifest against a plain tree, over blocks of few leaves."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tillmetrics.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, root string, at int, size string"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def paths(leaves):
    """The root and each leaf's siblings, level by level."""
    nodes, where, found = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, p in enumerate(where):
            if (p ^ 1) < len(nodes):
                found[i].append(nodes[p ^ 1])
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        where = [p // 2 for p in where]
    return nodes[0], found


def expected(rows):
    groups = {}
    for doc_id, text, lang in rows:
        leaf = h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, lang, text)])
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees.append(paths([x[2] for x in groups[g]]))
    root, above = paths([t[0] for t in trees])
    return sorted(
        (str(doc_id), leaf, subroot, root, "".join(own + up))
        for g, (subroot, siblings), up in zip(names, trees, above)
        for (_, _, leaf, doc_id), own in zip(groups[g], siblings)
    )


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    leaves = df.withColumn("digest", merkle.leaf_of([F.col("doc_id"), F.col("lang"), F.col("text")]))
    return merkle.witnesses(leaves, "lang", ["doc_id"])


def as_rows(path):
    shown = path.select(
        F.col("row.doc_id").alias("doc_id"), *[merkle.hex_text(F.col(c)) for c in ("digest", "subroot", "root", "siblings")]
    )
    return sorted((str(r[0]), *r[1:]) for r in shown.collect())


@pytest.mark.parametrize("levels", [1, 3, 12])
def test_witnesses_are_those_of_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rng = random.Random(levels)
    rows = [(i, f"text {i} é", "en" if i % 3 else rng.choice(["de", "fr", "éo", "Z", None])) for i in range(75)]
    rows += [(None, "x", "de"), (None, None, "de"), (None, None, None), (5, "", "one"), (80, "日本", "en")]
    assert as_rows(manifest(spark, rows)) == expected(rows)


def test_every_size_of_one_group(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    for n in (1, 2, 4, 5, 17):
        rows = [(i, None, "en") for i in range(n)]
        assert as_rows(manifest(spark, rows)) == expected(rows)


def test_repeated_rows_share_the_witnesses_of_their_places(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    rows = [(1, "same", "en")] * 9 + [(2, "other", "en")]
    path = manifest(spark, rows)
    assert as_rows(path) == expected(rows)
    assert merkle.verified(path, F.col("digest")).filter("verified").count() == 10


def test_only_changed_leaves_fail(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    path = manifest(spark, [(i, f"t{i}", "en" if i % 2 else "de") for i in range(20)])
    leaf = F.when(F.col("row.doc_id") % 5 == 0, F.unhex(F.sha2(F.lit("x"), 256))).otherwise(F.col("digest"))
    failed = merkle.verified(path, leaf).filter("not verified").select("row.doc_id").collect()
    assert sorted(r.doc_id for r in failed) == [0, 5, 10, 15]


def test_empty_table(spark):
    assert manifest(spark, []).collect() == []


def test_streaming_keeps_the_witnesses_of_each_prefix():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(23)]
    for n in range(1, 24):
        stream = merkle.Stream()
        found = [stream.append(x) for x in leaves[:n]]
        root = stream.finish()
        wanted, siblings = paths([x.hex() for x in leaves[:n]])
        assert root.hex() == wanted
        for leaf, w, s in zip(leaves, found, siblings):
            assert [x.hex() for x in w.siblings if x] == s
            assert merkle.fold(leaf, "".join(w.sides), b"".join(w.siblings)) == root
