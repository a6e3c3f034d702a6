"""Segments, counts and the law against plain versions; what the model finds in texts it has not seen."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmetrics.llm import toxicity
from tillmetrics.llm.queries import QUERIES
from tillmetrics.llm.tables import in_fold

SCHEMA = "doc_id bigint, text string, score double, toxic string, passages int"
MILD = "river stone garden window paper yellow morning letter mountain bread silver walking".split()
RUDE = "blorgface snivelhead gruntwit".split()


def plain_segments(scores, at=0):
    """The best segment, shortest of equals, then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            key = (sum(scores[i : j + 1]), -(j - i), -i)
            if best is None or key > best[0]:
                best = (key, i, j)
    if best is None or best[0][0] <= 0:
        return []
    _, i, j = best
    return plain_segments(scores[:i], at) + [(best[0][0], at + i, at + j)] + plain_segments(scores[j + 1 :], at + j + 1)


def test_segments_are_all_maximal_ones():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3.25, -2.0, -1.125, 1.0, 2.5, 4.0625]) + rng.random() / 1024 for _ in range(rng.randint(0, 14))]
        found = [(round(s, 6), a, b) for s, a, b in toxicity.segments(np.array(scores, dtype=float))]
        assert found == [(round(s, 6), a, b) for s, a, b in plain_segments(scores)]


def test_segments_of_a_long_text_take_linear_time():
    scores = np.tile([1.5, -1.0], 200_000)  # each new segment meets all former ones
    assert [x[1:] for x in toxicity.segments(scores)] == [(0, 399_998)]
    falling = np.tile([1.0, -1.5], 200_000)
    assert len(toxicity.segments(falling)) == 200_000


def test_lambda_solves_its_equation():
    middles = np.array([-2.0, -0.5, 1.0, 3.0])
    counts = np.array([50, 40, 8, 2])
    rate = toxicity.lambda_of(counts, middles)
    assert abs((counts / 100 * np.exp(rate * middles)).sum() - 1) < 1e-9
    assert toxicity.lambda_of(np.array([0, 0, 0, 0]), middles) == 1.0
    assert toxicity.lambda_of(np.array([1, 1, 0, 0]), middles) == 1.0


def text(rng, rude):
    words = rng.choices(MILD, k=rng.randint(30, 90))
    if rude:
        at = rng.randint(0, len(words))
        words[at:at] = rng.choices(RUDE, k=rng.randint(2, 5))
    return " ".join(words)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(*r, 0.5, "x", 1) for r in rows], SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400)] + [(0, 0), (7, None), (None, 1), (9999, 1)], "doc_id bigint, toxic int"
    )
    return rows, toxicity.fit(docs, labels)


def test_counts_and_shares_are_those_of_a_plain_count(spark, learned, monkeypatch):
    rows, model = learned
    ids = [r.doc_id for r in spark.range(400).withColumnRenamed("id", "doc_id").filter(
        F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(toxicity.CALIBRATION)) != 0
    ).collect()]
    n, bad = Counter(), Counter()
    for i in ids:
        own = set()
        for w in set(re.findall("[a-z]+", rows[i][1])):
            own.update([w[:4], *([w[:7], w + "$"] if len(w) > 7 else [w + "$"])] if len(w) > 4 else [w + "$"])
        n.update(own)
        bad.update(own if i % 4 == 0 else [])
    share = (sum(i % 4 == 0 for i in ids) + 1) / (len(ids) + 2)
    assert math.isclose(model.share, share)
    assert set(model.lexicon) == {s for s in n if n[s] >= 2}

    def expected(stem):
        shorter = {s for s in n if s != stem and not s.endswith("$") and stem.rstrip("$").startswith(s) and len(s) in (4, 7)}
        shorter = {s for s in shorter if len(s) < len(stem.rstrip("$"))}
        prior = expected(max(shorter, key=len)) if shorter else share
        return (bad[stem] + toxicity.PRIOR * prior) / (n[stem] + toxicity.PRIOR)

    for stem in model.lexicon:
        assert math.isclose(model.lexicon[stem], expected(stem)), stem


def test_passages_in_texts_not_seen(spark, learned):
    _, model = learned
    rng = random.Random(3)
    rows = [(i, text(rng, i % 2 == 0), 0.1, "y", 2) for i in range(100)]
    rows += [(100, None, None, None, None), (101, "", 0.0, "", 0), (102, "1 2 3 !!", 0.0, "", 0), (None, rows[0][1], 0.0, "", 0)]
    rows += [(103, " ".join(MILD * 20_000), 0.0, "", 0), (104, " ".join(MILD * 9000 + RUDE * 3 + MILD * 9000), 0.0, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("found", toxicity.judge(model, F.col("text")))
    for r in df.collect():
        found = r["found"]
        assert 0 <= found["score"] <= 1
        rude = [m.span() for m in re.finditer("|".join(RUDE), r["text"] or "")]
        if not rude:
            assert found["score"] < 0.5 and not found["passages"], r["doc_id"]
            continue
        assert found["score"] >= 0.5
        covered = {p for x in found["passages"] for p in range(x["start"], x["end"])}
        assert all(a in covered and b - 1 in covered for a, b in rude)
        for x in found["passages"]:
            words = re.findall("[a-z]+", r["text"])
            assert " ".join(words[x["first_word"] : x["last_word"] + 1]) == r["text"][x["start"] : x["end"]]
            assert x["expected"] <= toxicity.ALPHA


def test_one_class_only_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id bigint, text string")
    for labels in ([], [(1, 0), (2, 0)], [(1, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        found = docs.select(toxicity.judge(model, F.col("text")).alias("found")).collect()
        assert all(0 <= r["found"]["score"] < 0.5 for r in found)
    model = toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert docs.limit(0).select(toxicity.judge(model, F.col("text"))).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op12_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out")
    right, total = found.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert total > 500 and right / total >= 0.97
    assert found.filter(~in_fold(F.col("doc_id"), 5, 0)).count() == 0
