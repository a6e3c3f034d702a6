"""Hard negatives against a plain search over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmetrics.llm import hard_negatives
from tillmetrics.llm.hard_negatives import Kept, Rule, hard_negatives as mined, products, usable

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, score int, anchor string"


def plain(rows, rule, every):
    whole = [
        (i, [math.floor(rule.scale * x) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, v, label in whole:
        if i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in whole if j != i and len(w) == len(v)
        ]
        scored.sort()
        for p, pos, _ in [s for s in scored if s[2] == label][: rule.positives]:
            inside = [s for s in scored if s[2] != label and rule.low * -p <= 100 * -s[0] <= rule.high * -p]
            out += [(i, pos, r, s[1], -p, -s[0]) for r, s in enumerate(inside[: rule.negatives], 1)]
    return sorted(out)


def found(spark, rows, rule, every):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    ready = usable(df, F.col("vec_id"), F.col("label"), F.col("embedding"))
    return sorted(tuple(r) for r in mined(ready, F.col("id") % every == 0, rule).collect())


def vectors(n, size, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-spread / 3, spread) for _ in range(size)], rng.randint(0, 3)) for i in range(n)]


@pytest.mark.parametrize("spread", [1.0, 1e4, 1e6])
def test_negatives_are_those_of_a_plain_search(spark, spread):
    rows = vectors(220, 6, 1, spread)
    rule = Rule(positives=4, negatives=3) if spread > 1 else Rule()
    assert found(spark, rows, rule, 10) == plain(rows, rule, 10)


def test_ties_repeats_nulls_and_odd_lengths(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(3)], i % 2) for i in range(60)]
    rows += [rows[10], rows[13], (None, [1.0, 1.0, 1.0], 0), (70, None, 0), (71, [1.0, None, 1.0], 1), (72, [1.0] * 3, None)]
    rows += [(73, [float("nan")] * 3, 0), (74, [float("inf")] * 3, 1), (80, [], 0), (81, [], 0), (82, [], 1)]
    rows += [(90, [1.0, 1.0], 0), (91, [1.0, 0.5], 0), (92, [0.5, 0.25], 1), (100, [1.0] * 5, 9), (110, [-0.5] * 3, 7)]
    rule = Rule(positives=3, negatives=4)
    assert found(spark, rows, rule, 10) == plain(rows, rule, 10)


def test_small_blocks_and_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 400)
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", 7)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    rows = vectors(150, 4, 2) + [(200 + i, [0.5] * 4, 1) for i in range(60)]
    assert found(spark, rows, Rule(), 15) == plain(rows, Rule(), 15)


def test_empty_table_and_no_anchors(spark):
    assert found(spark, [], Rule(), 10) == []
    assert found(spark, [(1, [1.0], 0), (2, [1.0], 0), (3, [0.5], 1)], Rule(), 10) == []


def test_products_are_exact_at_any_size():
    for top in (10, 10**5, 10**9, 10**17):
        left = np.array([[top, -top + 1, 3], [1, 2, 3]], dtype=object)
        whole = left if top > 2**50 else left.astype(np.int64)
        assert products(whole, whole).tolist() == [[sum(a * b for a, b in zip(x, y)) for y in left] for x in left]


def test_kept_rows_prefer_small_ids_among_equals():
    kept = Kept(2, 1)
    kept.add(0, np.array([9, 8, 7]), np.array([5, 5, 5]))
    kept.add(0, np.array([6, 1]), np.array([5, 4]))
    assert kept.ids[0].tolist() == [6, 7] and kept.least(0) == 5
