"""Each text is searched once, and an alignment is the one that a plain table of edits gives."""

import random
import re

import numpy as np

from tillmetrics.llm import decontaminate


def test_texts_are_searched_once(spark):
    prose = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of jade"
    docs = spark.createDataFrame([(1, f"so {prose} indeed"), (2, "nothing of it"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, prose)], "item_id long, text string")
    found = decontaminate.leaked_rows(docs, bench)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(1, 7)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"run\(", plan)) == 1


def least_edits(pattern, seq, first, low, high, width):
    """Least edits of the pattern in its band, cell by cell."""
    far = 10**6
    cost = [0 if low <= first + c <= high else far for c in range(width)]
    for i, char in enumerate(pattern):
        now = []
        for c in range(width):
            at = first + i + c
            inside = low <= at < high
            ways = [cost[c] + (seq[at] != char) if inside else far, cost[c + 1] + 1 if c + 1 < width else far]
            if inside and c:
                ways.append(now[c - 1] + 1)
            now.append(min(ways))
        cost = now
    return min(cost)


def test_alignment_within_a_band():
    rng = random.Random(5)
    for _ in range(40):
        m, alphabet = rng.choice([30, 41, 50]), rng.choice([2, 6])
        k = decontaminate.edit_budget(m)
        seq = np.array([97 + rng.randrange(alphabet) for _ in range(150)], np.uint32)
        patterns, first, low, high = [], [], [], []
        for _ in range(20):
            begin = rng.randrange(-5, 120)
            own = [int(x) for x in seq[max(0, begin) : max(0, begin) + m + k]]
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = [97 + rng.randrange(alphabet)] * rng.randrange(2)
            patterns.append((own + [97] * m)[:m])
            first.append(begin - rng.randrange(k + 1))
            low.append(rng.choice([0, max(0, begin - 1), 40]))
            high.append(rng.choice([150, min(150, begin + m), 110]))
        arrays = [np.array(x) for x in (first, low, high)]
        edits, start, end = decontaminate._align(np.array(patterns, np.uint32), seq, *arrays, 2 * (k + 1))
        for i, pattern in enumerate(patterns):
            expected = least_edits(pattern, seq, first[i], low[i], high[i], 2 * (k + 1))
            assert (edits[i] <= m) == (expected <= m)
            if expected <= m:
                assert edits[i] == expected
                assert low[i] <= start[i] <= end[i] <= high[i]
