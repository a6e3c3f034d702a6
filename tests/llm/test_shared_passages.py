"""Benchmark items that share a passage: the same rows, in about the time of items that do not."""

import random
import time

import pytest

from tillmetrics.llm import decontaminate


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(n))


SHARED = "please read the following question and choose the best answer out of the four that are given below"


def items(n, shared, seed=1):
    rng = random.Random(seed)
    return [(i, f"{words(rng, rng.randint(2, 6))} {shared} {words(rng, 20)}") for i in range(n)]


def index_of(rows):
    cut = []
    table = decontaminate._fold_table()
    for item, text in rows:
        seq, _ = decontaminate.folded(text, table)
        for at in range(0, max(1, len(seq) - decontaminate.WINDOW + 1), decontaminate.STARTS):
            part = seq[at : at + decontaminate.STARTS + decontaminate.WINDOW - 1]
            cut.append((item, part.tobytes().decode("utf-32-le"), False))
    return decontaminate.build_index(cut)


def texts_of(rows, seed=2):
    rng = random.Random(seed)
    some = [f"{words(rng, 30)} {rows[rng.randrange(len(rows))][1]} {words(rng, 30)}" for _ in range(4)]
    edited = SHARED.replace("question", "qestion").replace("four", "fours")
    return [None, "", *some, f"{words(rng, 9)} {SHARED} {words(rng, 200)}", f"{edited} {edited}", words(rng, 80), SHARED]


@pytest.mark.parametrize("at_once", [1, 500, 20_000])
def test_ranges_of_pieces_do_not_show(monkeypatch, at_once):
    rows = items(40, SHARED)
    index, texts = index_of(rows), texts_of(rows)
    whole = decontaminate.scan(index, texts)
    assert len(whole[6]) == 40 and len(whole[7]) == 40 and whole[8] == []
    monkeypatch.setattr(decontaminate, "POSTINGS_AT_ONCE", at_once)
    assert decontaminate.scan(index, texts) == whole


def test_windows_aligned_once_are_those_aligned_each(monkeypatch):
    rows = items(30, SHARED) + items(30, SHARED)
    index, texts = index_of(rows), texts_of(rows)
    once = decontaminate.scan(index, texts)

    def each(index, begins, m, first, text):
        every = decontaminate.np.arange(len(begins))
        return every, every

    monkeypatch.setattr(decontaminate, "_alike", each)
    assert decontaminate.scan(index, texts) == once


def test_many_items_with_one_passage_take_no_longer():
    rng = random.Random(3)
    text = f"{words(rng, 120)} {SHARED} {words(rng, 120)}"
    took = {}
    for name, shared in (("shared", SHARED), ("own", None)):
        rows = items(1000, shared) if shared else [(i, f"{words(rng, 40)}") for i in range(1000)]
        index = index_of(rows)
        begin = time.monotonic()
        found = decontaminate.scan(index, [text] * 2)
        took[name] = time.monotonic() - begin
        assert [len(x) for x in found] == [1000 if shared else 0] * 2
    assert took["shared"] < took["own"] + 10
