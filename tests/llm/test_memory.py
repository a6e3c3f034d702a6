"""Memory of Python workers."""

import re
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from tillmetrics.llm import memory


def _own_mb() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="not this system")
def test_what_batches_took_is_given_back():
    before = _own_mb()
    for _ in memory.trimmed(iter(range(3))):
        kept = []
        held = [np.ones(2000) for _ in range(6000)]  # 96 MB in small arrays
        kept.append(np.ones(8))  # above them on the heap
        del held
    assert _own_mb() - before < 48


def test_a_stage_hands_python_few_texts_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "one two", "en")], "doc_id long, text string, lang string")
    try:
        spark.conf.set(name, "10000")
        corpus_pipeline.language_id(spark, docs, "")
        assert spark.conf.get(name) == str(memory.ROWS_AT_ONCE)
        spark.conf.set(name, "50")  # the session's own, smaller
        corpus_pipeline.language_id(spark, docs, "")
        assert spark.conf.get(name) == "50"
    finally:
        spark.conf.set(name, was)
