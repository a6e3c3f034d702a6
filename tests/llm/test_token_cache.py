"""A cache that holds some texts, many, all; what is shuffled and encoded then."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillmetrics.llm import queries, token_counts
from tillmetrics.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def definition():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize(("bits", "bitmaps"), [(16, 4096), (16, 1), (100_000, 4)])
def test_a_growing_cache(spark, definition, tmp_path, monkeypatch, bits, bitmaps):
    monkeypatch.setattr(token_counts, "BITS_PER_MISS", bits)
    monkeypatch.setattr(token_counts, "BITMAPS", bitmaps)
    monkeypatch.setattr(token_counts, "BITMAP_BITS", 32768)
    tokenizer = Tokenizer.from_str(definition)
    path = f"file://{tmp_path}/cache"
    texts = [None, "", *[f"text number {i}, some words" for i in range(200)], *["a copy"] * 40]
    for some in (texts[:1], texts[:90], texts, texts, texts + ["new", "new"]):
        found = token_counts.token_counts(frame(spark, some), definition, path).collect()
        expected = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in some]
        assert [r["n_tokens"] for r in sorted(found, key=lambda r: r["doc_id"])] == expected
        rows = [bytes(r["content"]) for r in token_counts.read_cache(spark, path).collect()]
        assert len(rows) == len(set(rows)) and len(rows) >= len({t or "" for t in some})


def digests(df):
    return df.select("text", F.unhex(F.sha2("text", 256)).alias("content"))


def test_texts_in_the_cache_are_dropped_before_a_shuffle(spark):
    texts = digests(frame(spark, [f"text {i}" for i in range(300)]))
    known = texts.filter("text <> 'text 7'").select("content")
    found = token_counts.missing_texts(texts, known)
    assert [r["text"] for r in found.collect()] == ["text 7"]
    missed = texts.filter("text = 'text 7'").select("content")
    passing = token_counts._may_miss(texts, missed, 1)
    assert 1 <= passing.count() < 5
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(text" not in plan
    assert token_counts.missing_texts(texts, texts.select("content")) is None
    assert token_counts.missing_texts(texts, known.limit(0)).count() == 300


def test_another_tokenizers_counts_are_not_used(spark, definition, tmp_path):
    path = f"file://{tmp_path}/cache"
    docs = frame(spark, ["some text"])
    digest = token_counts.content(F.col("text"))
    wrong = docs.select(F.lit("other").alias("tokenizer"), F.unhex(F.sha2(digest, 256)).alias("content"), F.lit(99).cast("bigint").alias("n_tokens"))
    wrong.write.parquet(path)
    assert token_counts.token_counts(docs, definition, path).first()["n_tokens"] == 2


def test_the_query_keeps_a_lasting_cache(spark, tmp_path, monkeypatch):
    encoded = []
    write = token_counts.missing_texts
    monkeypatch.setattr(token_counts, "missing_texts", lambda *x: encoded.append(write(*x)) or encoded[-1])
    spark.conf.set("spark.tillmetrics.tokenCache", f"file://{tmp_path}/cache")
    try:
        folder = "/root/testdata/sf0.001"
        first, second = (sorted(queries.op7_token_counts(spark, folder).collect()) for _ in range(2))
    finally:
        spark.conf.unset("spark.tillmetrics.tokenCache")
    assert first == second and encoded[0] is not None and encoded[1] is None
