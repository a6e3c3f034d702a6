"""Secrets by pattern and by model against plain scans, on mixed, dense and long texts."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import plain_secrets
from tillmetrics.llm import secret_scan
from tillmetrics.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return secret_scan.fit(secret_scan.samples(docs))


def ratio(model, token):
    codes = [secret_scan.ALPHABET.index(c) for c in token]
    return sum(model.ratios[a * len(secret_scan.ALPHABET) + b] for a, b in zip(codes, codes[1:]))


def regions(spans):
    out, reach = [], 0
    for start, _, end, _ in sorted(spans):
        if start >= reach:
            out.append([start, end])
        out[-1][1] = reach = max(reach, end)
    return out


def plain_added(text, base, model):
    """Tokens between the patterns' spans, judged one by one."""
    bounds = [0, *[x for r in regions(base) for x in r], len(text)]
    out = []
    for start, end in zip(bounds[::2], bounds[1::2]):
        for m in re.finditer(secret_scan.EDGE_TOKEN, text[start:end]):
            n = len(m[0])
            at_edge = (start > 0 and m.start() == 0) or (end < len(text) and m.end() == end - start)
            if n < 16 and not at_edge:
                continue
            score = ratio(model, m[0])
            if score >= secret_scan.MIN_RATIO_PER_CHAR * n and (n < 16 or score >= secret_scan.MIN_RATIO):
                out.append((start + m.start(), 3, start + m.end(), "random"))
    return out


def plain_redacted(text, spans):
    bounds = [0, *[x for r in regions(spans) for x in r], len(text)]
    return "[SECRET]".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def piece(rng):
    kind = rng.randrange(9)
    if kind == 0:
        return "".join(rng.choices("0123456789abcdef", k=rng.choice([8, 23, 24, 40])))
    if kind == 1:
        return "".join(rng.choices(LETTERS, k=rng.choice([3, 4, 9, 16, 30])))
    if kind == 2:
        return rng.choice(["password=", "api_key: ", 'Secret = "', "token:", "passwd"])
    if kind == 3:
        return "AKIA" + "".join(rng.choices(LETTERS[:26], k=rng.choice([15, 16, 20])))
    if kind == 4:
        return rng.choice(["get_user_name_by_id", "org/repo/branch-name", "HttpRequestHandler"])
    return rng.choice([" ", "\n", "é🎉", ", ", ".", "-", "the river"])


def check(spark, texts, model):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = secret_scan.scan(df, model)
    found = found.withColumn("clean", secret_scan.redacted(F.col("text"), F.concat("base", "added")))
    for r in found.collect():
        text = r["text"] or ""
        base = plain_secrets(text)
        assert [tuple(s) for s in r["base"]] == base
        added = plain_added(text, base, model)
        assert [tuple(s) for s in r["added"]] == added, text[:200]
        assert (r["clean"] or "") == plain_redacted(text, base + added)


@pytest.mark.parametrize("chunk, block", [(256, 1024), (2, 7)])
def test_spans_are_those_of_plain_scans(spark, model, monkeypatch, chunk, block):
    monkeypatch.setattr(secret_scan, "CHUNK", chunk)
    monkeypatch.setattr(secret_scan, "BLOCK", block)
    rng = random.Random(7)
    texts = ["".join(piece(rng) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [None, "", "0123456789abcdef01234567api_key=0123456789abcdef01234567"]
    check(spark, texts, model)


def test_a_random_token_around_a_hex_run_goes_wholly(spark, model):
    text = "key kJ8dLq2ZvR7x0123456789abcdef01234567Tn4WbYp9sGfA3hE6 end"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = secret_scan.scan(df, model)
    clean = found.select(secret_scan.redacted(F.col("text"), F.concat("base", "added")).alias("c")).first()["c"]
    assert clean == "key [SECRET][SECRET][SECRET] end"


def test_dense_texts_take_time_by_their_length(spark, model):
    rng = random.Random(8)
    text = " ".join(piece(rng) for _ in range(160_000))
    check(spark, [text[:300_000]], model)
    long = (text * 3)[:4_000_000]
    df = spark.createDataFrame([(1, long)], "doc_id bigint, text string")
    started = time.time()
    found = secret_scan.scan(df, model)
    row = found.select(F.size("base").alias("n"), F.length(secret_scan.redacted(F.col("text"), F.concat("base", "added"))).alias("l")).first()
    assert row["n"] > 20_000 and row["l"] < len(long)
    assert time.time() - started < 90  # some 20 s; the square of its matches would take hours


def test_the_query_gives_counts_and_digests_of_the_patterns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op3_secrets"](spark, FOLDER).collect():
        base = plain_secrets(texts[r["doc_id"]])
        named = [f"{kind}:{start}:{end}" for start, _, end, kind in base]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in base) for k in secret_scan.BASE_KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(",")) or not named
