"""Token counts by way of a stored cache of digests.

A text is known by the digest of its content, a tokenizer by the digest of its file. The
cache is a Parquet table of both digests and the count. Counting joins the texts'
digests to it; only texts that it lacks are encoded, each distinct one once, and their
counts are appended. Digests alone are compared with a cache that holds some; texts that it
has are dropped where they are read, by a bitmap of the missing digests' hashes (a bit of
``BITS_PER_MISS`` each, ``BITMAPS`` of 4 KB in all at most), before any text is shuffled. The few
that pass by chance are dropped by digest afterwards. Equal texts that are missing meet by
digest: Spark combines them in each task first, so a text of which a third of all rows are
copies is moved once per task.

Counts are those of the ``tokenizers`` library for whole texts, special strings handled
as it does by default, no special tokens added. A byte-level tokenizer splits in front of
a space that follows no white space whatever else is there, so such texts are counted as
the sum over these stretches, of which each distinct one is encoded once. Any other
tokenizer, and texts with several white-space characters side by side, are encoded whole.

Defined results: a null text counts as the empty one, 0 bytes and 0 tokens. Repeated rows
each get the count. Two jobs that append the same counts at once leave equal rows, which
are read as one. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens bigint"
STRETCHES_KEPT = 400_000  # in a task, before its table of known stretches starts anew
BATCH_CHARS = 2_000_000
BITMAP_BITS = 32768  # what bitmap_construct_agg makes
BITS_PER_MISS = 16
BITMAPS = 4096  # 16 MB, sent to every task; beyond 8 million misses fewer bits are left for each


def content(text) -> object:
    """The normalised content that is counted: nothing is changed but null."""
    return F.coalesce(text, F.lit(""))


def tokenizer_digest(definition: str) -> str:
    return hashlib.sha256(definition.encode()).hexdigest()


def is_byte_level(tokenizer) -> bool:
    """Whether stretches may be counted on their own: no normalizer, byte-level splitting
    by the usual pattern, and no added token with white space or that takes it in."""
    kind = str(tokenizer.pre_tokenizer)
    added = tokenizer.get_added_tokens_decoder().values()
    return (
        tokenizer.normalizer is None
        and kind.startswith("ByteLevel(add_prefix_space=False")
        and "use_regex=True" in kind
        and not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added)
    )


class Counter:
    """Counts tokens of texts, keeping the counts of stretches it has seen."""

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_stretch = is_byte_level(self.tokenizer)
        self.known: dict[str, int] = {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        whole = []
        known = self.known
        for i, text in enumerate(texts):
            if not self.by_stretch or re.search(r"\s ", text):
                whole.append(i)
                continue
            first, *others = text.split(" ")
            stretches = [first] + [" " + s for s in others]
            new = [s for s in dict.fromkeys(stretches) if s not in known]
            if new:
                if len(known) > STRETCHES_KEPT:
                    known.clear()
                    new = list(dict.fromkeys(stretches))
                known.update(zip(new, self._encoded(new)))
            out[i] = sum(map(known.__getitem__, stretches))
        at = 0
        while at < len(whole):
            part, size = [], 0
            while at < len(whole) and size < BATCH_CHARS:
                part.append(whole[at])
                size += len(texts[whole[at]])
                at += 1
            for i, n in zip(part, self._encoded([texts[i] for i in part])):
                out[i] = n
        return out


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache, empty if there is none yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _counts_of(cache: DataFrame, digest: str) -> DataFrame:
    own = cache.filter(F.col("tokenizer") == digest)
    return own.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, text: str, definition: str, path: str) -> None:
    """Append the counts of the texts that the cache lacks."""
    spark = docs.sparkSession
    digest = tokenizer_digest(definition)
    shared = spark.sparkContext.broadcast(definition)  # a tokenizer's file, whatever the data

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        for batch in batches:
            n = counter.counts(batch["text"].tolist())
            yield pd.DataFrame({"tokenizer": digest, "content": batch["content"], "n_tokens": n})

    texts = docs.select(content(F.col(text)).alias("text"))
    texts = texts.withColumn("content", F.unhex(F.sha2("text", 256)))
    known = read_cache(spark, path).filter(F.col("tokenizer") == digest).select("content")
    misses = missing_texts(texts, known)
    if misses is not None:
        misses.mapInPandas(count, CACHE_SCHEMA).write.mode("append").parquet(path)


def missing_texts(texts: DataFrame, known: DataFrame) -> DataFrame | None:
    """One row (content, text) for each digest that ``known`` lacks; None if there is none."""
    if known.isEmpty():
        return _distinct(texts)
    missed = stored(texts.select("content").distinct().join(known, "content", "left_anti"), "missing-digests")
    n = missed.count()
    if not n:
        return None
    return _distinct(_may_miss(texts, missed, n)).join(missed, "content", "left_semi")


def _distinct(texts: DataFrame) -> DataFrame:
    return texts.groupBy("content").agg(F.first("text").alias("text"))


def _may_miss(texts: DataFrame, missed: DataFrame, n: int) -> DataFrame:
    """Texts whose digest may be one of the ``n`` missed ones, all of those among them."""
    bitmaps = min(BITMAPS, 1 + n * BITS_PER_MISS // BITMAP_BITS)
    place = F.pmod(F.xxhash64("content"), F.lit(bitmaps * BITMAP_BITS))
    block, bit = F.floor(place / BITMAP_BITS), place % BITMAP_BITS
    sketch = missed.select(block.alias("block"), bit.alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bitmap")
    )
    met = texts.select("*", block.alias("block"), bit.alias("bit")).join(F.broadcast(sketch), "block")
    byte = F.substring("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("bit") % 8).cast("int")) == 1
    return met.filter(is_set).select(*texts.columns)


def token_counts(docs: DataFrame, definition: str, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: the key, n_bytes and n_tokens; fills the cache at ``path`` first."""
    fill_cache(docs, text, definition, path)
    counts = _counts_of(read_cache(docs.sparkSession, path), tokenizer_digest(definition))
    value = content(F.col(text))
    rows = docs.select(
        F.col(key).alias(key),
        F.octet_length(value).cast("bigint").alias("n_bytes"),
        F.unhex(F.sha2(value, 256)).alias("content"),
    )
    return rows.join(counts, "content").drop("content")
