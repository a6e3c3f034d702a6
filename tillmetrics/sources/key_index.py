"""Which keys a stored part holds, without reading them: a Bloom filter in blocks.

A key's hash names one of the part's buckets, ``BITS`` further hashes each a bit of the bucket's bitmap.
A bucket is a row of 4 KB, so the index is a table that grows with the keys, two bytes each,
and new keys meet it in a join by bucket. A key whose bits are not all set is not stored.
The others are suspects, a few in a thousand of the keys that are new, and are looked up in
the stored rows themselves, which stay where they are: suspects are sent to them, in portions
of a bounded size. Parts whose keys lie in another range than the new ones are not consulted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.schemas import Table
from tillmetrics.session import shared_folder
from tillmetrics.sources import snapshots
from tillmetrics.sources.snapshots import KeyRange, Part, Version

BUCKET_BITS = 32768  # what bitmap_construct_agg makes
KEYS_PER_BUCKET = 2048  # 16 bits a key
BITS = 8  # set per key
PORTION_BYTES = 16 << 20  # of suspects sent to every task at once
PORTIONS = 32  # that are worth a pass over the stored keys each


def _bucket(key: Column, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bucket")), buckets if isinstance(buckets, Column) else F.lit(buckets))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BUCKET_BITS)) for i in range(BITS)]


def ranges(rows: DataFrame, columns: tuple[str, ...]) -> dict[str, KeyRange]:
    """Count, least and largest key of each column that has one, from a single scan."""
    found = rows.agg(
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("n", F.count), ("min", F.min), ("max", F.max))]
    ).first()
    return {
        c: KeyRange(n, found[f"min_{c}"], found[f"max_{c}"], math.ceil(n / KEYS_PER_BUCKET))
        for c in columns
        if (n := found[f"n_{c}"])
    }


def write(rows: DataFrame, keys: dict[str, KeyRange], path: str) -> None:
    """Write the index of a part's key columns."""
    for column, known in keys.items():
        key = F.col(column)
        named = rows.filter(key.isNotNull()).select(key.alias("key"), _bucket(key, known.buckets).alias("bucket"))
        # Dealt by bucket first, as a bitmap is far larger than the few keys of it that a task has, and
        # as keys, which are shorter than their bits. A bitmap per hash, so that a key is sorted once.
        dealt = named.repartition("bucket")
        each = [F.bitmap_construct_agg(bit).alias(f"bits_{i}") for i, bit in enumerate(_bits(F.col("key")))]
        bitmaps = dealt.groupBy("bucket").agg(*each)
        layers = bitmaps.select("bucket", F.explode(F.array(*[f"bits_{i}" for i in range(BITS)])).alias("bits"))
        whole = layers.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bitmap"))
        whole.write.mode("overwrite").parquet(f"{path}/column={column}")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def _overlapping(version: Version, column: str, new: KeyRange) -> list[Part]:
    """Parts that could hold keys of the range."""
    return [
        p
        for p in version.parts
        if (known := p.keys.get(column)) and known.least <= new.largest and new.least <= known.largest
    ]


def suspects(spark: SparkSession, table_folder: str, parts: list[Part], column: str, keys: DataFrame) -> DataFrame:
    """Distinct ``key``s of ``keys`` that one of the parts may hold."""
    sizes = {snapshots.index_folder(p): p.keys[column].buckets for p in parts}
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.lit(b).alias("buckets")) for i, b in enumerate(sizes.values())]))
    probes = keys.select("key", wanted.alias("to")).select("key", "to.part", _bucket(F.col("key"), F.col("to.buckets")).alias("bucket"))
    index = None
    for i, folder in enumerate(sizes):
        path = f"{table_folder}/{folder}/column={column}"
        own = spark.read.schema("bucket bigint, bitmap binary").parquet(path).withColumn("part", F.lit(i))
        index = own if index is None else index.unionByName(own)
    met = probes.join(index, ["part", "bucket"])
    for bit in _bits(F.col("key")):
        met = met.filter(_is_set(F.col("bitmap"), bit))
    return met.select("key").distinct()


def _key_bytes(table: Table, column: str) -> int:
    kind = table.schema[column].dataType
    return 4 * table.max_length.get(column, 256) if isinstance(kind, T.StringType) else 16


def looked_up(stored_keys: DataFrame, some: DataFrame) -> DataFrame:
    """Those of ``some`` (a bounded number of) keys that are among the stored ones.

    Stored keys are filtered in place; only hits are shuffled.
    """
    return stored_keys.join(F.broadcast(some), "key", "left_semi").distinct()


def _held(table: Table, table_folder: str, parts: list[Part], column: str, found: DataFrame) -> list[DataFrame]:
    """Those of the keys ``found`` (written, distinct) that the parts hold, in portions looked up one by one."""
    spark = found.sparkSession
    stored = snapshots.read(spark, table_folder, parts, T.StructType([table.schema[column]]))
    stored = stored.select(F.col(column).alias("key"))
    portions = math.ceil(found.count() * _key_bytes(table, column) / PORTION_BYTES)
    if portions > PORTIONS:  # so many keys are met in a join
        return [stored.join(found, "key", "left_semi").distinct()]
    of = F.pmod(F.xxhash64("key", F.lit("portion")), F.lit(max(1, portions)))
    return [looked_up(stored, found.filter(of == i)) for i in range(portions)]


def absent(table: Table, table_folder: str, version: Version, column: str, references: DataFrame) -> DataFrame:
    """The distinct ``key``s of ``references`` that no row of the version has.

    What the index does not know is absent without a look at the rows; the rest is looked up where
    the rows lie, so the table referred to is not shuffled but for very many references.
    """
    spark = references.sparkSession
    keys = references.select("key").filter("key IS NOT NULL").distinct()
    parts = [p for p in version.parts if column in p.keys]
    if not parts:
        return keys
    folder = shared_folder(spark, "references")
    suspects(spark, table_folder, parts, column, keys).write.parquet(folder)
    out = keys
    for held in _held(table, table_folder, parts, column, spark.read.parquet(folder)):
        out = out.join(held, "key", "left_anti")
    return out


def stored_again(table: Table, table_folder: str, version: Version, column: str, rows: DataFrame, new: KeyRange | None) -> int:
    """How many distinct keys of ``rows`` the version holds already."""
    parts = _overlapping(version, column, new) if new else []
    if not parts:
        return 0
    spark = rows.sparkSession
    keys = rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("key"))
    folder = shared_folder(spark, "suspects")
    try:
        suspects(spark, table_folder, parts, column, keys).write.parquet(folder)
        held = _held(table, table_folder, parts, column, spark.read.parquet(folder))
        return sum(keys.count() for keys in held)
    finally:
        snapshots.remove(spark, folder)
