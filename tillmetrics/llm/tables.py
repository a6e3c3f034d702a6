"""What the operators share: reading tables, writing intermediate ones, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there.

    The copy stays until the owner of ``spark.checkpoint.dir`` expires it, as a
    lost executor may need it again for as long as the result is in use.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves ``remainder``; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
