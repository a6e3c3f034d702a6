"""``python -m tests.skewed_files FROM TO [COPIES]``: a larger copy of the star files with hot keys.

A third of all orders goes to one customer, and a third of all lines each to one
order and to one product.
"""

import sys

from pyspark.sql import functions as F

from tests.run_compare import local_session

STEPS = {  # added to the keys with each copy
    "customer": {"c_custkey": 100_000},
    "part": {"p_partkey": 100_000},
    "orders": {"o_orderkey": 1_000_000, "o_custkey": 100_000},
    "lineitem": {"l_orderkey": 1_000_000, "l_partkey": 100_000},
    "nation": {},
}
HOT = {"orders": {"o_custkey": 1}, "lineitem": {"l_orderkey": 2, "l_partkey": 3}}


def main(source: str, target: str, copies: str = "20") -> None:
    spark = local_session("skewed files")
    for table, steps in STEPS.items():
        df = spark.read.parquet(f"{source}/{table}.parquet")
        if steps:
            copy = F.explode(F.sequence(F.lit(0), F.lit(int(copies) - 1)))
            df = df.repartition(16).withColumn("copy", copy)
        for key, step in steps.items():
            df = df.withColumn(key, F.col(key) + F.col("copy") * step)
        for key, value in HOT.get(table, {}).items():
            chosen = F.rand(value) < 1 / 3
            df = df.withColumn(key, F.when(chosen, F.lit(value).cast("bigint")).otherwise(F.col(key)))
        df.drop("copy").write.parquet(f"{target}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
