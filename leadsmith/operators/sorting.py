"""Sort, head-N and exact-size sampling.

A global sort is a range-partitioned shuffle plus a per-partition sort:
no single task sees all rows. Head-N with an ordering plans as
TakeOrderedAndProject (a bounded top-k per task, then merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_output(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """O1/O2: globally ordered rows (ascending), range-partitioned."""
    if partitions:
        df = df.repartitionByRange(partitions, *keys)
        return df.sortWithinPartitions(*keys)
    return df.orderBy(*keys)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows by an explicit order."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exact-size reproducible sample: the n smallest md5(seed:key).

    ``df.sample`` is Bernoulli (size varies); this is exactly min(n, rows)
    and is the same on every engine that has md5.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
