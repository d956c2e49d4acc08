"""Keep-first de-duplication.

Spark has no input order, so every operator takes an explicit ordering.
``groupBy(key).agg(min_by(struct(row), struct(order)))`` is a
partial/final hash aggregate: map tasks already keep one row per key, so
a key holding a third of the table costs one row per map task in the
shuffle, not a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str] | Column, order: Sequence[str],
               cols: Sequence[str] | None = None, key_name: str = "_key") -> DataFrame:
    """A1: one row per key, the one with the smallest ``order`` tuple.

    ``order`` must be unique within a key (append every selected column if
    the natural order has ties) so the result does not depend on
    partitioning. ``key`` may be a column expression (A2, A3); it is then
    materialised as ``key_name``.
    """
    cols = list(cols or df.columns)
    if isinstance(key, Column):
        df = df.withColumn(key_name, key)
        keys = [key_name]
    else:
        keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in cols if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in payload]),
                    F.struct(*[F.col(c) for c in order]))
    out = df.groupBy(*keys).agg(best.alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def dedupe_capped(df: DataFrame, group: str, pos: str, cap: int | None, value: str,
                  blocked: Column) -> DataFrame:
    """A4: hits at positions < cap (all if it is None), blank and blocked values dropped, then
    first occurrence of each value per group (a duplicate of a blocked value
    is blocked too, so block-after-seen gives the same rows)."""
    kept = df.where((F.lit(True) if cap is None else F.col(pos) < cap) & (F.coalesce(F.col(value), F.lit("")) != "") & ~blocked)
    return keep_first(kept, [group, value], [pos], cols=[group, value, pos])


LEDGER_BUCKETS = 256


class KeyLedger:
    """A3 across runs: which keys earlier runs have kept.

    The ledger is a folder of keys by key hash and run. A run reads only the
    hash folders in which its own new keys fall, and never its own entries,
    so that repeating a run gives the same rows. Keys of a run are written
    by ``commit``, after its output: a run that died before is simply
    repeated. Two runs give the rows of one if the first one's rows come first.
    """

    def __init__(self, path: str, key: str, key_type: str = "string", buckets: int = LEDGER_BUCKETS):
        self.path, self.key, self.buckets = path, key, buckets
        self.schema = f"{key} {key_type}, bucket int, run string"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def seen(self, spark, buckets: Sequence[int], run: str) -> DataFrame:
        """Keys that other runs have committed, of these hash folders only."""
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy("bucket", "run").parquet(self.path)
        ledger = spark.read.schema(self.schema).parquet(self.path)
        return ledger.where(F.col("bucket").isin(list(buckets)) & (F.col("run") != run)).select(self.key)

    def new(self, df: DataFrame, order: Sequence[str], run: str, cols: Sequence[str] | None = None) -> DataFrame:
        """Keep-first rows of ``df`` (as ``keep_first``) whose key no other run has.

        Rows with a NULL key have no identity and are all kept. The result is
        checkpointed: reading it again does not see what ``commit`` adds."""
        from leadsmith.session import cut_lineage
        cols = list(cols or df.columns)
        first = cut_lineage(keep_first(df.where(F.col(self.key).isNotNull()), self.key, order, cols))
        buckets = sorted(r[0] for r in first.select(self._bucket().alias("b")).distinct().collect())  # ``buckets`` numbers at most
        fresh = first.join(self.seen(df.sparkSession, buckets, run), self.key, "left_anti")
        return cut_lineage(fresh.select(*cols).unionByName(df.where(F.col(self.key).isNull()).select(*cols)))

    def commit(self, kept: DataFrame, run: str) -> None:
        """Enter the keys of ``kept`` under ``run``; again is the same as once."""
        keys = kept.where(F.col(self.key).isNotNull()).select(self.key, self._bucket().alias("bucket"), F.lit(run).alias("run"))
        (keys.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "run").parquet(self.path))
