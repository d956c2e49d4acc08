"""Sinks.

Outputs are written by the executors in parallel; a single file is only
produced when explicitly asked for (small reports). Blank strings are
written as ``""`` so a round trip keeps blank and missing apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadsmith.functions.text import nonblank
from leadsmith.sources.landed import select_existing


def ordered_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str],
                partitions: int | None = None, single_file: bool = False) -> None:
    """K1/K2: existing columns in a fixed order, globally sorted, header,
    UTF-8. The sort is a range-partitioned shuffle; part files concatenated
    in name order are in order."""
    out = select_existing(df, columns)
    keys = [c for c in order if c in out.columns]
    if single_file:
        out = out.coalesce(1).sortWithinPartitions(*keys)
    else:
        n = partitions or df.sparkSession.sparkContext.defaultParallelism
        out = out.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    (out.write.mode("overwrite").option("header", True).option("emptyValue", "")
        .option("encoding", "UTF-8").csv(path))


def nested_json(df: DataFrame, path: str, manifest: DataFrame | None = None) -> None:
    """K3: one JSON object per row (nested structs kept) plus an optional
    one-row manifest beside it; never one giant array in one task."""
    df.write.mode("overwrite").json(f"{path}/items")
    if manifest is not None:
        manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


@dataclass(frozen=True)
class RunMode:
    """K4: test/demo/full runs differ only in caps and output path."""
    name: str = "full"
    row_cap: int | None = None
    call_cap: int | None = None
    output: str = "out"

    def apply(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        return df.orderBy(*order).limit(self.row_cap) if self.row_cap else df


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """K5: resume: rows not yet in the output (append the result later)."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K5: append a finished batch (no rewrite of the whole output)."""
    df.write.mode("append").format(fmt).save(path)


def preview(df: DataFrame, columns: Sequence[str], present: str) -> DataFrame:
    """K6: rows where ``present`` is non-blank, a few columns."""
    return df.where(nonblank(present)).select(*columns)


class CommitLedger:
    """K5: output in batches, each written and committed at most once.

    A batch is a folder ``data/run=<run>/batch=<batch>`` that only ever gets
    overwritten as a whole, and an entry in the ledger that is made after
    it. ``read`` returns committed batches only, so a job killed between the
    two leaves nothing visible, and repeating it adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], "run string, batch bigint").write.mode("ignore").partitionBy("run").parquet(f"{self.path}/ledger")

    def entries(self) -> DataFrame:
        """(run, batch) of all commits."""
        return self.spark.read.schema("batch bigint, run string").parquet(f"{self.path}/ledger").select("run", "batch")

    def committed(self, run: str) -> set[int]:
        """The batches of one run (a number each)."""
        return {r["batch"] for r in self.entries().where(F.col("run") == run).collect()}

    def write(self, df: DataFrame, run: str, batch: int) -> None:
        """Write and commit a batch, unless it is committed already."""
        if batch in self.committed(run):
            return
        df.write.mode("overwrite").parquet(f"{self.path}/data/run={run}/batch={batch}")
        self.commit(run, batch)

    def commit(self, run: str, batch: int) -> None:
        """Enter a written batch; from then on it is read and not written again."""
        entry = self.spark.createDataFrame([(run, batch)], "run string, batch bigint")
        entry.coalesce(1).write.mode("append").partitionBy("run").parquet(f"{self.path}/ledger")

    def sink(self, run: str) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: a micro-batch that is replayed after a restart is not written again."""
        return lambda df, batch: self.write(df, run, batch)

    def read(self, schema) -> DataFrame:
        """All committed rows, with ``run`` and ``batch``; folders of other batches are pruned."""
        data = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data")
        done = self.entries().distinct()
        return data.join(done, (data["run"].cast("string") == done["run"]) & (data["batch"].cast("bigint") == done["batch"]), "left_semi")


def resumable(ledger: CommitLedger, todo: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], run: str, batches: int = 16) -> None:
    """K5: ``work`` over ``todo`` in ``batches`` by key hash, each committed when done.

    ``todo`` is staged once in folders by batch, so a batch reads its own rows
    only; a repeated run takes up the staged rows and does the batches that
    are not committed. NULL keys are a batch like any other.
    """
    spark, stage = ledger.spark, f"{ledger.path}/stage/run={run}"
    staged = CommitLedger(spark, f"{ledger.path}/staged")
    if 0 not in staged.committed(run):
        keyed = todo.withColumn("_batch", F.pmod(F.xxhash64(key), F.lit(batches)).cast("int"))
        keyed.write.mode("overwrite").partitionBy("_batch").parquet(stage)
        staged.write(spark.range(1).select(F.lit(batches).alias("batches")), run, 0)
    done = ledger.committed(run)
    rows = spark.read.schema(f"{_ddl(todo)}, _batch int").parquet(stage)
    for b in range(batches):
        if b not in done:
            ledger.write(work(rows.where(F.col("_batch") == b).drop("_batch")), run, b)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
