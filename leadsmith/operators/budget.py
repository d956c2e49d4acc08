"""Running sums without a single-partition window.

``sum(x) over (order by k)`` with no partition key, or partitioned by a
key that holds a third of the rows, runs in one task. ``running_sum``
computes the same values in parallel:

1. range-partition on (group, order) and sort inside partitions;
2. per partition, a pandas cumulative sum per group (rows of a group are
   contiguous, so only the last group of a batch carries over);
3. reliable checkpoint, so both readers below see identical partitions;
4. per (partition, group) totals -> exclusive offsets of earlier
   partitions. Only the first group of a partition can have started in an
   earlier partition, so at most ``#partitions`` offsets are non-zero: that
   bounded table is the only thing broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsmith.session import cut_lineage


def _local_cumsum(group: list[str], value: str, out: str, integral: bool):
    def run(batches):
        pid = TaskContext.get().partitionId()
        carry_key, carry = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            v = pdf[value].fillna(0)
            v = v.astype("int64") if integral else v.astype("float64")
            if group:
                cum = v.groupby([pdf[g] for g in group], sort=False, dropna=False).cumsum()
                if carry_key is not None:
                    # rows are sorted by group: only leading rows can continue
                    same = np.ones(len(pdf), dtype=bool)
                    for g, k in zip(group, carry_key):
                        same &= (pdf[g].isna() if pd.isna(k) else pdf[g] == k).to_numpy(dtype=bool, na_value=False)
                    cum = cum + same.astype(cum.dtype) * carry
                last_key = tuple(pdf[g].iloc[-1] for g in group)
            else:
                cum = v.cumsum() + carry
                last_key = ()
            carry_key, carry = last_key, cum.iloc[-1]
            yield pdf.assign(_pid=pid, **{out: cum.values})
    return run


def running_sum(df: DataFrame, order: Sequence[str], value: str, group: Sequence[str] = (),
                out: str = "running", partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per ``group`` in ``order`` (unique)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group, order = list(group), list(order)
    keys = [*group, *order]
    integral = isinstance(df.schema[value].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
    vtype = T.LongType() if integral else T.DoubleType()
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    schema = T.StructType(list(df.schema.fields) + [T.StructField("_pid", T.IntegerType()),
                                                     T.StructField(out, vtype)])
    local = cut_lineage(ranged.mapInPandas(_local_cumsum(group, value, out, integral), schema))
    totals = local.groupBy("_pid", *group).agg(F.sum(F.coalesce(F.col(value).cast(vtype), F.lit(0).cast(vtype)))
                                               .alias("_tot"))
    w = Window.partitionBy(*group).orderBy("_pid") if group else Window.orderBy("_pid")
    offsets = (totals.withColumn("_off", F.coalesce(F.sum("_tot").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                    F.lit(0).cast(vtype)))
               .where(F.col("_off") != 0).select("_pid", *group, "_off"))
    # at most one non-zero offset per partition: a proven bound of n rows
    renamed = offsets.select(F.col("_pid").alias("_opid"), *(F.col(g).alias(f"_o_{g}") for g in group), "_off")
    match = F.col("_pid") == F.col("_opid")
    for g in group:  # a NULL group is a group like any other
        match &= local[g].eqNullSafe(F.col(f"_o_{g}"))
    joined = local.join(F.broadcast(renamed), match, "left").drop("_opid", *(f"_o_{g}" for g in group))
    return joined.withColumn(out, F.col(out) + F.coalesce(F.col("_off"), F.lit(0).cast(vtype))).drop("_pid", "_off")


def call_budget(df: DataFrame, order: Sequence[str], cost: Column | str, max_calls: int,
                partitions: int | None = None, min_cost: int | None = None) -> DataFrame:
    """Rows processed in order while the calls already made are < max.

    The budget is checked before a row, so a 2-call row may overshoot (C11).
    Adds ``cost``, ``calls_before`` (NULL for rows outside the budget) and
    ``within_budget``; both ways below give the same columns and values.

    ``min_cost >= 1`` is the caller's guarantee that every row costs at
    least one call. Then no row after position ``max_calls`` can be within
    budget, so the exact answer only needs the first ``max_calls`` rows in
    order: a bounded top-k (no full sort, no shuffle of the table), a
    running sum over those rows, and a join of that bounded set back.
    Without the guarantee the general skew-safe running sum is used.
    """
    c = F.col(cost) if isinstance(cost, str) else cost
    d = df.withColumn("cost", c.cast("bigint"))
    if min_cost is not None and min_cost >= 1:
        head = d.orderBy(*order).limit(max_calls)
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        first = head.select(*order, F.coalesce(F.sum("cost").over(w), F.lit(0)).cast("bigint").alias("calls_before"))
        out = d.join(first, list(order), "left")
        return _budget_flags(out, max_calls)
    rs = running_sum(d, order, "cost", out="_cum", partitions=partitions)
    return _budget_flags(rs.withColumn("calls_before", F.col("_cum") - F.coalesce("cost", F.lit(0))).drop("_cum"), max_calls)


def _budget_flags(df: DataFrame, max_calls: int) -> DataFrame:
    within = F.coalesce(F.col("calls_before") < max_calls, F.lit(False))
    return df.withColumn("within_budget", within).withColumn("calls_before", F.when(F.col("within_budget"), F.col("calls_before")))


def quota_slots(df: DataFrame, group: Sequence[str], order: Sequence[str], cap: int,
                partitions: int | None = None) -> DataFrame:
    """W8 batch form: the k-th call of a caller goes in window floor((k-1)/cap)."""
    d = df.withColumn("_one", F.lit(1).cast("bigint"))
    rs = running_sum(d, order, "_one", group=group, out="call_no", partitions=partitions).drop("_one")
    return rs.withColumn("window_no", F.floor((F.col("call_no") - 1) / cap).cast("bigint"))
