"""Streaming queries run to completion with ``availableNow``.

Each builder runs its stream over the landed table file, writes to a
fresh folder under the shared checkpoint directory and returns a batch
read of the output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadsmith.operators import ranking as RK
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.session import checkpoint_dir
from leadsmith.sources.tables import table
from leadsmith.streaming import enrich as ST

PRIORITY = ["urgent", "high", "medium"]


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("t01_incremental_enrichment", f"""
WITH b AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {Q.keyword_rank('o_orderpriority', PRIORITY)}, o_orderkey) = 1)
SELECT c_custkey, c_name, o_orderkey, o_orderpriority FROM customer LEFT JOIN b ON c_custkey = o_custkey""")
def t01_incremental_enrichment(spark, sf):
    """Companies arrive as files; each new file is enriched with the best
    contact and appended exactly once (restart-safe via the checkpoint)."""
    cust = table(spark, sf, "customer")
    orders = table(spark, sf, "orders")
    best = RK.priority_pick(orders, "o_custkey", "o_orderpriority", PRIORITY, "o_orderkey",
                            ["o_orderkey", "o_orderpriority"]).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    base = _scratch(spark, "t01")
    ST.incremental_enrichment(spark, sf, cust.schema, best, "c_custkey", f"{base}/out", f"{base}/ckpt",
                              glob="customer.parquet")
    return spark.read.parquet(f"{base}/out").select("c_custkey", "c_name", "o_orderkey", "o_orderpriority")


_FMT = "%Y-%m-%d %H:%M:%S.%f"


@register("t02_event_quota", f"""
WITH RECURSIVE e AS (
  SELECT user_id AS caller, event_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (
  SELECT caller, rn, event_id, t AS now, t AS start, 1 AS n, false AS deferred FROM e WHERE rn = 1
  UNION ALL
  SELECT caller, rn, event_id,
         CASE WHEN n1 >= 50 THEN start1 + 60000000 ELSE now0 END,
         CASE WHEN n1 >= 50 THEN start1 + 60000000 ELSE start1 END,
         CASE WHEN n1 >= 50 THEN 1 ELSE n1 + 1 END,
         n1 >= 50
  FROM (SELECT e.caller, e.rn, e.event_id, greatest(e.t, r.now) AS now0,
               CASE WHEN greatest(e.t, r.now) - r.start >= 60000000 THEN greatest(e.t, r.now) ELSE r.start END AS start1,
               CASE WHEN greatest(e.t, r.now) - r.start >= 60000000 THEN 0 ELSE r.n END AS n1
        FROM r JOIN e ON e.caller = r.caller AND e.rn = r.rn + 1) s)
SELECT caller, event_id, strftime(make_timestamp(now), '{_FMT}') AS admitted_at,
       strftime(make_timestamp(start), '{_FMT}') AS window_start, deferred
FROM r""")
def t02_event_quota(spark, sf):
    """Admission time of every event under a 50-per-60-s window anchored
    at each caller's first call; state per caller in the state store, where
    events wait for the watermark until the stream is closed."""
    ev = table(spark, sf, "events")
    base = _scratch(spark, "t02")
    ST.run_quota_stream(spark, sf, ev.schema, "user_id", f"{base}/out", f"{base}/ckpt", cap=50, window_sec=60.0,
                        glob="events.parquet", close=True)
    out = spark.read.parquet(f"{base}/out").where("outcome = 'admitted'")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return out.select("caller", "event_id", F.date_format("admitted_at", fmt).alias("admitted_at"),
                      F.date_format("window_start", fmt).alias("window_start"), "deferred")
