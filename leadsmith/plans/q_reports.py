"""Reports, budgets and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import text as X
from leadsmith.operators import budget as B
from leadsmith.operators import metrics as M
from leadsmith.operators import ranking as RK
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

RECENT_SQL = """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 15"""


@register("a05_funnel", f"""
SELECT count(*) AS n_raw,
  count(*) FILTER (WHERE {Q.nonblank('p_name')}) AS n_nonblank,
  count(*) FILTER (WHERE {Q.nonblank('p_name')} AND CAST(trunc(p_retailprice / 20.0) AS BIGINT) BETWEEN 5 AND 50) AS n_in_range,
  count(DISTINCT CASE WHEN {Q.nonblank('p_name')} AND CAST(trunc(p_retailprice / 20.0) AS BIGINT) BETWEEN 5 AND 50
                 THEN p_name END) AS n_unique
FROM part""")
def a05_funnel(spark, sf):
    """A5: every stage count from one aggregate pass (no join of counts)."""
    from leadsmith.operators.predicates import in_range
    p = table(spark, sf, "part")
    stages = [("nonblank", X.nonblank("p_name")), ("in_range", in_range(F.col("p_retailprice") / 20.0, 5, 50))]
    return M.funnel(p, stages, distinct=("unique", "p_name"))


_A6_BASE = f"""WITH fl AS (SELECT l_orderkey, {', '.join(['l_linenumber', 'l_partkey', 'l_suppkey', 'l_quantity', 'l_extendedprice'])},
  l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) = 1),
t AS (SELECT coalesce(CAST(l_linenumber AS VARCHAR), '') AS line,
             coalesce(CASE WHEN l_returnflag = 'R' THEN l_returnflag END, '') AS flag
      FROM orders LEFT JOIN fl ON o_orderkey = l_orderkey)"""


@register("a06_coverage", f"""{_A6_BASE}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE {Q.nonblank('line')}) AS n_line,
       count(*) FILTER (WHERE {Q.nonblank('flag')}) AS n_flag,
       round(count(*) FILTER (WHERE {Q.nonblank('line')}) * 100.0 / greatest(count(*), 1), 1) AS pct_line,
       round(count(*) FILTER (WHERE {Q.nonblank('flag')}) * 100.0 / greatest(count(*), 1), 1) AS pct_flag
FROM t""")
def a06_coverage(spark, sf):
    """Non-blank share per output column, % with one decimal."""
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    fl = RK.best_per_group(li, "l_orderkey", order, ["l_linenumber", "l_returnflag"])
    t = o.join(fl.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left").select(
        F.coalesce(F.col("l_linenumber").cast("string"), F.lit("")).alias("line"),
        F.coalesce(F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")), F.lit("")).alias("flag"))
    return M.coverage(t, ["line", "flag"])


@register("a09_hit_rate", """
WITH u AS (SELECT DISTINCT o_custkey FROM orders WHERE contains(lower(o_orderpriority), 'urgent'))
SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS n_attempted,
       count(*) FILTER (WHERE c_acctbal >= 0 AND u.o_custkey IS NOT NULL) AS n_hits,
       count(*) FILTER (WHERE c_acctbal < 0) AS n_errors,
       round(count(*) FILTER (WHERE c_acctbal >= 0 AND u.o_custkey IS NOT NULL) * 100.0
             / greatest(count(*) FILTER (WHERE c_acctbal >= 0), 1), 1) AS hit_pct
FROM customer LEFT JOIN u ON c_custkey = u.o_custkey""")
def a09_hit_rate(spark, sf):
    """Hits over attempts, failed rows excluded from both."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    u = (table(spark, sf, "orders").where(X.contains_any("o_orderpriority", ["urgent"]))
         .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_hit", F.lit(True)))
    j = c.join(u, "c_custkey", "left")
    return M.hit_rate(j, F.col("_hit").isNotNull(), F.col("c_acctbal") < 0)


def _engagement(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    recent = RK.recent_n(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 15)
    # counts are integers, as view/like/comment statistics are
    v = lambda t: F.when(F.col("event_type") == t, F.round(F.col("value") * 100).cast("bigint"))
    return M.engagement(recent, "user_id", v("view"), v("click"), v("purchase"))


_ENG_SQL = f"""WITH r AS ({RECENT_SQL}),
c AS (SELECT user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cnt FROM r),
g AS (SELECT user_id, count(*) AS n_sampled,
  sum(coalesce(CASE WHEN event_type = 'view' THEN cnt END, 0)) AS tv,
  sum(coalesce(CASE WHEN event_type = 'click' THEN cnt END, 0)) AS tl,
  sum(coalesce(CASE WHEN event_type = 'purchase' THEN cnt END, 0)) AS tc,
  sum(coalesce(CASE WHEN event_type = 'view' THEN cnt END, 0)) / count(*) AS mv FROM c GROUP BY user_id)"""


@register("a10_engagement_totals", f"""{_ENG_SQL}
SELECT user_id, n_sampled, CAST(tv AS BIGINT) AS total_views, CAST(tl AS BIGINT) AS total_likes,
       CAST(tc AS BIGINT) AS total_comments FROM g""")
def a10_engagement_totals(spark, sf):
    """A10: totals with missing counts as 0."""
    return _engagement(spark, sf).select("user_id", "n_sampled", "total_views", "total_likes", "total_comments")


@register("a11_mean_views", f"""{_ENG_SQL}
SELECT user_id, round(mv, 2) AS mean_views FROM g""")
def a11_mean_views(spark, sf):
    """Total views / sampled items (an item without a view count
    counts as 0 and is still sampled), 2 dp, NULL when none."""
    return _engagement(spark, sf).select("user_id", "mean_views")


@register("a12_engagement", f"""{_ENG_SQL}
SELECT user_id, round((tl + tc) * 100.0 / nullif(tv, 0), 4) AS engagement_rate FROM g""")
def a12_engagement(spark, sf):
    """(likes + comments) / views * 100, 4 dp, NULL when no views."""
    return _engagement(spark, sf).select("user_id", "engagement_rate")


@register("a13_empty_sample", """
WITH s AS (SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS total_qty, round(avg(l_quantity), 2) AS mean_qty
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(n_items, 0) AS n_items, round(coalesce(total_qty, 0), 4) AS total_qty, mean_qty
FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def a13_empty_sample(spark, sf):
    """Entities without a sample get zeros and NULL means, not dropped."""
    o = table(spark, sf, "orders").select("o_orderkey")
    s = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg(F.count(F.lit(1)).alias("n_items"), F.sum("l_quantity").alias("total_qty"),
              F.round(F.avg("l_quantity"), 2).alias("mean_qty")))
    out = M.empty_sample(o, "o_orderkey", s, ["n_items", "total_qty"])
    return out.withColumn("total_qty", F.round("total_qty", 4))


@register("a14_manifest", """
SELECT CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) FILTER (WHERE r_name IS NULL) = 0 THEN 'SUCCESS'
            WHEN count(*) FILTER (WHERE r_name IS NULL) < count(*) THEN 'PARTIAL' ELSE 'FAILED' END AS status,
       count(*) AS n_processed, count(*) FILTER (WHERE r_name IS NULL) AS n_failed FROM region""")
def a14_manifest(spark, sf):
    """Batch manifest with a status derived from failures."""
    r = table(spark, sf, "region")
    return M.manifest(r, F.col("r_name").isNull())


@register("a14_manifest_partial", """
SELECT CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) FILTER (WHERE c_acctbal < 0) = 0 THEN 'SUCCESS'
            WHEN count(*) FILTER (WHERE c_acctbal < 0) < count(*) THEN 'PARTIAL' ELSE 'FAILED' END AS status,
       count(*) AS n_processed, count(*) FILTER (WHERE c_acctbal < 0) AS n_failed FROM customer""")
def a14_manifest_partial(spark, sf):
    """A14 where some rows fail (customers in debt)."""
    return M.manifest(table(spark, sf, "customer"), F.col("c_acctbal") < 0)


@register("a15_total_contactable", """
WITH u AS (SELECT DISTINCT o_custkey FROM orders WHERE contains(lower(o_orderpriority), 'urgent'))
SELECT count(*) FILTER (WHERE c_acctbal > 0) AS n_primary,
       count(*) FILTER (WHERE NOT (c_acctbal > 0) AND u.o_custkey IS NOT NULL) AS n_enriched,
       count(*) FILTER (WHERE c_acctbal > 0 OR u.o_custkey IS NOT NULL) AS n_contactable
FROM customer LEFT JOIN u ON c_custkey = u.o_custkey""")
def a15_total_contactable(spark, sf):
    """Registry contacts + contacts found by enrichment."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    u = (table(spark, sf, "orders").where(X.contains_any("o_orderpriority", ["urgent"]))
         .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_hit", F.lit(True)))
    j = c.join(u, "c_custkey", "left")
    prim = F.coalesce(F.col("c_acctbal") > 0, F.lit(False))
    enr = F.col("_hit").isNotNull()
    return j.agg(F.count_if(prim).alias("n_primary"), F.count_if(~prim & enr).alias("n_enriched"),
                 F.count_if(prim | enr).alias("n_contactable"))


@register("w07_budget", """
WITH c AS (SELECT o_orderkey, CAST(1 + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS cost FROM orders),
s AS (SELECT o_orderkey, cost, sum(cost) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cost AS calls_before FROM c)
SELECT o_orderkey, cost, CAST(calls_before AS BIGINT) AS calls_before FROM s WHERE calls_before < 500""")
def w07_budget(spark, sf):
    """Rows processed while calls already made < 500; a 2-call row may
    overshoot (C11). Skew-safe running sum, no single-partition window."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    cost = 1 + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    out = B.call_budget(o, ["o_orderkey"], cost, 500, min_cost=1)  # cost is 1 or 2 by construction
    return out.where("within_budget").select("o_orderkey", "cost", "calls_before")


@register("w08_quota_slots", """
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS call_no,
       CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 50) AS BIGINT) AS window_no
FROM events""")
def w08_quota_slots(spark, sf):
    """W8 batch form: the k-th call per caller goes to window floor((k-1)/50);
    per-caller numbering is computed without putting a hot caller in one task."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return B.quota_slots(e, ["user_id"], ["ts", "event_id"], 50).select("event_id", "user_id", "call_no", "window_no")
