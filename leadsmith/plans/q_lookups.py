"""Lookup joins and error policies.

The driver tables stand in for landed service responses: customers are
companies, orders are the contacts a people/email service returned for a
company, line items are the people of an organisation, parts the
person-match table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import text as X
from leadsmith.operators import lookup as L
from leadsmith.operators import ranking as RK
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

PRIORITY = ["urgent", "high", "medium"]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_RANK = Q.keyword_rank("o_orderpriority", PRIORITY)

BEST_ORDER_SQL = f"""SELECT o_custkey, o_orderkey, o_orderpriority, {_RANK} AS title_rank FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_RANK}, o_orderkey) = 1"""
FIRST_LINE_SQL = f"""SELECT l_orderkey, {', '.join(LINE_ORDER)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) = 1"""


def _first_lines(spark, sf):
    li = table(spark, sf, "lineitem")
    return RK.best_per_group(li, "l_orderkey", LINE_ORDER, LINE_ORDER)


@register("j01_contact_lookup", f"""
WITH b AS ({BEST_ORDER_SQL})
SELECT c_custkey, c_name, o_orderkey, o_orderpriority, title_rank,
       CASE WHEN title_rank IS NOT NULL THEN 'contacts:found' ELSE 'contacts:not_found' END AS source
FROM customer LEFT JOIN b ON c_custkey = o_custkey""")
def j01_contact_lookup(spark, sf):
    """Best-ranked contact per company, reduced before the join."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return L.contact_lookup(c, o, "c_custkey", "o_orderpriority", PRIORITY, "o_orderkey",
                            ["o_orderkey", "o_orderpriority"], found="contacts:found", missing="contacts:not_found")


@register("j02_two_step_lookup", f"""
WITH bo AS ({BEST_ORDER_SQL}), bl AS ({FIRST_LINE_SQL})
SELECT c_custkey, bo.o_orderkey, bl.l_linenumber, bl.l_partkey,
  CASE WHEN bo.o_orderkey IS NULL THEN 'no_order' WHEN bl.l_orderkey IS NULL THEN 'no_line' ELSE 'ok' END AS outcome
FROM customer LEFT JOIN bo ON c_custkey = bo.o_custkey LEFT JOIN bl ON bo.o_orderkey = bl.l_orderkey""")
def j02_two_step_lookup(spark, sf):
    """Company -> organisation (first ranked hit) -> its best person."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders")
    bo = RK.priority_pick(o, "o_custkey", "o_orderpriority", PRIORITY, "o_orderkey", ["o_orderkey"])
    bl = _first_lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey",
                                         F.lit(True).alias("_line"))
    j = (c.join(bo.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "left")
         .join(bl, "o_orderkey", "left"))
    outcome = (F.when(F.col("o_orderkey").isNull(), F.lit("no_order"))
               .when(F.col("_line").isNull(), F.lit("no_line")).otherwise(F.lit("ok")))
    return j.select("c_custkey", "o_orderkey", "l_linenumber", "l_partkey", outcome.alias("outcome"))


_J3_EMAIL = "CASE WHEN p_size % 3 = 0 THEN '' ELSE concat(replace(p_name, ' ', '.'), '@example.com') END"


@register("j03_id_chain", f"""
WITH fl AS ({FIRST_LINE_SQL}),
m AS (SELECT p_partkey, {_J3_EMAIL} AS email FROM part)
SELECT o_orderkey, fl.l_partkey AS person_id, m.email,
  CASE WHEN fl.l_orderkey IS NULL THEN 'people:none' WHEN fl.l_partkey IS NULL THEN 'people:no_id'
       WHEN coalesce(m.email, '') = '' THEN 'match:no_email' ELSE 'match:ok' END AS outcome
FROM orders LEFT JOIN fl ON o_orderkey = fl.l_orderkey LEFT JOIN m ON fl.l_partkey = m.p_partkey""")
def j03_id_chain(spark, sf):
    """Domain -> first person -> e-mail by person id, distinct labels
    for no people / no id / no e-mail."""
    o = table(spark, sf, "orders").select("o_orderkey")
    fl = _first_lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"),
                                         F.col("l_partkey").alias("person_id"), F.lit(True).alias("_p"))
    m = table(spark, sf, "part").select(F.col("p_partkey").alias("person_id"),
                                        F.expr(_J3_EMAIL).alias("email"))
    j = o.join(fl, "o_orderkey", "left").join(m, "person_id", "left")
    outcome = (F.when(F.col("_p").isNull(), F.lit("people:none"))
               .when(F.col("person_id").isNull(), F.lit("people:no_id"))
               .when(~X.nonblank("email"), F.lit("match:no_email"))
               .otherwise(F.lit("match:ok")))
    return j.select("o_orderkey", "person_id", "email", outcome.alias("outcome"))


@register("j04_fallback_fill", """
WITH p AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS title, arg_min(CAST(o_orderkey AS VARCHAR), o_orderkey) AS email
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
s AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS title, arg_min(CAST(o_orderkey AS VARCHAR), o_orderkey) AS email
      FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
SELECT c_custkey, coalesce(nullif(trim(p.email), ''), nullif(trim(s.email), '')) AS email,
       coalesce(nullif(trim(p.title), ''), nullif(trim(s.title), '')) AS title,
       CASE WHEN coalesce(trim(p.email), '') <> '' THEN 'primary' WHEN coalesce(trim(s.email), '') <> '' THEN 'secondary'
            ELSE 'not_found' END AS source
FROM customer LEFT JOIN p ON c_custkey = p.o_custkey LEFT JOIN s ON c_custkey = s.o_custkey""")
def j04_fallback_fill(spark, sf):
    """Secondary source fills only what the primary left blank."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus",
                                          F.col("o_orderpriority").alias("title"),
                                          F.col("o_orderkey").cast("string").alias("email"))
    prim = RK.best_per_group(o.where(F.col("o_orderstatus") == "F"), "c_custkey", ["o_orderkey"], ["email", "title"])
    sec = RK.best_per_group(o.where(F.col("o_orderstatus") == "O"), "c_custkey", ["o_orderkey"], ["email", "title"])
    return L.fallback_fill(c, prim, sec, "c_custkey", ["email", "title"], ("primary", "secondary", "not_found"))


@register("j09_merge_back", """
SELECT s_suppkey, s_name, s_nationkey,
       CASE WHEN s_nationkey < 10 THEN round(s_acctbal + 1.0, 2) ELSE s_acctbal END AS s_acctbal FROM supplier""")
def j09_merge_back(spark, sf):
    """Enriched rows replace originals by a unique key; row count kept."""
    s = table(spark, sf, "supplier")
    upd = s.where(F.col("s_nationkey") < 10).select("s_suppkey", F.round(F.col("s_acctbal") + 1.0, 2).alias("s_acctbal"))
    return L.merge_back(s, upd, "s_suppkey", ["s_acctbal"])


@register("j10_batched_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, p_size
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def j10_batched_lookup(spark, sf):
    """The 50-ids-per-request batches become one equi join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size")
    return li.join(p, "l_partkey")


_J11_HANDLE = "concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0'))"


@register("j11_handle_resolution", f"""
WITH h AS (SELECT DISTINCT CASE WHEN starts_with(trim({_J11_HANDLE}), '@') THEN trim({_J11_HANDLE})
                                ELSE concat('@', trim({_J11_HANDLE})) END AS handle FROM orders),
c AS (SELECT c_custkey, concat('@', trim(c_name)) AS handle FROM customer)
SELECT h.handle, c.c_custkey AS channel_id, CASE WHEN c.c_custkey IS NULL THEN 'unknown handle' END AS error
FROM h LEFT JOIN c ON h.handle = c.handle""")
def j11_handle_resolution(spark, sf):
    """Handle -> id; unmatched handles carry an error (E2 dead letter)."""
    o = table(spark, sf, "orders")
    h = o.select(X.handle(Q.spark_expr(_J11_HANDLE)).alias("handle")).distinct()
    c = table(spark, sf, "customer").select(X.handle("c_name").alias("handle"),
                                            F.col("c_custkey").alias("channel_id"))
    j = h.join(c, "handle", "left")
    return j.withColumn("error", F.when(F.col("channel_id").isNull(), F.lit("unknown handle")))


@register("j12_chain", """
SELECT c_custkey, count(l_orderkey) AS n_items, round(coalesce(sum(l_quantity), 0), 4) AS total_qty
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY c_custkey""")
def j12_chain(spark, sf):
    """Channel -> playlist -> videos -> stats as chained equi joins.
    Statistics are reduced per video (order) before the first join and per
    channel after it, so the shuffles carry one row per order, then one per
    customer, never raw line items; a hot channel is pre-aggregated."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    per_video = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")))
    j = L.chain(o, [(per_video, "o_orderkey")], how="inner")
    per_channel = j.groupBy("c_custkey").agg(F.sum("n").alias("n_items"), F.sum("q").alias("q"))
    return L.chain(c, [(per_channel, "c_custkey")], how="inner").select(
        "c_custkey", "n_items", F.round(F.coalesce("q", F.lit(0.0)), 4).alias("total_qty"))


@register("j13_document_attach", """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS location, d.source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j13_document_attach(spark, sf):
    """Index row left-joined to its document; a missing document gives
    a blank field, the row is kept."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("")).alias("location"), "source")


@register("e02_dead_letter", f"""
SELECT event_id, CASE WHEN NOT regexp_matches(coalesce(trim(json_extract_string(props, '$.k')), ''), '{X.NUMERIC_RE}')
  THEN 'bad k' WHEN value < 1.0 THEN 'low value' END AS error FROM events""")
def e02_dead_letter(spark, sf):
    """Per-row failure isolation: an error column instead of a failed job."""
    e = table(spark, sf, "events")
    k = F.coalesce(X.strip(F.get_json_object("props", "$.k")), F.lit(""))
    err = F.when(~k.rlike(X.NUMERIC_RE), F.lit("bad k")).when(F.col("value") < 1.0, F.lit("low value"))
    return e.select("event_id", err.alias("error"))


@register("e03_on_error", f"""
WITH fl AS ({FIRST_LINE_SQL})
SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN fl ON o_orderkey = l_orderkey WHERE l_orderkey IS NOT NULL""")
def e03_on_error(spark, sf):
    """Policy 'drop' removes rows whose enrichment failed (no line)."""
    o = table(spark, sf, "orders").select("o_orderkey")
    fl = _first_lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    j = o.join(fl, "o_orderkey", "left")
    return L.on_error(j, F.col("l_linenumber").isNull(), "drop")


@register("e03_on_error_default", f"""
WITH fl AS ({FIRST_LINE_SQL})
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR l_linenumber IS NULL THEN -1 ELSE l_linenumber END AS l_linenumber
FROM orders LEFT JOIN fl ON o_orderkey = l_orderkey""")
def e03_on_error_default(spark, sf):
    """Policy 'default' fills rows whose enrichment failed (no line, or
    one key in seven, so some rows fail at any scale)."""
    o = table(spark, sf, "orders").select("o_orderkey")
    fl = _first_lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    failed = F.col("l_linenumber").isNull() | (F.col("o_orderkey") % 7 == 0)
    return L.on_error(o.join(fl, "o_orderkey", "left"), failed, "default", {"l_linenumber": F.lit(-1)})
