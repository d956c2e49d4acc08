"""De-duplication, ranking, sort/limit/sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.operators import dedupe as DD
from leadsmith.operators import ranking as RK
from leadsmith.operators import sorting as S
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

PRIORITY = ["urgent", "high", "medium"]
LI_COLS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("a01_dedup_keep_first", f"""
SELECT l_partkey, {', '.join(LI_COLS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(LI_COLS)}) = 1""")
def a01_dedup_keep_first(spark, sf):
    """A1: keep-first per raw key; the order spans every selected column
    because (l_orderkey, l_linenumber) is not unique."""
    li = table(spark, sf, "lineitem")
    return DD.keep_first(li, "l_partkey", LI_COLS, cols=["l_partkey", *LI_COLS])


_A2_NAME = "concat(p_name, ' Co.')"


@register("a02_dedup_normalized", f"""
WITH t AS (SELECT p_partkey, p_brand, trim(regexp_replace(regexp_replace(regexp_replace(lower({_A2_NAME}),
  '\\b(inc|llc|ltd|co|corp|company|equipment)\\b\\.?', '', 'g'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS name_key FROM part)
SELECT name_key, p_partkey, p_brand FROM t QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY p_partkey) = 1""")
def a02_dedup_normalized(spark, sf):
    """A2: keep-first on the normalised company key."""
    p = table(spark, sf, "part")
    return DD.keep_first(p, X.company_key(F.expr(_A2_NAME)), ["p_partkey"], cols=["p_partkey", "p_brand"],
                         key_name="name_key")


_A3_PATH = "concat('edgar/data/', o_custkey, '/', lpad(CAST(o_orderkey // 3 AS VARCHAR), 10, '0'), '.txt')"


@register("a03_dedup_accession", f"""
WITH t AS (SELECT o_orderkey, o_orderdate,
  coalesce(nullif(regexp_extract({_A3_PATH}, '(?i)edgar/data/[0-9]+/([^/]+)\\.(txt|htm|html)$', 1), ''), {_A3_PATH}) AS accession
  FROM orders)
SELECT accession, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM t
QUALIFY row_number() OVER (PARTITION BY accession ORDER BY o_orderdate, o_orderkey) = 1""")
def a03_dedup_accession(spark, sf):
    """A3: the same filing listed on several days counts once (first day)."""
    o = table(spark, sf, "orders")
    path = Q.spark_expr(_A3_PATH)
    t = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderdate")
    return DD.keep_first(t.withColumn("p", path), X.accession(F.col("p")), ["o_orderdate", "o_orderkey"],
                         cols=["o_orderkey", "day"], key_name="accession")


@register("a04_dedup_capped", f"""
WITH h AS (SELECT page_id % 10 AS result_page, page_id // 10 AS pos,
  trim(lower(replace({Q.netloc('url')}, 'www.', ''))) AS domain FROM pages),
k AS (SELECT * FROM h WHERE pos < 10 AND domain <> '' AND NOT {Q.contains_any('domain', ['blog', 'cheap-pills'])})
SELECT result_page, domain, pos FROM k QUALIFY row_number() OVER (PARTITION BY result_page, domain ORDER BY pos) = 1""")
def a04_dedup_capped(spark, sf):
    """A4: cap the hit list first, then parse, block and de-duplicate."""
    return _a04_hits(spark, sf, 10)


@register("a04_dedup_all", f"""
WITH h AS (SELECT page_id % 10 AS result_page, page_id // 10 AS pos,
  trim(lower(replace({Q.netloc('url')}, 'www.', ''))) AS domain FROM pages),
k AS (SELECT * FROM h WHERE domain <> '' AND NOT {Q.contains_any('domain', ['blog', 'cheap-pills'])})
SELECT result_page, domain, pos FROM k QUALIFY row_number() OVER (PARTITION BY result_page, domain ORDER BY pos) = 1""")
def a04_dedup_all(spark, sf):
    """A4 without the cap: every hit is read."""
    return _a04_hits(spark, sf, None)


def _a04_hits(spark, sf, cap):
    p = table(spark, sf, "pages")
    h = p.select((F.col("page_id") % 10).alias("result_page"), (F.col("page_id") / 10).cast("bigint").alias("pos"),
                 D.domain_loose("url").alias("domain"))
    return DD.dedupe_capped(h, "result_page", "pos", cap, "domain",
                            D.blocked_substring("domain", ["blog", "cheap-pills"]))


@register("w01_priority_pick", f"""
SELECT o_custkey, o_orderkey, o_orderpriority, {Q.keyword_rank('o_orderpriority', PRIORITY)} AS title_rank FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {Q.keyword_rank('o_orderpriority', PRIORITY)}, o_orderkey) = 1""")
def w01_priority_pick(spark, sf):
    o = table(spark, sf, "orders")
    return RK.priority_pick(o, "o_custkey", "o_orderpriority", PRIORITY, "o_orderkey",
                            ["o_orderkey", "o_orderpriority"])


@register("w02_priority_confidence", f"""
SELECT o_custkey, o_orderkey, o_totalprice, {Q.keyword_rank('o_orderpriority', PRIORITY, 3)} AS title_rank FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY {Q.keyword_rank('o_orderpriority', PRIORITY, 3)}, -coalesce(o_totalprice, 0), o_orderkey) = 1""")
def w02_priority_confidence(spark, sf):
    """Rank, then highest confidence (NULL counts as 0, C20); else-rank =
    list length."""
    o = table(spark, sf, "orders")
    return RK.priority_pick(o, "o_custkey", "o_orderpriority", PRIORITY, "o_orderkey",
                            ["o_orderkey", "o_totalprice"], default_rank=len(PRIORITY), confidence="o_totalprice")


W3_KEYWORDS = ["tion"]


@register("w03_first_match", f"""
SELECT conv_id, arg_min(turn, turn) FILTER (WHERE {Q.contains_any('text', W3_KEYWORDS)}) AS turn,
       arg_min(role, turn) FILTER (WHERE {Q.contains_any('text', W3_KEYWORDS)}) AS role
FROM conversations GROUP BY conv_id""")
def w03_first_match(spark, sf):
    c = table(spark, sf, "conversations")
    return RK.first_match(c, "conv_id", "turn", X.contains_any("text", W3_KEYWORDS), ["turn", "role"])


@register("w04_match_else_first", """
WITH a AS (SELECT conv_id, arg_min(turn, turn) FILTER (WHERE role = 'assistant') AS m_turn,
                  arg_min(turn, turn) AS f_turn, arg_min(role, turn) AS f_role FROM conversations GROUP BY conv_id)
SELECT conv_id, coalesce(m_turn, f_turn) AS turn, CASE WHEN m_turn IS NOT NULL THEN 'assistant' ELSE f_role END AS role,
       CASE WHEN m_turn IS NOT NULL THEN 'Assistant' ELSE 'General/Unknown' END AS title,
       CASE WHEN m_turn IS NOT NULL THEN 'matched' ELSE 'fallback' END AS outcome
FROM a""")
def w04_match_else_first(spark, sf):
    """W4 + R10: first match, else first of all with a default title."""
    c = table(spark, sf, "conversations")
    out = RK.match_else_first(c, "conv_id", "turn", F.col("role") == "assistant", ["turn", "role"])
    return out.select("conv_id", "turn", "role",
                      F.when(F.col("outcome") == "matched", F.lit("Assistant"))
                      .otherwise(F.lit("General/Unknown")).alias("title"), "outcome")


CASCADE_SQL = """CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 0 WHEN contains(lower(o_orderpriority), 'high') THEN 1
  WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END"""


@register("w05_cascade", f"""
SELECT o_custkey, o_orderkey, o_orderpriority,
  ['ops', 'exec', 'generic', 'no_title'][{CASCADE_SQL} + 1] AS outcome FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {CASCADE_SQL}, o_orderkey) = 1""")
def w05_cascade(spark, sf):
    """Ops keywords -> exec keywords -> any title -> first row."""
    o = table(spark, sf, "orders")
    levels = [("ops", X.contains_any("o_orderpriority", ["urgent"])),
              ("exec", X.contains_any("o_orderpriority", ["high"])),
              ("generic", F.col("o_orderstatus") == "F")]
    return RK.cascade(o, "o_custkey", "o_orderkey", levels, ["o_orderkey", "o_orderpriority"], "no_title")


@register("w06_recent_n", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 15""")
def w06_recent_n(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return RK.recent_n(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 15).drop("ts")


@register("o01_sort_multi", "SELECT p_type, p_size, p_name, p_partkey FROM part ORDER BY p_type, p_size, p_name, p_partkey")
def o01_sort_multi(spark, sf):
    p = table(spark, sf, "part").select("p_type", "p_size", "p_name", "p_partkey")
    return S.sorted_output(p, ["p_type", "p_size", "p_name", "p_partkey"])


@register("o02_sort_name", "SELECT n_name, n_nationkey FROM nation ORDER BY n_name")
def o02_sort_name(spark, sf):
    return S.sorted_output(table(spark, sf, "nation").select("n_name", "n_nationkey"), ["n_name", "n_nationkey"])


@register("o03_head_n", "SELECT r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 3")
def o03_head_n(spark, sf):
    """O3: head-N of a seed list with an explicit ordinal (the limit is the feature)."""
    return S.head(table(spark, sf, "region"), ["r_regionkey"], 3)


@register("o04_limit_valid", f"""
SELECT doc_id FROM documents WHERE {Q.nonblank('text')} AND lang = 'en' ORDER BY doc_id LIMIT 20""")
def o04_limit_valid(spark, sf):
    """The limit counts valid rows, so the filter comes first."""
    d = table(spark, sf, "documents")
    return S.head(d.where(X.nonblank("text") & (F.col("lang") == "en")).select("doc_id"), ["doc_id"], 20)


@register("o05_sample", """
SELECT c_custkey, c_name FROM customer ORDER BY md5(concat('42:', CAST(c_custkey AS VARCHAR))), c_custkey LIMIT 30""")
def o05_sample(spark, sf):
    """Exact-size seeded sample min(30, n)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return S.seeded_sample(c, "c_custkey", 30, seed=42)
