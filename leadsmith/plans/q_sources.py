"""Sources, dates, documents and set operations (SURVEY S*, D*, X*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import calendar as CAL
from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.operators import budget as B
from leadsmith.operators import candidates as C
from leadsmith.operators import documents as DOC
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.session import checkpoint_dir
from leadsmith.sources import landed as S
from leadsmith.sources.tables import table


def _scratch(spark, name: str) -> str:
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("s01_paged_scan", """
WITH r AS (SELECT c_nationkey AS state, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
           FROM customer)
SELECT state, CAST((rn - 1) // 20 AS BIGINT) AS page, count(*) AS n_rows FROM r GROUP BY ALL""")
def s01_paged_scan(spark, sf):
    """Registry rows paged per partition key (20 per page, key order),
    landed as JSON under ``state=`` folders and scanned back with an
    explicit schema (no inference pass); the state folders become a
    partition column, so a filter on state prunes whole folders."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("state"), "c_custkey", "c_name")
    numbered = B.quota_slots(c, ["state"], ["c_custkey"], 20).withColumnRenamed("window_no", "page")
    path = _scratch(spark, "registry")
    numbered.select("state", "page", "c_custkey", "c_name").write.partitionBy("state").mode("overwrite").json(path)
    pages = S.registry_pages(spark, path, "c_custkey bigint, c_name string, state int, page bigint")
    return pages.groupBy("state", "page").agg(F.count(F.lit(1)).alias("n_rows"))


@register("s02_page_prefix", """
WITH p AS (SELECT l_returnflag AS k, l_orderkey // 4 AS page FROM lineitem),
c AS (SELECT k, page, count(*) AS n FROM p GROUP BY k, page),
g AS (SELECT k, min(page) + 1 AS gap FROM c
      WHERE NOT EXISTS (SELECT 1 FROM c c2 WHERE c2.k = c.k AND c2.page = c.page + 1) GROUP BY k),
s AS (SELECT k, min(page) FILTER (WHERE n < 16) AS short, min(page) AS first, max(page) AS last FROM c GROUP BY k),
t AS (SELECT s.k, last, least(coalesce(short, gap), gap - 1, CASE WHEN first > 0 THEN -1 END) AS stop
      FROM s JOIN g USING (k))
SELECT p.k, count(*) AS n_rows, count(DISTINCT p.page) AS n_pages, bool_or(last > stop) AS truncated
FROM p JOIN t USING (k) WHERE p.page <= stop GROUP BY p.k""")
def s02_page_prefix(spark, sf):
    """Each key ends at its first short page or before its first missing
    page; rows after the cut are not read (reported by ``truncated``)."""
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"),
                                            (F.col("l_orderkey") / 4).cast("bigint").alias("page"))
    kept = S.page_prefix(li, "k", "page", 16)
    return kept.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("page").alias("n_pages"),
                                 F.bool_or("truncated").alias("truncated"))


@register("s02_page_flags", """
WITH r AS (SELECT c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS rn FROM customer),
p AS (SELECT k, CAST(rn // 2 AS BIGINT) AS page FROM r WHERE NOT (k % 5 = 0 AND rn // 2 = 2) AND NOT (k % 5 = 1 AND rn = 3)),
c AS (SELECT k, page, count(*) AS n FROM p GROUP BY k, page),
g AS (SELECT k, min(page) + 1 AS gap FROM c
      WHERE NOT EXISTS (SELECT 1 FROM c c2 WHERE c2.k = c.k AND c2.page = c.page + 1) GROUP BY k),
s AS (SELECT k, min(page) FILTER (WHERE n < 2) AS short, min(page) AS first, max(page) AS last FROM c GROUP BY k),
t AS (SELECT s.k, last, least(coalesce(short, gap), gap - 1, CASE WHEN first > 0 THEN -1 END) AS stop
      FROM s JOIN g USING (k))
SELECT p.k, page, last > stop AS truncated, page > stop AS after_gap, count(*) AS n_rows FROM p JOIN t USING (k) GROUP BY ALL""")
def s02_page_flags(spark, sf):
    """S2 without the cut, on pages that are mostly full (two rows each; page 2
    of every fifth key is missing, page 1 of the next key is short): every row
    stays, with flags."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey")
    numbered = B.quota_slots(c, ["k"], ["c_custkey"], 2).withColumnRenamed("window_no", "page")
    landed = numbered.where(~((F.col("k") % 5 == 0) & (F.col("page") == 2)) & ~((F.col("k") % 5 == 1) & (F.col("call_no") == 4)))
    kept = S.page_prefix(landed, "k", "page", 2, cut=False)
    return kept.groupBy("k", "page", "truncated", "after_gap").agg(F.count(F.lit(1)).alias("n_rows"))


_S3_JSON = """to_json(named_struct('results', array(named_struct(
  'basic', named_struct('organization_name', CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_name END),
  'addresses', filter(array(named_struct('city', n_name, 'state', r_name)), a -> c_custkey % 7 <> 0)))))"""


def _s03_results(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    pages = j.select("c_custkey", F.expr(_S3_JSON).alias("body"))
    return S.registry_results(pages, "body", ["c_custkey"])


@register("s03_nested_scan", """
SELECT c_custkey, CAST(0 AS INTEGER) AS pos, c_name AS name, n_name AS city, r_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE NOT (c_acctbal < 0) AND c_custkey % 7 <> 0 ORDER BY c_custkey LIMIT 150""")
def s03_nested_scan(spark, sf):
    """S3: nested registry JSON -> name + first address, invalid rows skipped,
    stop after 150 valid rows (the cap is the feature)."""
    return _s03_results(spark, sf).orderBy("c_custkey", "pos").limit(150)


@register("s03_nested_scan_all", """
SELECT c_custkey, CAST(0 AS INTEGER) AS pos, c_name AS name, n_name AS city, r_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE NOT (c_acctbal < 0) AND c_custkey % 7 <> 0""")
def s03_nested_scan_all(spark, sf):
    """S3 without the cap: every valid row."""
    return _s03_results(spark, sf)


_FORM = "CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'D/A' ELSE '10-K' END"
_NAME = "concat('Customer ', CAST(o_custkey AS VARCHAR), ' ', o_orderpriority)"
_CIK = "lpad(CAST(o_custkey AS VARCHAR), 10, '0')"
_PATH = "concat('edgar/data/', CAST(o_custkey AS VARCHAR), '/', lpad(CAST(o_orderkey AS VARCHAR), 10, '0'), '.txt')"


def _ymd_spark():
    return F.date_format("o_orderdate", "yyyyMMdd")


@register("s04_fixed_width", f"""
SELECT o_orderkey, {_FORM} AS form_type, {_NAME} AS company_name,
  coalesce(nullif(regexp_replace({_CIK}, '^0+', ''), ''), '0') AS cik,
  strftime(o_orderdate, '%Y%m%d') AS date_filed, {_PATH} AS rel_path
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def s04_fixed_width(spark, sf):
    """S4 + F18 + N11: orders rendered as a fixed-width daily index (with
    header and dash lines), then parsed back columnar."""
    o = table(spark, sf, "orders")
    v = Q.spark_expr
    line = F.concat(F.rpad(v(_FORM), 12, " "), F.rpad(v(_NAME), 62, " "), v(_CIK), F.lit("  "), _ymd_spark(),
                    F.lit("  "), v(_PATH))
    lines = o.select(line.alias("value"))
    header = (table(spark, sf, "region").select(F.concat(F.lit("Form Type   Company Name "), F.col("r_name")).alias("value"))
              .unionByName(table(spark, sf, "region").select(F.lit("-" * 120).alias("value"))))
    # land the rendered index as text files in the shared scratch folder and
    # scan them back, as daily index files would be read
    path = _scratch(spark, "index")
    lines.unionByName(header).write.mode("overwrite").text(path)
    parsed = S.index_rows(spark.read.text(path), "value")
    return parsed.select(F.regexp_extract("rel_path", r"/0*([0-9]+)\.txt$", 1).cast("bigint").alias("o_orderkey"),
                         "form_type", "company_name", "cik", "date_filed", "rel_path")


@register("s05_whole_documents", """
SELECT concat('doc/', CAST(doc_id AS VARCHAR), '.txt') AS path, length(text) AS n_text, md5(text) AS text_md5 FROM documents""")
def s05_whole_documents(spark, sf):
    """S5 on the documents table (one row per document, whole text)."""
    d = table(spark, sf, "documents")
    return d.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                    F.length("text").cast("bigint").alias("n_text"), F.md5("text").alias("text_md5"))


@register("s06_csv_roundtrip", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, '' AS owner_email
FROM nation""")
def s06_csv_roundtrip(spark, sf):
    """S6 + S13 + K1: write as CSV (blank kept as ""), read back all-string,
    NULL -> '', back-fill a missing column."""
    import uuid
    n = table(spark, sf, "nation")
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    from leadsmith.sinks import ordered_csv
    ordered_csv(n, path, ["n_nationkey", "n_name", "n_regionkey"], ["n_nationkey"], single_file=True)
    back = S.read_csv_strings(spark, path, ["n_nationkey", "n_name", "n_regionkey"])
    return S.backfill(back, ["n_nationkey", "owner_email"])


@register("s09_result_links", """
WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)">([^<]+)</a>', 1) AS hrefs,
                  regexp_extract_all(html, '<a href="([^"]+)">([^<]+)</a>', 2) AS titles FROM pages),
u AS (SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS href, unnest(titles) AS title FROM h)
SELECT page_id, pos, trim(href) AS href, trim(title) AS title FROM u WHERE pos < 10 AND trim(href) <> ''""")
def s09_result_links(spark, sf):
    """(href, title) pairs from result HTML, first 10 per page."""
    p = table(spark, sf, "pages").select("page_id", "html")
    return S.result_links(p, "html", ["page_id"], 10, pattern=r'<a href="([^"]+)">([^<]+)</a>')


@register("s11_homepage_join", f"""
WITH h AS (SELECT page_id % 50 AS grp, page_id, {Q.domain_netloc('url')} AS domain FROM pages),
f AS (SELECT grp, arg_min(domain, page_id) FILTER (WHERE NOT {Q.contains_any('domain', ['blog', 'cheap-pills'])}) AS domain
      FROM h GROUP BY grp),
home AS (SELECT {Q.domain_netloc('url')} AS domain, min(page_id) AS home_page FROM pages GROUP BY 1)
SELECT grp, f.domain, home_page FROM f LEFT JOIN home ON f.domain = home.domain""")
def s11_homepage_join(spark, sf):
    """Company domain -> its landed homepage (first page of the host)."""
    p = table(spark, sf, "pages")
    hits = p.select((F.col("page_id") % 50).alias("grp"), "page_id", D.domain_netloc("url").alias("domain"))
    best = C.first_valid(hits, "grp", ["page_id"], ~D.blocked_substring("domain", ["blog", "cheap-pills"]),
                         ["domain"]).select("grp", "domain")
    home = p.groupBy(D.domain_netloc("url").alias("domain")).agg(F.min("page_id").alias("home_page"))
    return best.join(home, "domain", "left").select("grp", "domain", "home_page")


@register("s13_backfill", "SELECT p_partkey, p_name, '' AS owner_name, '' AS owner_email FROM part")
def s13_backfill(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return S.backfill(p, ["p_name", "owner_name", "owner_email"])


@register("d01_last_days", """
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS today FROM orders),
d AS (SELECT CAST(today - INTERVAL (i) DAY AS DATE) AS day FROM m, range(1, 8) t(i)),
c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT d.day, coalesce(c.n, 0) AS n_orders FROM d LEFT JOIN c USING (day)""")
def d01_last_days(spark, sf):
    """The 7 days before 'today' (here: the newest order day), with counts."""
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    today = o.agg(F.max("day").alias("today"))
    days = today.select(F.explode(F.sequence(F.date_sub("today", 7), F.date_sub("today", 1))).alias("day"))
    counts = o.groupBy("day").agg(F.count(F.lit(1)).alias("n_orders"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@register("d02_latest_available", """
WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
t AS (SELECT max(day) + 3 AS today FROM e)
SELECT max(day) AS day FROM e, t WHERE day BETWEEN today - 4 AND today - 1""")
def d02_latest_available(spark, sf):
    """Newest day with data within a 4-day look-back before 'today'."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    today = e.agg(F.date_add(F.max("day"), 3)).scalar()  # scalar subquery, no join
    return e.where(F.col("day").between(F.date_sub(today, 4), F.date_sub(today, 1))).agg(F.max("day").alias("day"))


@register("d03_missing_days", """
WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
t AS (SELECT max(day) + 5 AS today FROM e),
w AS (SELECT CAST(today - INTERVAL (i) DAY AS DATE) AS day FROM t, range(1, 41) r(i))
SELECT day FROM w WHERE day NOT IN (SELECT day FROM e)""")
def d03_missing_days(spark, sf):
    """D3: requested days without data are reported, not fatal."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    t = e.agg(F.date_add(F.max("day"), 5).alias("today"))
    wanted = t.select(F.explode(F.sequence(F.date_sub("today", 40), F.date_sub("today", 1))).alias("day"))
    return CAL.missing_days(wanted, e)


_X1_DOC = """CASE s_suppkey % 5
 WHEN 0 THEN concat('<SEC-DOCUMENT>\n<edgarSubmission xmlns="http://example.org/d"><primaryIssuer><issuerAddress>',
   '<street1>1 Main</street1><stateOrCountry>', n_name, '</stateOrCountry></issuerAddress></primaryIssuer></edgarSubmission>')
 WHEN 1 THEN concat('<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry> </stateOrCountry>',
   '<stateOrCountryDescription>', r_name, '</stateOrCountryDescription></issuerAddress></primaryIssuer></edgarSubmission>')
 WHEN 2 THEN concat('<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry>', n_name,
   '</issuerAddress></edgarSubmission>\nBUSINESS ADDRESS:\n  STREET 1: 1 MAIN\n  STATE: ', r_name, '\n')
 WHEN 3 THEN concat('HEADER\nSTATE OF INCORPORATION: ', n_name, '\n')
 ELSE 'no location here' END"""


@register("x01_location", """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN n_name WHEN 1 THEN r_name WHEN 2 THEN split_part(r_name, ' ', 1) WHEN 3 THEN n_name
  ELSE '' END AS location
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def x01_location(spark, sf):
    """X1 + X2: issuer state (or description) from the XML part, malformed
    XML falls through to the header, then incorporation, else ''."""
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    docs = j.select("s_suppkey", F.expr(_X1_DOC).alias("doc"))
    return docs.select("s_suppkey", DOC.filing_location("doc").alias("location"))


@register("x03_visible_text", f"""
WITH s AS (SELECT page_id, {Q.shown_html('html')} AS shown FROM pages),
v AS (SELECT page_id, {Q.page_text('shown')} AS text, {Q.tel_count('shown')} AS tel_count FROM s)
SELECT page_id, CAST(length(text) AS INTEGER) AS n_text, md5(text) AS text_md5, tel_count,
       CASE WHEN tel_count > 0 THEN concat(tel_count, ' click-to-call (tel:) links') END AS tel_note FROM v""")
def x03_visible_text(spark, sf):
    """X3 + X4: visible text and tel: link count per page (Arrow UDF, one
    evaluation per row)."""
    p = table(spark, sf, "pages").select("page_id", "html")
    v = DOC.visible_text("html").alias("v")
    out = p.select("page_id", v).select("page_id", F.length("v.text").alias("n_text"),
                                        F.md5("v.text").alias("text_md5"), F.col("v.tel_count").alias("tel_count"))
    return out.withColumn("tel_note", DOC.tel_note("tel_count"))


_X04_WORDS = (("call us",), ("le ",), ("ción",))
_X04_SCORE, _X04_SYSTEM, _X04_REASON = Q.rubric("text", "tel_count", *_X04_WORDS)


@register("x04_tel_links", f"""
WITH s AS (SELECT page_id, {Q.shown_html(Q.TEL_HTML)} AS shown FROM pages),
v AS (SELECT page_id, {Q.page_text('shown')} AS text, {Q.tel_count('shown')} AS tel_count FROM s)
SELECT page_id, CAST(length(text) AS INTEGER) AS n_text, tel_count,
       CASE WHEN tel_count > 0 THEN concat(tel_count, ' click-to-call (tel:) links') END AS tel_note,
       {_X04_SCORE} AS icp_score, {_X04_SYSTEM} AS booking_system, {_X04_REASON} AS reasoning FROM v""")
def x04_tel_links(spark, sf):
    """X4 + X5: every page with click-to-call links in its menu (not shown, not
    counted), in its article, or as all that it has; links alone are
    phone-first evidence, a page without links and text is blank."""
    p = table(spark, sf, "pages").select("page_id", Q.spark_expr(Q.TEL_HTML).alias("html"))
    v = p.select("page_id", DOC.visible_text("html").alias("v")).select("page_id", F.col("v.text").alias("text"), F.col("v.tel_count").alias("tel_count"))
    phone, forms, portals = _X04_WORDS
    out = DOC.with_rubric(v, "text", phone, forms, portals, out="s", tel="tel_count")
    return out.select("page_id", F.length("text").alias("n_text"), "tel_count", DOC.tel_note("tel_count").alias("tel_note"),
                      "s.icp_score", "s.booking_system", "s.reasoning")


PHONE = ["the"]
FORMS = ["le"]
PORTALS = ["ción"]


def _occ_sql(w: str) -> str:
    return f"CAST((length(lower(text)) - length(replace(lower(text), '{w}', ''))) / {len(w)} AS INTEGER)"


@register("x05_rubric", f"""
WITH h AS (SELECT doc_id, text, {_occ_sql(PHONE[0])} AS hp, {_occ_sql(FORMS[0])} AS hf, {_occ_sql(PORTALS[0])} AS hb FROM documents)
SELECT doc_id,
  CAST(CASE WHEN NOT {Q.nonblank('text')} THEN 0 WHEN hb > 0 THEN 10 + least(20, hb) WHEN hp > 0 THEN 90 + least(10, hp)
       WHEN hf > 0 THEN 70 + least(19, hf) ELSE 1 END AS INTEGER) AS icp_score,
  CASE WHEN NOT {Q.nonblank('text')} THEN 'Unknown' WHEN hb > 0 THEN 'Portal' WHEN hp > 0 THEN 'Phone Only'
       WHEN hf > 0 THEN 'Email/Form' ELSE 'None' END AS booking_system
FROM h""")
def x05_rubric(spark, sf):
    """X5 + X7: deterministic rubric tiers (portals first), blank text -> 0."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    s = DOC.with_rubric(d, "text", PHONE, FORMS, PORTALS, out="s")
    return s.select("doc_id", F.col("s.icp_score").alias("icp_score"), F.col("s.booking_system").alias("booking_system"))


_X6_RESP = """CASE event_id % 6
 WHEN 0 THEN concat('{"icp_score": ', CAST(CAST(round(value * 10) AS BIGINT) AS VARCHAR), ', "booking_system": " ', event_type, ' ", "agentic_reasoning": "ok"}')
 WHEN 1 THEN concat('{"icp_score": "', CAST(CAST(round(value) AS BIGINT) AS VARCHAR), '", "booking_system": "Phone", "agentic_reasoning": "quoted"}')
 WHEN 2 THEN concat('{"icp_score": ', CAST(CAST(round(value) AS BIGINT) AS VARCHAR), '.7, "booking_system": "Form", "agentic_reasoning": "float"}')
 WHEN 3 THEN '{"icp_score": "high", "booking_system": "x", "agentic_reasoning": "bad"}'
 WHEN 4 THEN '{"icp_score": 50, "booking_system": "x"}'
 ELSE concat('not json ', event_type) END"""


@register("x06_validate_response", f"""
WITH r AS (SELECT event_id, value, event_type, {_X6_RESP} AS resp FROM events)
SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN CAST(greatest(1, least(100, round(value * 10))) AS INTEGER)
                    WHEN 1 THEN CAST(greatest(1, least(100, round(value))) AS INTEGER)
                    WHEN 2 THEN CAST(greatest(1, least(100, round(value))) AS INTEGER) ELSE 0 END AS icp_score,
  CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN 'Phone' WHEN 2 THEN 'Form' ELSE 'Unknown' END AS booking_system,
  CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'quoted' WHEN 2 THEN 'float' WHEN 3 THEN 'Scoring error: ValueError'
    WHEN 4 THEN 'Failed to parse response.' ELSE 'response parsing failed.' END AS reasoning
FROM r""")
def x06_validate_response(spark, sf):
    """Scorer responses validated: keys, int(), clamp, cut, defaults."""
    e = table(spark, sf, "events")
    r = e.select("event_id", Q.spark_expr(_X6_RESP).alias("resp"))
    v = DOC.with_validated_response(r, "resp", out="v")
    return v.select("event_id", F.col("v.icp_score").alias("icp_score"), F.col("v.booking_system").alias("booking_system"),
                    F.col("v.reasoning").alias("reasoning"))


@register("x09_nested_json", """
WITH r AS (SELECT user_id, event_id, event_type FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 15)
SELECT user_id, CAST(to_json({'handle': concat('@user', CAST(user_id AS VARCHAR)),
  'recent_totals': {'n': count(*), 'views': count(*) FILTER (WHERE event_type = 'view'),
                    'clicks': count(*) FILTER (WHERE event_type = 'click')}}) AS VARCHAR) AS profile
FROM r GROUP BY user_id""")
def x09_nested_json(spark, sf):
    """A nested profile per entity as one JSON object per row."""
    from leadsmith.operators.ranking import recent_n
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    r = recent_n(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 15)
    g = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "view").alias("views"),
                                 F.count_if(F.col("event_type") == "click").alias("clicks"))
    prof = F.struct(F.concat(F.lit("@user"), F.col("user_id").cast("string")).alias("handle"),
                    F.struct("n", "views", "clicks").alias("recent_totals"))
    return g.select("user_id", F.to_json(prof).alias("profile"))


@register("u01_union_pages", """
SELECT c_custkey, c_nationkey FROM customer""")
def u01_union_pages(spark, sf):
    """Per-key page sets appended by name (one scan per source)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    parts = [c.where(F.col("c_mktsegment") == s).select("c_nationkey", "c_custkey") for s in segs]
    rest = c.where(~F.col("c_mktsegment").isin(segs) | F.col("c_mktsegment").isNull()).select("c_nationkey", "c_custkey")
    out = rest
    for p in parts:
        out = out.unionByName(p)
    return out


@register("u03_split_union", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'registry' WHEN o.o_custkey IS NOT NULL THEN 'enriched' ELSE 'not_found' END AS source
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o ON c_custkey = o.o_custkey""")
def u03_split_union(spark, sf):
    """U3: 'has contact' and 'enriched' handled in one pass with a flag,
    instead of split / process / union."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    u = (table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
         .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_e", F.lit(True)))
    j = c.join(u, "c_custkey", "left")
    src = (F.when(F.col("c_acctbal") > 0, "registry").when(F.col("_e").isNotNull(), "enriched")
           .otherwise("not_found"))
    return j.select("c_custkey", src.alias("source"))


@register("s05_whole_files", """
SELECT item_id, md5(text || chr(10)) AS text_md5 FROM benchmark""")
def s05_whole_files(spark, sf):
    """Benchmark items landed as one text file each and read back whole
    (the text writer ends a file with a line break)."""
    path = _scratch(spark, "s05")
    table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    files = S.whole_documents(spark, f"{path}/*/*.txt")
    return files.select(F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("bigint").alias("item_id"), F.md5("text").alias("text_md5"))


@register("s07_csv_inferred", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey % 5 > 1""")
def s07_csv_inferred(spark, sf):
    """Customers landed as CSV, some without a name and some with a blank
    one, read back with inferred types; unnamed rows drop (C4)."""
    path = _scratch(spark, "s07")
    name = F.when(F.col("c_nationkey") % 5 > 1, F.col("c_name")).when(F.col("c_nationkey") % 5 == 1, F.lit("  "))
    table(spark, sf, "customer").select("c_custkey", name.alias("c_name"), "c_acctbal").write.csv(path, header=True)
    back = S.read_csv_inferred(spark, path, ["c_name"])
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal")


@register("s08_seed_list", """
WITH s(ordinal, segment, label) AS (VALUES (0, 'BUILDING', 'first'), (1, 'MACHINERY', 'second'), (2, 'NO SUCH', 'third'))
SELECT CAST(ordinal AS INTEGER) AS ordinal, label, count(c_custkey) AS n_customers
FROM s LEFT JOIN customer ON c_mktsegment = segment GROUP BY ALL""")
def s08_seed_list(spark, sf):
    """The first three of a configured list, with their customers counted."""
    seeds = S.seed_list(spark, [("BUILDING", "first"), ("MACHINERY", "second"), ("NO SUCH", "third"), ("AUTOMOBILE", "fourth")],
                        "segment string, label string", head=3)
    counts = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("c_custkey").alias("n"))
    return seeds.join(counts, "segment", "left").select("ordinal", "label", F.coalesce("n", F.lit(0)).alias("n_customers"))


def _word_scorer(texts):
    import pandas as pd
    n = texts.fillna("").str.split().str.len()
    return pd.DataFrame({"icp_score": (n % 101).astype("int32"), "booking_system": n.gt(100).map({True: "long", False: "short"}),
                         "reasoning": n.astype(str) + " words"})


@register("e05_scorer", """
WITH n AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+')) AS n
           FROM documents)
SELECT doc_id, CAST(n % 101 AS INTEGER) AS icp_score, CASE WHEN n > 100 THEN 'long' ELSE 'short' END AS booking_system,
       concat(CAST(n AS VARCHAR), ' words') AS reasoning FROM n""")
def e05_scorer(spark, sf):
    """E5: a scorer plugged in as an Arrow UDF (here: by number of words)."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", DOC.score_with(_word_scorer, "text").alias("s")).select("doc_id", "s.*")
