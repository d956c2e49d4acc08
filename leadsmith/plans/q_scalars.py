"""Scalar functions and projections on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

PRIORITY = ["urgent", "high", "medium"]


@register("n01_strip", f"""
SELECT doc_id, md5({Q.collapse('text')}) AS clean_md5, length({Q.collapse('text')}) AS clean_len,
       length({Q.strip('text')}) AS strip_len
FROM documents""")
def n01_strip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    clean = X.collapse_ws("text")
    return d.select("doc_id", F.md5(clean).alias("clean_md5"), F.length(clean).cast("bigint").alias("clean_len"),
                    F.length(X.strip("text")).cast("bigint").alias("strip_len"))


@register("n02_domain_netloc", f"SELECT page_id, {Q.domain_netloc('url')} AS domain FROM pages")
def n02_domain_netloc(spark, sf):
    return table(spark, sf, "pages").select("page_id", D.domain_netloc("url").alias("domain"))


@register("n03_domain_loose", f"""
SELECT page_id, trim(lower(replace(CASE WHEN {Q.netloc('url')} <> '' THEN {Q.netloc('url')}
  ELSE regexp_extract(url, '^([^?#]*)', 1) END, 'www.', ''))) AS domain FROM pages""")
def n03_domain_loose(spark, sf):
    return table(spark, sf, "pages").select("page_id", D.domain_loose("url").alias("domain"))


def _reg_sql(h: str) -> str:
    labels = f"string_split({h}, '.')"
    tails = (f"list_filter(list_transform(range(1, len({labels}) + 1), lambda i: "
             f"{{'i': i, 't': array_to_string({labels}[i:], '.')}}), "
             f"lambda s: list_contains({Q.sql_list(D.PUBLIC_SUFFIXES)}, s.t))")
    return (f"coalesce(CASE WHEN len({tails}) > 0 AND {tails}[1].i > 1 THEN {labels}[{tails}[1].i - 1] || '.' || {tails}[1].t END, '')")


@register("n04_registered_domain", f"""
SELECT page_id, {Q.host('url')} AS host, {_reg_sql(Q.host('url'))} AS registered,
       lower(split_part(regexp_replace(regexp_replace(trim(url), '^https?://', ''), '^www\\.', ''), '/', 1)) AS cut
FROM pages""")
def n04_registered_domain(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", D.host("url").alias("host"), D.registered_domain("url").alias("registered"),
                    D.domain_cut("url").alias("cut"))


@register("n04_suffix_table", f"""
WITH p AS (SELECT page_id, url, {Q.host('url')} AS host FROM pages),
l AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM p WHERE host <> ''),
r AS (SELECT 'com' AS rule FROM l WHERE l[-1] = 'com'
      UNION SELECT '*.' || array_to_string(l[-2:], '.') FROM l WHERE l[-1] = 'net'
      UNION SELECT '!' || array_to_string(l[-3:], '.') FROM l WHERE l[-1] = 'net' AND l[1] = 'm'),
t AS (SELECT host, len(l) AS n, unnest(range(1, len(l) + 1)) AS i, l FROM l),
m AS (SELECT host, coalesce(min(i + 1) FILTER (WHERE starts_with(rule, '!')), min(i)) AS start FROM t JOIN r
      ON rule IN (array_to_string(l[i:], '.'), '!' || array_to_string(l[i:], '.'))
         OR (i < n AND rule = '*.' || array_to_string(l[i + 1:], '.')) GROUP BY host)
SELECT page_id, CASE WHEN coalesce(start, len(l)) > 1 THEN array_to_string(l[coalesce(start, len(l)) - 1:], '.') ELSE '' END AS domain,
       start IS NOT NULL AS suffix_known
FROM p LEFT JOIN l USING (host) LEFT JOIN m USING (host)""")
def n04_suffix_table(spark, sf):
    """N4 against a suffix table with plain, wildcard and exception rules,
    here made of the hosts themselves; hosts under ``org`` match no rule."""
    p = table(spark, sf, "pages").select("page_id", "url")
    label = F.split(D.host("url"), r"\.")

    def last(n):
        return F.array_join(F.slice("l", F.greatest(F.size("l") - n + 1, F.lit(1)), n), ".")

    end = F.element_at("l", -1)
    rules = p.select(label.alias("l")).select(F.explode(F.array(
        F.when(end == "com", F.lit("com")), F.when(end == "net", F.concat(F.lit("*."), last(2))),
        F.when((end == "net") & (F.col("l")[0] == "m"), F.concat(F.lit("!"), last(3))))).alias("rule")).where("rule is not null").distinct()
    return D.with_registered_domain(p, "url", rules).select("page_id", "domain", "suffix_known")


NUM_RE = X.NUMERIC_RE


@register("n05_to_number", f"""
WITH t AS (SELECT event_id, trim(json_extract_string(props, '$.k')) AS k FROM events)
SELECT event_id, CASE WHEN regexp_matches(k, '{NUM_RE}') THEN TRY_CAST(k AS DOUBLE) END AS k_num,
       CASE WHEN regexp_matches(k, '{NUM_RE}') THEN CAST(trunc(TRY_CAST(k AS DOUBLE)) AS BIGINT) END AS k_int
FROM t""")
def n05_to_number(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", X.to_number(k).alias("k_num"), X.to_int_truncated(k).alias("k_int"))


@register("n06_round", """
SELECT user_id, round(avg(value), 2) AS mean2, round(sum(value) / count(*) * 3.0, 4) AS scaled4
FROM events GROUP BY user_id""")
def n06_round(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(X.round_half_up(F.avg("value"), 2).alias("mean2"),
                                    X.round_half_up(F.sum("value") / F.count(F.lit(1)) * 3.0, 4).alias("scaled4"))


@register("n07_keyword_rank", f"""
SELECT o_orderkey, {Q.keyword_rank('o_orderpriority', PRIORITY)} AS prio_rank FROM orders""")
def n07_keyword_rank(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.keyword_rank("o_orderpriority", PRIORITY).alias("prio_rank"))


_N8_NAME = "concat(p_name, ' Equipment Co. ', p_brand, ', Inc.')"


@register("n08_company_key", f"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower({_N8_NAME}),
  '\\b(inc|llc|ltd|co|corp|company|equipment)\\b\\.?', '', 'g'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS name_key
FROM part""")
def n08_company_key(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat(F.col("p_name"), F.lit(" Equipment Co. "), F.col("p_brand"), F.lit(", Inc."))
    return p.select("p_partkey", X.company_key(name).alias("name_key"))


_N9_NAME = ("concat(c_name, CASE c_custkey % 5 WHEN 0 THEN ', D.D.S.' WHEN 1 THEN ' DMD PLLC' "
            "WHEN 2 THEN ' P.C.' WHEN 3 THEN ' LLC' ELSE '' END)")


def _n9_sql(x: str) -> str:
    s = f"regexp_replace(regexp_replace({Q.strip(x)}, '^[\"'']', ''), '^\\s*\\.\\s*', '')"
    for p in X.TITLE_PATTERNS:
        s = f"regexp_replace({s}, '(?i){p}', '', 'g')"
    return f"trim(regexp_replace(regexp_replace({s}, '[\"'']$', ''), '\\s+', ' ', 'g'))"


@register("n09_title_clean", f"SELECT c_custkey, {_n9_sql(_N9_NAME)} AS clinic FROM customer")
def n09_title_clean(spark, sf):
    c = table(spark, sf, "customer")
    name = F.expr(_N9_NAME)
    return c.select("c_custkey", X.clean_title_name(name).alias("clinic"))


_N10_PATH = ("CASE o_orderkey % 3 WHEN 0 THEN concat('edgar/data/', o_custkey, '/', lpad(CAST(o_orderkey AS VARCHAR), 10, '0'), '.TXT') "
             "WHEN 1 THEN concat('EDGAR/Data/', o_custkey, '/acc-', o_orderkey, '.htm') "
             "ELSE concat('  filing-', o_orderkey, ' ') END")


@register("n10_accession", f"""
SELECT o_orderkey, coalesce(nullif(regexp_extract({_N10_PATH}, '(?i)edgar/data/[0-9]+/([^/]+)\\.(txt|htm|html)$', 1), ''),
  {Q.strip(_N10_PATH)}) AS accession FROM orders""")
def n10_accession(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.accession(Q.spark_expr(_N10_PATH)).alias("accession"))


@register("n11_strip_zeros", """
SELECT c_custkey, coalesce(nullif(regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '^0+', ''), ''), '0') AS cik
FROM customer""")
def n11_strip_zeros(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.strip_leading_zeros(F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("cik"))


@register("n12_yyyymmdd", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd,
  concat_ws('-', substr(strftime(o_orderdate, '%Y%m%d'), 1, 4), substr(strftime(o_orderdate, '%Y%m%d'), 5, 2),
            substr(strftime(o_orderdate, '%Y%m%d'), 7, 2)) AS iso
FROM orders""")
def n12_yyyymmdd(spark, sf):
    o = table(spark, sf, "orders")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select("o_orderkey", ymd.alias("ymd"), X.yyyymmdd_to_iso(ymd).alias("iso"))


INDEX_BASE = "https://index.example.org/daily-index"


@register("n13_quarter_label", f"""
SELECT o_orderkey, concat('QTR', CAST(quarter(o_orderdate) AS VARCHAR)) AS qtr,
  concat('{INDEX_BASE}/', CAST(year(o_orderdate) AS VARCHAR), '/QTR', CAST(quarter(o_orderdate) AS VARCHAR),
         '/form.', strftime(o_orderdate, '%Y%m%d'), '.idx') AS index_url
FROM orders""")
def n13_quarter_label(spark, sf):
    """Quarter label and the daily index URL for a date."""
    o = table(spark, sf, "orders")
    url = F.format_string(f"{INDEX_BASE}/%d/QTR%d/form.%s.idx", F.year("o_orderdate"),
                          F.quarter("o_orderdate"), F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", X.quarter_label("o_orderdate").alias("qtr"), url.alias("index_url"))


@register("n14_title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
  lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title
FROM part""")
def n14_title_case(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("title"))


_N15 = "CASE WHEN c_custkey % 2 = 0 THEN concat('@', c_name) ELSE concat(' ', c_name, ' ') END"


@register("n15_handle", f"""
SELECT c_custkey, CASE WHEN starts_with({Q.strip(_N15)}, '@') THEN {Q.strip(_N15)}
  ELSE concat('@', {Q.strip(_N15)}) END AS handle FROM customer""")
def n15_handle(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.handle(F.expr(_N15)).alias("handle"))


@register("n16_truncate", """
SELECT doc_id, md5(left(text, 4000)) AS page_md5, length(left(text, 4000)) AS page_len, left(text, 100) AS head
FROM documents""")
def n16_truncate(spark, sf):
    d = table(spark, sf, "documents")
    t4 = X.truncate("text", 4000)
    return d.select("doc_id", F.md5(t4).alias("page_md5"), F.length(t4).cast("bigint").alias("page_len"),
                    X.truncate("text", 100).alias("head"))


@register("n17_clamp", """
SELECT event_id, greatest(1, least(100, CAST(round(value * 4) AS BIGINT))) AS score FROM events""")
def n17_clamp(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", X.clamp(F.round(F.col("value") * 4).cast("bigint"), 1, 100).alias("score"))


@register("n18_int_opt", """
SELECT event_id, TRY_CAST(trim(json_extract_string(props, '$.k')) AS BIGINT) AS k,
       TRY_CAST(trim(json_extract_string(props, '$.missing')) AS BIGINT) AS absent
FROM events""")
def n18_int_opt(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", X.to_long_opt(F.get_json_object("props", "$.k")).alias("k"),
                    X.to_long_opt(F.get_json_object("props", "$.missing")).alias("absent"))


@register("n19_emails", f"""
SELECT doc_id, lower(email) AS email FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{X.EMAIL_RE}')) AS email FROM documents)""")
def n19_emails(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", F.explode(X.extract_emails("text")).alias("email")) \
            .select("doc_id", F.lower("email").alias("email"))


_N20 = "CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END"


@register("n20_ensure_scheme", f"""
SELECT page_id, CASE WHEN regexp_matches({_N20}, '^https?://') THEN {_N20} ELSE concat('https://', {_N20}) END AS url
FROM pages""")
def n20_ensure_scheme(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.ensure_scheme(F.expr(_N20)).alias("url"))


# --- projections -----------------------------------------------------------

@register("r01_strip_all", f"""
SELECT c_custkey, {Q.strip('c_name')} AS c_name, c_nationkey, c_acctbal, {Q.strip('c_mktsegment')} AS c_mktsegment
FROM customer""")
def r01_strip_all(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(*[X.strip(f.name).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
                      for f in c.schema.fields])


@register("r02_select_existing", "SELECT n_name, n_nationkey FROM nation")
def r02_select_existing(spark, sf):
    n = table(spark, sf, "nation")
    wanted = ["n_name", "owner_email", "n_nationkey", "website"]
    return n.select(*[c for c in wanted if c in n.columns])


@register("r03_drop_present", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def r03_drop_present(spark, sf):
    o = table(spark, sf, "orders").drop("o_orderdate")
    return o.drop("o_totalprice", "owner_name", "apollo_org_id")


@register("r04_rename", """
SELECT CAST(s_suppkey AS VARCHAR) AS dot_number, trim(s_name) AS company, CAST(s_nationkey AS VARCHAR) AS state,
       s_acctbal AS power_units FROM supplier""")
def r04_rename(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select(F.col("s_suppkey").cast("string").alias("dot_number"), F.trim("s_name").alias("company"),
                    F.col("s_nationkey").cast("string").alias("state"), F.col("s_acctbal").alias("power_units"))


_R05 = "CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END"


@register("r05_provenance", f"""
SELECT c_custkey, {_R05} AS email, CASE WHEN {Q.nonblank(_R05)} THEN 'registry' ELSE '' END AS email_source
FROM customer""")
def r05_provenance(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.expr(_R05).alias("email"))
    return c.withColumn("email_source", X.provenance("email", "registry"))


@register("r06_full_name", f"""
SELECT n_nationkey, {Q.strip("concat_ws(' ', coalesce(CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END, ''), coalesce(r_name, ''))")} AS full_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def r06_full_name(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    first = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name"))
    return j.select("n_nationkey", X.full_name(first, "r_name").alias("full_name"))


@register("r07_before_separator", """
SELECT p_partkey, split_part(concat(p_name, ' - ', p_brand), ' - ', 1) AS base_name,
       split_part(p_type, ' - ', 1) AS type_base FROM part""")
def r07_before_separator(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.before_separator(F.concat("p_name", F.lit(" - "), "p_brand")).alias("base_name"),
                    X.before_separator("p_type").alias("type_base"))


_R08 = ("CASE WHEN n_nationkey % 4 = 0 THEN n_name WHEN n_nationkey % 4 = 1 THEN concat(n_name, ', ', upper(left(r_name, 2))) "
        "ELSE concat(n_name, ',  ', upper(left(r_name, 2)), ' ', lpad(CAST(n_nationkey AS VARCHAR), 5, '0')) END")


@register("r08_city_state_zip", f"""
WITH t AS (SELECT n_nationkey, {_R08} AS line FROM nation JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT n_nationkey, CASE WHEN contains(line, ',') THEN trim(split_part(line, ',', 1)) ELSE '' END AS city,
        string_split_regex(trim(CASE WHEN contains(line, ',') THEN substr(line, strpos(line, ',') + 1) ELSE '' END), '\\s+') AS rest
      FROM t)
SELECT n_nationkey, city, coalesce(nullif(rest[1], ''), 'MI') AS state, coalesce(rest[2], '') AS zip FROM p""")
def r08_city_state_zip(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.expr(_R08.replace("AS VARCHAR", "AS STRING")).alias("line"))
    city, state, zipc = X.city_state_zip("line", default_state="MI")
    return j.select("n_nationkey", city.alias("city"), state.alias("state"), zipc.alias("zip"))


@register("r09_phone", """
SELECT c_custkey, trim(coalesce(nullif(regexp_replace(coalesce(CASE WHEN c_custkey % 2 = 0 THEN concat('tel:+1', lpad(CAST(c_custkey AS VARCHAR), 10, '0')) END, ''), '^tel:', ''), ''),
   concat('(555) ', CAST(c_custkey AS VARCHAR)), '')) AS phone FROM customer""")
def r09_phone(spark, sf):
    c = table(spark, sf, "customer")
    link = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("tel:+1"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")))
    text = F.concat(F.lit("(555) "), F.col("c_custkey").cast("string"))
    return c.select("c_custkey", X.phone(link, text).alias("phone"))


# Search strings per entity, tight to loose (literal parts quoted).
TIERS = [["name", "city", "state", "'equipment dealer'"], ["name", "state", "'equipment dealer'"],
         ["name", "city", "state"]]


@register("r11_query_tiers", """
WITH b AS (SELECT c_custkey, c_name AS name, n_name AS city, 'Michigan' AS state
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
q AS (SELECT c_custkey, [concat(name, ' ', city, ' ', state, ' equipment dealer'),
                         concat(name, ' ', state, ' equipment dealer'),
                         concat(name, ' ', city, ' ', state)] AS qs FROM b)
SELECT c_custkey, CAST(generate_subscripts(qs, 1) AS INTEGER) AS tier, unnest(qs) AS query FROM q""")
def r11_query_tiers(spark, sf):
    """Ordered search strings per entity, tight to loose; the state is a
    parameter (the reference hard-coded one, C15)."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    b = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("c_name").alias("name"),
                                                          F.col("n_name").alias("city"), F.lit("Michigan").alias("state"))
    part = lambda p: F.lit(p.strip("'")) if p.startswith("'") else F.col(p)
    arr = F.array(*[F.concat_ws(" ", *[part(p) for p in tier]) for tier in TIERS])
    return b.select("c_custkey", F.posexplode(arr).alias("tier", "query")) \
            .select("c_custkey", (F.col("tier") + 1).alias("tier"), "query")
