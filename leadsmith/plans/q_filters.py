"""Filters and predicates on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.operators import predicates as P
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

# Test configuration (invented).
BLOCKLIST = ["blog", "cheap-pills"]
KEYWORDS = ["pills", "spam"]
SUFFIXES = [".net"]
SKIP = ["example.net", "maps.example.com"]
TEST_ROLE = ["the.", "of.", "for."]
TEST_PERSONAL = ["@mail4.example.com", "@mail9.example.com"]
EXCLUDED = ["anvil", "gizmo"]
INSTITUTIONAL = ["economy", "promo"]
POSITION = ["urgent", "high"]


_FIRST_LINE = "split_part(text, chr(10), 1)"


@register("f01_nonblank", f"SELECT doc_id FROM documents WHERE {Q.nonblank('text')} AND {Q.nonblank(_FIRST_LINE)}")
def f01_nonblank(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(X.nonblank("text") & X.nonblank(F.split_part("text", F.lit("\n"), F.lit(1)))).select("doc_id")


_K = "trim(json_extract_string(props, '$.k'))"
_KINT = f"CASE WHEN regexp_matches({_K}, '{X.NUMERIC_RE}') THEN CAST(trunc(TRY_CAST({_K} AS DOUBLE) / 2.0) AS BIGINT) END"


@register("f02_coerce_range", f"""
SELECT event_id, {_KINT} AS units FROM events WHERE coalesce({_KINT} BETWEEN 5 AND 50, false)""")
def f02_coerce_range(spark, sf):
    """F2 + F3: coerce text, truncate, keep the closed range [5, 50]."""
    e = table(spark, sf, "events")
    raw = (X.to_number(F.get_json_object("props", "$.k")) / 2.0).cast("string")
    return e.where(P.in_range(raw, 5, 50)).select("event_id", X.to_int_truncated(raw).alias("units"))


@register("f03_numeric_range", """
SELECT p_partkey, CAST(trunc(p_retailprice / 20.0) AS BIGINT) AS units FROM part
WHERE CAST(trunc(p_retailprice / 20.0) AS BIGINT) BETWEEN 5 AND 50""")
def f03_numeric_range(spark, sf):
    p = table(spark, sf, "part")
    v = F.col("p_retailprice") / 20.0
    return p.where(P.in_range(v, 5, 50)).select("p_partkey", X.to_int_truncated(v).alias("units"))


@register("f04_substring_block", f"""
SELECT page_id, {Q.domain_netloc('url')} AS domain, {Q.contains_any(Q.domain_netloc('url'), BLOCKLIST)} AS blocked FROM pages""")
def f04_substring_block(spark, sf):
    p = table(spark, sf, "pages").select("page_id", D.domain_netloc("url").alias("domain"))
    return p.withColumn("blocked", D.blocked_substring("domain", BLOCKLIST))


@register("f05_exact_skip", f"""
SELECT page_id, {Q.host('url')} AS host FROM pages
WHERE NOT coalesce(lower(regexp_replace({Q.host('url')}, '^.*\\.([^.]+\\.[^.]+)$', '\\1')) IN ('example.net', 'maps.example.com'), false)""")
def f05_exact_skip(spark, sf):
    """exact skip set on the registered domain; a sub-domain entry never
    matches (C3)."""
    p = table(spark, sf, "pages").select("page_id", D.host("url").alias("host"),
                                         D.registered_domain("url").alias("reg"))
    return p.where(~D.blocked_exact("reg", SKIP)).select("page_id", "host")


@register("f06_keyword_domain", f"""
SELECT page_id FROM pages WHERE {Q.contains_any(Q.domain_netloc('url'), KEYWORDS)}""")
def f06_keyword_domain(spark, sf):
    p = table(spark, sf, "pages")
    return p.where(D.blocked_substring(D.domain_netloc("url"), KEYWORDS)).select("page_id")


@register("f07_restricted_suffix", f"""
SELECT page_id, {Q.endswith_any(Q.host('url'), SUFFIXES + P.RESTRICTED_SUFFIXES)} AS restricted FROM pages""")
def f07_restricted_suffix(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", D.blocked_suffix(D.host("url"), SUFFIXES + P.RESTRICTED_SUFFIXES).alias("restricted"))


_EMAILS = f"SELECT doc_id, unnest(regexp_extract_all(text, '{X.EMAIL_RE}')) AS email FROM documents"


@register("f08_role_prefix", f"""
SELECT doc_id, email, {Q.startswith_any(Q.strip('email'), TEST_ROLE)} AS role_based FROM ({_EMAILS})""")
def f08_role_prefix(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.explode(X.extract_emails("text")).alias("email"))
    return d.withColumn("role_based", X.startswith_any(X.strip("email"), TEST_ROLE))


@register("f09_personal_domain", f"""
SELECT doc_id, email FROM ({_EMAILS})
WHERE {Q.nonblank('email')} AND NOT {Q.startswith_any(Q.strip('email'), TEST_ROLE)}
  AND NOT {Q.endswith_any(Q.strip('email'), TEST_PERSONAL)}""")
def f09_personal_domain(spark, sf):
    """F1 -> F8 -> F9, the pitch-list filter chain (on stripped text)."""
    d = table(spark, sf, "documents").select("doc_id", F.explode(X.extract_emails("text")).alias("email"))
    keep = (X.nonblank("email") & ~X.startswith_any(X.strip("email"), TEST_ROLE)
            & ~X.endswith_any(X.strip("email"), TEST_PERSONAL))
    return d.where(keep)


_F10 = "concat(initcap_name, ' - ', p_brand)"
_INITCAP_SQL = ("array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || "
                "lower(substr(w, 2))), ' ')")


@register("f10_company_exclusion", f"""
WITH t AS (SELECT p_partkey, p_brand, {_INITCAP_SQL} AS initcap_name FROM part),
b AS (SELECT p_partkey, trim(split_part({_F10}, ' - ', 1)) AS base FROM t)
SELECT p_partkey, base,
  {Q.contains_any('base', EXCLUDED)} AS excluded_word,
  regexp_matches(base, '{P.PERSON_NAME_RE}') AND NOT regexp_matches(base, '{P.BUSINESS_WORDS_RE}') AS person_like
FROM b""")
def f10_company_exclusion(spark, sf):
    """F10 + F11 on 'Title Case Name - Brand' listings."""
    p = table(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("n"), "p_brand")
    base = X.strip(X.before_separator(F.concat("n", F.lit(" - "), "p_brand")))
    return p.select("p_partkey", base.alias("base")).select(
        "p_partkey", "base", X.contains_any("base", EXCLUDED).alias("excluded_word"),
        P.looks_like_person("base").alias("person_like"))


_F12 = ("CASE s_suppkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN CAST(s_suppkey AS VARCHAR) WHEN 2 THEN ' Main ' "
        "ELSE s_name END")


@register("f12_bad_address", f"""
SELECT s_suppkey, ({Q.strip(_F12)} = '' OR regexp_matches({Q.strip(_F12)}, '^[0-9]+$') OR length({Q.strip(_F12)}) < 6) AS bad
FROM supplier""")
def f12_bad_address(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", P.bad_address(Q.spark_expr(_F12)).alias("bad"))


@register("f13_institutional", f"""
SELECT count(*) FILTER (WHERE NOT {Q.contains_any('p_type', INSTITUTIONAL)}) AS n_kept,
       count(*) FILTER (WHERE {Q.contains_any('p_type', INSTITUTIONAL)}) AS n_removed FROM part""")
def f13_institutional(spark, sf):
    p = table(spark, sf, "part")
    _, counts = P.filter_counted(p, ~X.contains_any("p_type", INSTITUTIONAL))
    return counts


@register("f14_position_keyword", f"""
SELECT o_orderkey FROM orders WHERE {Q.contains_any('o_orderpriority', POSITION)}""")
def f14_position_keyword(spark, sf):
    o = table(spark, sf, "orders")
    return o.where(X.contains_any("o_orderpriority", POSITION)).select("o_orderkey")


_F15_DOM = f"CASE WHEN page_id % 9 = 0 THEN '' ELSE {Q.domain_netloc('url')} END"


@register("f15_eligibility", f"""
WITH t AS (SELECT {_F15_DOM} AS domain FROM pages)
SELECT CASE WHEN NOT {Q.nonblank('domain')} THEN 'no_domain' WHEN {Q.contains_any('domain', BLOCKLIST)} THEN 'blocked'
  ELSE 'ok' END AS reason, count(*) AS n FROM t GROUP BY 1""")
def f15_eligibility(spark, sf):
    """one reason column in one pass, then counts per reason."""
    p = table(spark, sf, "pages")
    dom = F.when(F.col("page_id") % 9 == 0, F.lit("")).otherwise(D.domain_netloc("url"))
    t = p.select(dom.alias("domain"))
    r = t.select(P.eligibility("domain", D.blocked_substring("domain", BLOCKLIST)).alias("reason"))
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("f16_needs_work", """
WITH f AS (SELECT o_custkey, min(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS first_f FROM orders GROUP BY o_custkey)
SELECT c_custkey FROM customer LEFT JOIN f ON c_custkey = o_custkey
WHERE lower(c_mktsegment) || '.example.com' <> '' AND coalesce(CAST(first_f AS VARCHAR), '') = ''""")
def f16_needs_work(spark, sf):
    c = table(spark, sf, "customer")
    f = (table(spark, sf, "orders").groupBy("o_custkey")
         .agg(F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("first_f")))
    j = c.join(f, c.c_custkey == f.o_custkey, "left").select(
        "c_custkey", F.concat(F.lower("c_mktsegment"), F.lit(".example.com")).alias("domain"),
        F.coalesce(F.col("first_f").cast("string"), F.lit("")).alias("name"), F.lit("").alias("email"))
    return j.where(P.needs_work("domain", "name", "email")).select("c_custkey")


@register("f17_score_threshold", """
SELECT d.doc_id, coalesce(quality, 0) * 70 + (1 - coalesce(toxic, 1)) * 20 AS score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(quality, 0) * 70 + (1 - coalesce(toxic, 1)) * 20 >= 70""")
def f17_score_threshold(spark, sf):
    """F17 (and C10: unscored rows keep 0 and are dropped by >= 70)."""
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels")
    score = F.coalesce(F.col("quality"), F.lit(0)) * 70 + (1 - F.coalesce(F.col("toxic"), F.lit(1))) * 20
    return d.join(lab, "doc_id", "left").select("doc_id", score.alias("score")).where(F.col("score") >= 70)


@register("f19_present_count", f"""
SELECT count(*) FILTER (WHERE {Q.nonblank("CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END")}) AS n_with_contact,
       count(*) AS n_rows FROM customer""")
def f19_present_count(spark, sf):
    c = table(spark, sf, "customer")
    v = F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.lit(""))
    return c.agg(F.count_if(X.nonblank(v)).alias("n_with_contact"), F.count(F.lit(1)).alias("n_rows"))
