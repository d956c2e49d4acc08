"""Queries for candidate selection (J5-J8, A7, A8) over the pages table.

A page is a search hit; ``page_id % 50`` stands for the entity that was
searched for and ``page_id`` for the hit rank (SURVEY §7 minimum slice).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.operators import candidates as C
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

# Test configuration (invented, short): substring blocklist, forbidden
# keywords and restricted suffixes for the pages table.
BLOCKLIST = ["blog", "cheap-pills"]
KEYWORDS = ["pills", "spam"]
SUFFIXES = [".net"]

NETLOC_SQL = r"regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), '^www\.', '')"


def _hits(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.select((F.col("page_id") % 50).alias("grp"), "page_id", "url",
                        D.domain_netloc("url").alias("domain"))


@register("j05_first_valid", f"""
WITH h AS (
  SELECT page_id % 50 AS grp, page_id, {NETLOC_SQL} AS domain FROM pages),
v AS (SELECT *, domain <> '' AND NOT (contains(domain, 'blog') OR contains(domain, 'cheap-pills')) AS ok FROM h)
SELECT grp, count(*) AS n_candidates, count(*) FILTER (WHERE ok) AS n_valid,
       arg_min(page_id, page_id) FILTER (WHERE ok) AS first_page_id,
       arg_min(domain, page_id) FILTER (WHERE ok) AS first_domain
FROM v GROUP BY grp
""")
def j05_first_valid(spark, sf):
    hits = _hits(spark, sf)
    ok = (F.col("domain") != "") & ~D.blocked_substring("domain", BLOCKLIST)
    return C.first_valid(hits, "grp", ["page_id"], ok, ["page_id", "domain"], prefix="first_")


@register("j06_tiered", f"""
WITH h AS (
  SELECT {Q.host('url')} AS entity, page_id, url, {NETLOC_SQL} AS domain,
         CASE split_part(regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]*)', 1), '/', 1) WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS tier
  FROM pages),
v AS (SELECT *, NOT {Q.contains_any('domain', ['blog'])} AS ok FROM h)
SELECT entity, count(*) AS n_candidates, count(*) FILTER (WHERE ok) AS n_valid,
       arg_min(url, (tier, page_id)) FILTER (WHERE ok) AS best_url,
       arg_min(tier, (tier, page_id)) FILTER (WHERE ok) AS best_tier
FROM v GROUP BY entity""")
def j06_tiered(spark, sf):
    """Next tier only if no valid hit so far == min over (tier, rank)."""
    p = table(spark, sf, "pages")
    seg = F.regexp_extract("url", r"^[a-z]+://[^/]*/([^/?#]*)", 1)
    tier = F.when(seg == "en", 1).when(seg == "fr", 2).otherwise(3)
    h = p.select(D.host("url").alias("entity"), "page_id", "url", D.domain_netloc("url").alias("domain"),
                 tier.alias("tier"))
    ok = ~D.blocked_substring("domain", ["blog"])
    out = C.first_valid(h, "entity", ["tier", "page_id"], ok, ["url", "tier"], prefix="best_")
    return out


@register("j08_first_hit", f"""
WITH h AS (SELECT page_id % 50 AS grp, page_id, {NETLOC_SQL} AS domain FROM pages),
f AS (SELECT grp, arg_min(domain, page_id) AS d FROM h GROUP BY grp),
o AS (SELECT grp, d, CASE WHEN d IS NULL OR trim(d) = '' THEN 'not_found'
   WHEN contains(d, 'blog') OR contains(d, 'cheap-pills') THEN 'blocked' ELSE 'found' END AS outcome FROM f)
SELECT grp, CASE WHEN outcome = 'found' THEN d END AS domain, outcome FROM o""")
def j08_first_hit(spark, sf):
    """The first hit only; a blocked first hit is not replaced."""
    hits = _hits(spark, sf)
    return C.first_hit(hits, "grp", ["page_id"], "domain", D.blocked_substring("domain", BLOCKLIST))


@register("a07_rejection_counts", f"""
WITH h AS (SELECT page_id % 50 AS grp, page_id, {NETLOC_SQL} AS domain, {Q.host('url')} AS host FROM pages),
r AS (SELECT *, CASE WHEN {Q.contains_any('domain', KEYWORDS)} THEN 'keyword'
                     WHEN {Q.endswith_any('host', SUFFIXES)} THEN 'suffix'
                     WHEN {Q.contains_any('domain', ['blog'])} THEN 'blocklist' ELSE 'ok' END AS reason FROM h),
s AS (SELECT grp, min(page_id) FILTER (WHERE reason = 'ok') AS stop FROM r GROUP BY grp)
SELECT reason, count(*) AS n FROM r JOIN s USING (grp) WHERE stop IS NULL OR page_id <= stop GROUP BY reason""")
def a07_rejection_counts(spark, sf):
    """Reasons in precedence keyword -> suffix -> blocklist, counted only
    up to each entity's first valid hit (C19)."""
    p = table(spark, sf, "pages")
    h = p.select((F.col("page_id") % 50).alias("grp"), "page_id", D.domain_netloc("url").alias("domain"),
                 D.host("url").alias("host"))
    reason = C.rejection_reason([("keyword", D.blocked_substring("domain", KEYWORDS)),
                                 ("suffix", D.blocked_suffix("host", SUFFIXES)),
                                 ("blocklist", D.blocked_substring("domain", ["blog"]))])
    return C.rejection_counts(h, "grp", ["page_id"], reason)


@register("a08_outcome_counts", f"""
WITH h AS (SELECT page_id % 50 AS grp, page_id, {NETLOC_SQL} AS domain FROM pages),
f AS (SELECT grp, arg_min(domain, page_id) AS d FROM h GROUP BY grp)
SELECT CASE WHEN d IS NULL OR trim(d) = '' THEN 'not_found'
   WHEN contains(d, 'blog') OR contains(d, 'cheap-pills') THEN 'blocked' ELSE 'found' END AS outcome, count(*) AS n
FROM f GROUP BY 1""")
def a08_outcome_counts(spark, sf):
    return C.outcome_counts(j08_first_hit(spark, sf))


@register("j07_blocklist_antijoin", f"""
WITH h AS (SELECT page_id, {Q.host('url')} AS host FROM pages),
b AS (SELECT DISTINCT regexp_replace(host, '^blog\\.', '') AS b FROM h WHERE starts_with(host, 'blog.'))
SELECT page_id, host FROM h WHERE NOT EXISTS (SELECT 1 FROM b WHERE h.host = b.b OR ends_with(h.host, '.' || b.b))""")
def j07_blocklist_antijoin(spark, sf):
    """A blocklist table (here: parents of every blog host, derived from
    the data, so it grows with it) removes a host and all its sub-domains
    through a hash anti-join on exploded suffixes."""
    p = table(spark, sf, "pages").select("page_id", D.host("url").alias("host"))
    blocklist = p.where(F.col("host").startswith("blog.")).select(
        F.regexp_replace("host", r"^blog\.", "").alias("domain"))
    return D.drop_blocked(p, "host", blocklist, mode="suffix")
