"""End-to-end flows over the driver tables.

The customer table stands in for the carrier registry: one row per
registry record, ``state`` = nation name, position = customer key, id =
whole account balance (so ids repeat and keep-first matters), units =
balance / 100 as text (so coercion and range filtering matter).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.functions import text as X
from leadsmith.plans import flows as FL
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.registry import register
from leadsmith.sources.tables import table

_EMAIL = ("CASE WHEN c_mktsegment = 'BUILDING' THEN concat('info@c', CAST(c_custkey AS VARCHAR), '.example.com') "
          "WHEN c_mktsegment = 'MACHINERY' THEN concat('owner', CAST(c_custkey AS VARCHAR), '@fleet.example.com') "
          "WHEN c_mktsegment = 'AUTOMOBILE' THEN concat(' Ops', CAST(c_custkey AS VARCHAR), '@c', CAST(c_custkey AS VARCHAR), "
          "'.example.com') ELSE '' END")


def _registry(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(F.col("n_name").alias("state"), F.lit(0).alias("page"), F.col("c_custkey").alias("pos"),
                    F.floor("c_acctbal").cast("string").alias("dot_number"), F.col("c_name").alias("legal_name"),
                    (F.col("c_acctbal") / 100).cast("string").alias("nbr_power_unit"),
                    Q.spark_expr(_EMAIL).alias("email_address"),
                    F.col("n_name").alias("phy_state"))


_P01_SQL = f"""
WITH r AS (SELECT n_name AS state, 0 AS page, c_custkey AS pos, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS dot_number,
                  c_name AS legal_name, CAST(c_acctbal / 100 AS VARCHAR) AS nbr_power_unit, {_EMAIL} AS email_address,
                  n_name AS phy_state
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT *, CAST(trunc(TRY_CAST(trim(nbr_power_unit) AS DOUBLE)) AS INTEGER) AS units FROM r
      WHERE trim(dot_number) <> '' AND trim(legal_name) <> ''
        AND regexp_matches(trim(nbr_power_unit), '{X.NUMERIC_RE}')),
g AS (SELECT * FROM f WHERE units BETWEEN 5 AND 50),
d AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY trim(dot_number) ORDER BY state, page, pos) = 1)
SELECT trim(legal_name) AS company, trim(dot_number) AS usdot_number, '' AS dba_name, units AS power_units,
       '' AS phone, trim(email_address) AS email, '' AS owner_name, '' AS owner_title, '' AS owner_email,
       CASE WHEN trim(email_address) <> '' THEN 'registry' ELSE '' END AS email_source, '' AS address, '' AS city,
       trim(phy_state) AS state, '' AS zip_code, '' AS apollo_org_id
FROM d"""


@register("p01_carrier_leads", _P01_SQL)
def p01_carrier_leads(spark, sf):
    """Back-fill, non-blank, numeric range, keep-first per id, records,
    provenance, sorted by (state, units, company)."""
    return FL.carrier_leads(_registry(spark, sf))


_ROLE = " OR ".join(f"starts_with(lower(trim(email)), '{p}')" for p in FL.P.ROLE_PREFIXES)
_PERSONAL = " OR ".join(f"ends_with(lower(trim(email)), '{p}')" for p in FL.P.PERSONAL_DOMAINS + ["@fleet.example.com"])


@register("p02_pitch_list", f"""
WITH l AS ({_P01_SQL})
SELECT * EXCLUDE (owner_name, owner_title, owner_email, apollo_org_id) FROM l
WHERE trim(email) <> '' AND NOT ({_ROLE}) AND NOT ({_PERSONAL})
ORDER BY md5(concat('42:', usdot_number)), usdot_number LIMIT 30""")
def p02_pitch_list(spark, sf):
    """P2 on P1's output: e-mail present, not a role mailbox, not a personal
    provider (the test adds the fleet domain to the provider list), exact
    seeded sample of 30, enrichment columns dropped."""
    cfg = FL.PitchConfig(personal_domains=tuple(FL.P.PERSONAL_DOMAINS) + ("@fleet.example.com",))
    return FL.pitch_list(p01_carrier_leads(spark, sf), cfg)


def _creator_inputs(spark, sf):
    """Customers are channels, their orders the uploads playlist, line items
    aggregated per order the video statistics (strings, as landed); nation
    names are handles that resolve to no channel."""
    c = table(spark, sf, "customer")
    handles = c.select(F.col("c_name").alias("handle")).unionByName(
        table(spark, sf, "nation").select(F.col("n_name").alias("handle")))
    channels = c.select(F.col("c_name").alias("handle"), F.col("c_custkey").cast("string").alias("channel_id"),
                        F.floor("c_acctbal").cast("bigint").cast("string").alias("subscriberCount"),
                        F.when(F.col("c_nationkey") % 2 == 1, (F.col("c_custkey") * 10).cast("string"))
                        .alias("viewCount"),
                        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uploads"))
    playlist = table(spark, sf, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("playlist_id"),
        F.col("o_orderdate").alias("published_at"), F.col("o_orderkey").alias("video_id"))
    n = F.count(F.lit(1))
    stats = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("video_id")).agg(
        F.floor(F.sum("l_quantity")).cast("bigint").cast("string").alias("viewCount"),
        n.cast("string").alias("likeCount"),
        F.when(n > 3, (n - 3).cast("string")).alias("commentCount"))
    return handles, channels, playlist, stats


PROFILE = ("handle string, channel_id string, subscribers bigint, channel_views bigint, "
           "recent_totals struct<n_sampled:bigint,total_views:bigint,total_likes:bigint,total_comments:bigint>, "
           "mean_views double, engagement_rate double")


@register("p12_creator_profiles", """
WITH h AS (SELECT DISTINCT CASE WHEN starts_with(trim(x), '@') THEN trim(x) ELSE '@' || trim(x) END AS handle
           FROM (SELECT c_name AS x FROM customer UNION ALL SELECT n_name FROM nation)),
ch AS (SELECT '@' || trim(c_name) AS handle, CAST(c_custkey AS VARCHAR) AS channel_id,
              CAST(floor(c_acctbal) AS BIGINT) AS subscribers,
              CASE WHEN c_nationkey % 2 = 1 THEN c_custkey * 10 END AS channel_views,
              'u' || CAST(c_custkey AS VARCHAR) AS uploads FROM customer),
rec AS (SELECT 'u' || CAST(o_custkey AS VARCHAR) AS uploads, o_orderkey AS video_id FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 15),
st AS (SELECT l_orderkey AS video_id, CAST(floor(sum(l_quantity)) AS BIGINT) AS vv, count(*) AS lk,
              CASE WHEN count(*) > 3 THEN count(*) - 3 END AS cm FROM lineitem GROUP BY l_orderkey),
agg AS (SELECT uploads, count(st.video_id) AS n_sampled, sum(coalesce(vv, 0)) AS tv, sum(coalesce(lk, 0)) AS tl,
               sum(coalesce(cm, 0)) AS tc, sum(coalesce(vv, 0)) / nullif(count(st.video_id), 0) AS mv
        FROM rec LEFT JOIN st USING (video_id) GROUP BY uploads)
SELECT h.handle, ch.channel_id, ch.subscribers, ch.channel_views, coalesce(agg.n_sampled, 0) AS n_sampled,
       CAST(coalesce(tv, 0) AS BIGINT) AS total_views, CAST(coalesce(tl, 0) AS BIGINT) AS total_likes,
       CAST(coalesce(tc, 0) AS BIGINT) AS total_comments, round(mv, 2) AS mean_views,
       round((tl + tc) * 100.0 / nullif(tv, 0), 4) AS engagement_rate
FROM h JOIN ch USING (handle) LEFT JOIN agg USING (uploads)""")
def p12_creator_profiles(spark, sf):
    """Handle -> channel -> newest 15 uploads -> statistics -> totals,
    mean views, engagement rate; the nested JSON rows are read back flat
    for the check (unknown handles go to the dead-letter output)."""
    profiles, _dead, _manifest = FL.creator_profiles(*_creator_inputs(spark, sf))
    p = profiles.select(F.from_json("profile", PROFILE).alias("p")).select("p.*")
    return p.select("handle", "channel_id", "subscribers", "channel_views",
                    *[F.col(f"recent_totals.{c}").alias(c) for c in
                      ("n_sampled", "total_views", "total_likes", "total_comments")],
                    "mean_views", "engagement_rate")


_P11_FORM = "CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'D/A' ELSE '10-K' END"
_P11_NAME = ("concat('Customer ', CAST(o_custkey AS VARCHAR), CASE WHEN o_orderpriority = '5-LOW' THEN ' Land Trust' "
             "ELSE ' Robotics Inc' END)")
_P11_PATH = ("concat('edgar/data/', CAST(o_custkey AS VARCHAR), '/', lpad(CAST(o_orderkey // 2 AS VARCHAR), 10, '0'), "
             "'-', CAST(o_custkey AS VARCHAR), '.txt')")
_P11_DOC = """CASE c_custkey % 3
 WHEN 0 THEN concat('<SEC-DOCUMENT>\n<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry>', n_name,
   '</stateOrCountry></issuerAddress></primaryIssuer></edgarSubmission>')
 WHEN 1 THEN concat('<SEC-HEADER>\nBUSINESS ADDRESS:\n  CITY: X\n  STATE: ', r_name, '\n</SEC-HEADER>')
 END"""


@register("p11_funded_startups", f"""
WITH l AS (SELECT date_trunc('month', o_orderdate) AS day, {_P11_FORM} AS form_type, {_P11_NAME} AS company_name,
                  CAST(o_custkey AS VARCHAR) AS cik, strftime(o_orderdate, '%Y%m%d') AS ymd, {_P11_PATH} AS rel_path,
                  o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O')),
a AS (SELECT *, regexp_extract(rel_path, '(?i)edgar/data/[0-9]+/([^/]+)\\.(txt|htm|html)$', 1) AS accession FROM l),
d AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY accession ORDER BY strftime(day, '%Y-%m-%d'), rel_path) = 1),
k AS (SELECT * FROM d WHERE NOT ({' OR '.join(f"contains(lower(company_name), '{w}')" for w in FL.FilingConfig().institutional)}))
SELECT accession, form_type, company_name, cik, concat_ws('-', substr(ymd, 1, 4), substr(ymd, 5, 2), substr(ymd, 7, 2)) AS date_filed,
       CASE o_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN split_part(r_name, ' ', 1) ELSE '' END AS state, rel_path
FROM k JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def p11_funded_startups(spark, sf):
    """Daily index files (landed per month, scanned as one partitioned
    directory, U2) -> parse (S4/F18) -> first listing per accession (A3) ->
    institutional names out (F13) -> filing text by path (J13) -> location
    (X1/X2) -> ISO date (N12). A third of the filings are missing: blank."""
    from leadsmith.plans.q_sources import _scratch
    o = table(spark, sf, "orders")
    e = Q.spark_expr
    line = F.concat(F.rpad(e(_P11_FORM), 12, " "), F.rpad(e(_P11_NAME), 62, " "),
                    F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lit("  "),
                    F.date_format("o_orderdate", "yyyyMMdd"), F.lit("  "), e(_P11_PATH))
    path = _scratch(spark, "daily-index")
    (o.select(F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("day"), line.alias("value"))
      .write.partitionBy("day").mode("overwrite").text(path))
    index = spark.read.text(path).withColumn("day", F.col("day").cast("string"))
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    docs = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(e(_P11_PATH).alias("rel_path"), F.expr(_P11_DOC).alias("text"))
            .where(F.col("text").isNotNull()).dropDuplicates(["rel_path"]))
    out, _counts = FL.funded_startups(index, docs)
    return out


_P8_DOMAIN = "concat(lower(split_part(o_orderpriority, '-', 2)), '.example.com')"
_P8_LEVEL = ("CASE WHEN contains(lower(p_name), 'ring') THEN 0 WHEN contains(lower(p_name), 'bolt') THEN 1 "
             "WHEN trim(p_name) <> '' THEN 2 ELSE 3 END")
_P8_CONTACT_DOMAIN = ("CASE WHEN p_size <= 10 THEN 'urgent.example.com' WHEN p_size <= 20 THEN 'high.example.com' "
                      "WHEN p_size <= 30 THEN 'medium.example.com' ELSE 'not specified.example.com' END")
P8_CFG = dict(blocklist=("low",), max_calls=1000, ops_keywords=("ring",), exec_keywords=("bolt",))


@register("p08_brand_bridge", f"""
WITH s AS (SELECT o_custkey AS ordinal, o_orderkey AS rank, {_P8_DOMAIN} AS domain FROM orders),
f AS (SELECT ordinal, arg_min(domain, rank) AS d FROM s GROUP BY ordinal),
b AS (SELECT c_custkey AS ordinal, c_name AS brand_name,
             CASE WHEN d IS NOT NULL AND trim(d) <> '' AND NOT contains(lower(d), 'low') THEN d END AS website
      FROM customer LEFT JOIN f ON c_custkey = f.ordinal),
called AS (SELECT ordinal, website FROM b WHERE coalesce(trim(website), '') <> '' AND NOT contains(lower(website), 'low')
           QUALIFY row_number() OVER (ORDER BY ordinal) <= 1000),
ct AS (SELECT {_P8_CONTACT_DOMAIN} AS domain, p_partkey AS pos, trim(concat_ws(' ', p_brand, p_type)) AS contact_name,
              p_name AS position, concat(replace(p_name, ' ', '.'), CAST(p_partkey AS VARCHAR), '@x.example.com') AS value,
              {_P8_LEVEL} AS lvl FROM part),
best AS (SELECT domain, arg_min(contact_name, (lvl, pos)) AS contact_name, arg_min(position, (lvl, pos)) AS contact_title,
                arg_min(value, (lvl, pos)) AS contact_email, arg_min(lvl, (lvl, pos)) AS lvl FROM ct GROUP BY domain),
e AS (SELECT called.ordinal, contact_name, contact_title, contact_email,
             CASE WHEN lvl IS NULL THEN 'contacts:none' ELSE 'contacts:' || ['ops', 'exec', 'generic', 'no_title'][lvl + 1] END AS email_source
      FROM called LEFT JOIN best ON called.website = best.domain)
SELECT b.ordinal, b.brand_name, b.website, e.contact_name, e.contact_title, e.contact_email, e.email_source
FROM b LEFT JOIN e ON b.ordinal = e.ordinal""")
def p08_brand_bridge(spark, sf):
    """First suggest hit only -> eligibility -> call budget in seed order
    -> ops / exec / titled / first contact cascade -> merged back. Suggest
    hits map to five domains, so a handful of hot keys carry all contacts."""
    brands = table(spark, sf, "customer").select(F.col("c_custkey").alias("ordinal"),
                                                 F.col("c_name").alias("brand_name"))
    suggest = table(spark, sf, "orders").select(F.col("o_custkey").alias("ordinal"), F.col("o_orderkey").alias("rank"),
                                                F.expr(_P8_DOMAIN).alias("domain"))
    contacts = table(spark, sf, "part").select(
        F.expr(_P8_CONTACT_DOMAIN).alias("domain"), F.col("p_partkey").alias("pos"),
        F.col("p_brand").alias("first_name"), F.col("p_type").alias("last_name"), F.col("p_name").alias("position"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.col("p_partkey").cast("string"),
                 F.lit("@x.example.com")).alias("value"))
    out, _counts = FL.brand_bridge(brands, suggest, contacts, FL.BridgeConfig(**P8_CFG))
    return out.select("ordinal", "brand_name", "website", "contact_name", "contact_title", "contact_email",
                      "email_source")


_P9_PERSON_ID = "CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END"
_P9_MATCH = "CASE WHEN p_retailprice > 1000 THEN concat('p', CAST(p_partkey AS VARCHAR), '@firm.example.com') END"


@register("p09_distributor_bridge", f"""
WITH s AS (SELECT o_custkey AS ordinal, o_orderkey AS rank, {_P8_DOMAIN} AS domain FROM orders),
f AS (SELECT ordinal, arg_min(domain, rank) AS d FROM s GROUP BY ordinal),
b AS (SELECT c_custkey AS ordinal, c_name AS company_name,
             CASE WHEN d IS NOT NULL AND trim(d) <> '' AND NOT contains(lower(d), 'low') THEN d END AS website
      FROM customer LEFT JOIN f ON c_custkey = f.ordinal),
pp AS (SELECT {_P8_CONTACT_DOMAIN} AS domain, p_partkey AS pos, {_P9_PERSON_ID} AS id, p_brand AS first_name,
              p_type AS last_name, p_name AS title FROM part),
p1 AS (SELECT domain, id, first_name, last_name, title FROM pp
       QUALIFY row_number() OVER (PARTITION BY domain ORDER BY pos) = 1),
j AS (SELECT b.ordinal, p1.id, p1.first_name, p1.last_name, p1.title, p1.domain IS NOT NULL AS has_person,
             CASE WHEN p1.domain IS NOT NULL THEN 2 ELSE 1 END AS cost
      FROM b LEFT JOIN p1 ON b.website = p1.domain
      WHERE coalesce(trim(b.website), '') <> '' AND NOT contains(lower(b.website), 'low')),
w AS (SELECT *, sum(cost) OVER (ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cost AS calls_before FROM j),
m AS (SELECT CAST(p_partkey AS VARCHAR) AS id, {_P9_MATCH} AS email FROM part),
e AS (SELECT w.ordinal, trim(concat_ws(' ', coalesce(w.first_name, ''), coalesce(w.last_name, ''))) AS contact_name,
             w.title AS contact_title, m.email AS contact_email,
             CASE WHEN NOT w.has_person THEN 'people:none' WHEN w.id IS NULL THEN 'people:no_id'
                  WHEN coalesce(trim(m.email), '') = '' THEN 'match:no_email' ELSE 'match:ok' END AS email_source
      FROM w LEFT JOIN m ON w.id = m.id WHERE calls_before < 1000)
SELECT b.ordinal, b.company_name, b.website, e.contact_name, e.contact_title, e.contact_email, e.email_source
FROM b LEFT JOIN e ON b.ordinal = e.ordinal""")
def p09_distributor_bridge(spark, sf):
    """First suggest hit -> first person of the domain -> e-mail by
    person id; a row costs 2 calls when a first person exists, else 1, and
    the 1000-call budget is checked before each row (C11)."""
    firms = table(spark, sf, "customer").select(F.col("c_custkey").alias("ordinal"),
                                                F.col("c_name").alias("company_name"))
    suggest = table(spark, sf, "orders").select(F.col("o_custkey").alias("ordinal"), F.col("o_orderkey").alias("rank"),
                                                F.expr(_P8_DOMAIN).alias("domain"))
    part = table(spark, sf, "part")
    people = part.select(F.expr(_P8_CONTACT_DOMAIN).alias("domain"), F.col("p_partkey").alias("pos"),
                         Q.spark_expr(_P9_PERSON_ID).alias("id"),
                         F.col("p_brand").alias("first_name"), F.col("p_type").alias("last_name"),
                         F.col("p_name").alias("title"))
    matches = part.select(F.col("p_partkey").cast("string").alias("id"),
                          Q.spark_expr(_P9_MATCH).alias("email"))
    out = FL.distributor_bridge(firms, suggest, people, matches,
                                FL.BridgeConfig(blocklist=("low",), max_calls=1000))
    return out.select("ordinal", "company_name", "website", "contact_name", "contact_title", "contact_email",
                      "email_source")


@register("p04_clinic_contacts", """
WITH s AS (SELECT trim(s_name) AS clinic_name, concat('nation-', CAST(s_nationkey AS VARCHAR), '.example.com') AS website
           FROM supplier),
c AS (SELECT concat('nation-', CAST(c_nationkey AS VARCHAR), '.example.com') AS domain, c_custkey AS pos,
             trim(c_name) AS contact_name, c_mktsegment AS position,
             concat('c', CAST(c_custkey AS VARCHAR), '@clinic.example.com') AS value FROM customer),
b AS (SELECT domain,
             arg_min(contact_name, pos) FILTER (WHERE contains(lower(position), 'machinery')) AS m_name,
             arg_min(position, pos) FILTER (WHERE contains(lower(position), 'machinery')) AS m_pos,
             arg_min(value, pos) FILTER (WHERE contains(lower(position), 'machinery')) AS m_value,
             arg_min(contact_name, pos) AS f_name, arg_min(position, pos) AS f_pos, arg_min(value, pos) AS f_value
      FROM c GROUP BY domain)
SELECT clinic_name, website, coalesce(m_name, f_name) AS contact_name,
       CASE WHEN m_name IS NOT NULL THEN m_pos WHEN f_name IS NOT NULL THEN coalesce(nullif(trim(f_pos), ''), 'General/Unknown') END AS contact_title,
       coalesce(m_value, f_value) AS contact_email,
       CASE WHEN m_name IS NOT NULL THEN 'contacts:matched' WHEN f_name IS NOT NULL THEN 'contacts:fallback'
            ELSE 'contacts:none' END AS email_source
FROM s LEFT JOIN b ON s.website = b.domain""")
def p04_clinic_contacts(spark, sf):
    """Seed rows (name, site) -> first contact whose position has a
    keyword, else the first contact with a default title (W4 + R10). The
    contacts sit on one domain per nation: 25 hot keys."""
    seed = table(spark, sf, "supplier").select(
        F.col("s_name").alias("clinic_name"),
        F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string"), F.lit(".example.com")).alias("website"))
    contacts = table(spark, sf, "customer").select(
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"), F.lit(".example.com")).alias("domain"),
        F.col("c_custkey").alias("pos"), F.col("c_name").alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.col("c_mktsegment").alias("position"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@clinic.example.com")).alias("value"))
    return FL.clinic_contacts(seed, contacts, keywords=("machinery",))


_P03 = FL.ClinicConfig(cap=None, blocklist=("blog", "cheap-pills"), phone_words=("the ",), form_words=("le ",), portal_words=("zocdoc",))
# contacts of a site: one a page, in page order; some are no managers, some have no e-mail
_P03_TITLE = "CASE page_id % 3 WHEN 0 THEN 'Dentist' WHEN 1 THEN 'Office Manager' ELSE 'Regional Practice Manager' END"
_P03_EMAIL = "CASE WHEN page_id % 4 = 0 THEN '' ELSE concat('p', CAST(page_id AS VARCHAR), '@clinic.example.com') END"
_P03_SCORE, _P03_SYSTEM, _P03_REASON = Q.rubric("text", "calls", _P03.phone_words, _P03.form_words, _P03.portal_words)


@register("p03_clinic_leads", f"""
WITH h AS (SELECT page_id, html, {Q.host('url')} AS host, {Q.domain_netloc('url')} AS domain FROM pages),
ok AS (SELECT * FROM h WHERE NOT {Q.contains_any('domain', _P03.forbidden_keywords)} AND NOT {Q.endswith_any('domain', _P03.restricted_suffixes)}
       AND NOT {Q.contains_any('domain', _P03.blocklist)} AND {Q.nonblank('domain')}),
site AS (SELECT host, arg_min(domain, page_id) AS website FROM ok GROUP BY host HAVING {Q.nonblank('host')}),
home AS (SELECT domain, arg_min({Q.TEL_HTML}, page_id) AS html FROM h GROUP BY domain),
shown AS (SELECT domain, {Q.shown_html('html')} AS s FROM home),
seen AS (SELECT domain, {Q.page_text('s')} AS text, {Q.tel_count('s')} AS calls FROM shown),
scored AS (SELECT domain, {_P03_SCORE} AS icp_score, {_P03_SYSTEM} AS booking_system, {_P03_REASON} AS agentic_reasoning FROM seen),
c AS (SELECT domain, page_id, concat('Pat P', CAST(page_id AS VARCHAR)) AS name, {_P03_TITLE} AS title, {_P03_EMAIL} AS email FROM h),
m AS (SELECT domain, arg_min(name, page_id) AS name, arg_min(title, page_id) AS title, arg_min(email, page_id) AS email
      FROM c WHERE {Q.contains_any('title', _P03.manager_keywords)} GROUP BY domain)
SELECT host AS clinic_name, 'Springfield' AS city, 'MI' AS state, website, name AS contact_name, title AS contact_title,
       email AS contact_email, CASE WHEN email <> '' THEN 'contacts:found' ELSE 'contacts:no_match' END AS email_source,
       icp_score, booking_system, agentic_reasoning
FROM site JOIN scored ON website = scored.domain LEFT JOIN m ON website = m.domain WHERE icp_score >= {_P03.threshold}""")
def p03_clinic_leads(spark, sf):
    """P3 over the pages table. Clinics are the distinct hosts, landed as
    registry JSON (S3); their search hits are the pages in page order (J5
    with F6/F7/F4); the homepage is the first page of the chosen site (S11),
    a third of them with nothing but click-to-call links (X4), whose visible
    text (X3) is scored (X5) and kept at >= 70 (F17); each page is also a
    contact of its site (W3). Rubric words are chosen to occur in this text."""
    from leadsmith.functions import domains as D
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    h = p.select("page_id", "url", D.host("url").alias("host"))
    clinics = h.groupBy("host").agg(F.min("page_id").alias("first_page"))
    body = F.to_json(F.struct(F.array(F.struct(
        F.struct(F.col("host").alias("organization_name")).alias("basic"),
        F.array(F.struct(F.lit("Springfield").alias("city"), F.lit("MI").alias("state"))).alias("addresses")))
        .alias("results")))
    registry = clinics.select(F.col("first_page").alias("page"), body.alias("body"))
    # registry rows are keyed page:pos, pos is always 0 here
    hits = h.join(clinics, "host").select(F.concat_ws(":", F.col("first_page"), F.lit(0)).alias("clinic_id"),
                                          F.col("page_id").alias("rank"), F.col("url").alias("href"))
    homepages = p.select(D.domain_netloc("url").alias("domain"), Q.spark_expr(Q.TEL_HTML).alias("html"), "page_id") \
                 .groupBy("domain").agg(F.min_by("html", "page_id").alias("html"))
    contacts = p.select(D.domain_netloc("url").alias("domain"), F.col("page_id").alias("pos"), F.lit("Pat").alias("first_name"),
                        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("last_name"),
                        Q.spark_expr(_P03_TITLE).alias("position"), Q.spark_expr(_P03_EMAIL).alias("value"))
    out, _rejections = FL.clinic_leads(registry, hits, homepages, contacts, _P03)
    return out


def _p06_reg_sql() -> str:
    from leadsmith.plans.q_scalars import _reg_sql
    return _reg_sql(Q.host("url"))


@register("p06_dealer_domains", f"""
WITH h AS (SELECT {Q.host('url')} AS company_key, page_id AS rank,
                  CASE split_part(regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]*)', 1), '/', 1)
                       WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS tier,
                  {_p06_reg_sql()} AS domain FROM pages),
v AS (SELECT * FROM h WHERE domain <> '' AND lower(domain) NOT IN ('example.net')),
b AS (SELECT company_key, arg_min(domain, (tier, rank)) AS website, arg_min(tier, (tier, rank)) AS found_tier
      FROM v GROUP BY company_key),
d AS (SELECT DISTINCT company_key FROM h)
SELECT d.company_key, b.website, b.found_tier FROM d LEFT JOIN b USING (company_key)""")
def p06_dealer_domains(spark, sf):
    """Dealers (here: every host) get the registered domain of their
    first acceptable hit over (tier, rank), tiers from the hit's language
    path, with an exact skip set of registered domains (F5, J6)."""
    from leadsmith.functions import domains as D
    p = table(spark, sf, "pages").select("page_id", "url")
    seg = F.regexp_extract("url", r"^[a-z]+://[^/]*/([^/?#]*)", 1)
    hits = p.select(D.host("url").alias("company_key"), F.col("page_id").alias("rank"),
                    F.when(seg == "en", 1).when(seg == "fr", 2).otherwise(3).alias("tier"),
                    F.col("url").alias("href"))
    dealers = hits.select("company_key").distinct()
    return FL.dealer_domains(dealers, hits, FL.DealerConfig(skip_domains=("example.net",)))


_P7_DEALER = ("c_custkey AS dealer_id, concat('nation-', CAST(c_nationkey AS VARCHAR), '.example.com') AS website, "
              "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Known Owner' ELSE '' END AS owner_name, "
              "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN concat('o', CAST(c_custkey AS VARCHAR), '@x.example.com') "
              "ELSE '' END AS owner_email")
_P7_CONTACT = ("concat('nation-', CAST(o_custkey % 25 AS VARCHAR), '.example.com') AS domain, o_orderkey AS pos, "
               "o_orderpriority AS first_name, CASE WHEN o_orderstatus = 'F' THEN 'Co-Owner' WHEN o_orderstatus = 'P' THEN 'Principal' END "
               "AS position, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE concat('c', CAST(o_orderkey AS VARCHAR), '@d.example.com') END "
               "AS value, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 97 AS INTEGER) END AS confidence")


def _shared_columns(df, columns: str):
    """The column list that the SQL twin selects."""
    return df.sparkSession.sql(f"SELECT {columns.replace('AS VARCHAR', 'AS STRING')} FROM {{df}}", df=df)


@register("p07_dealer_owners", f"""
WITH d AS (SELECT {_P7_DEALER} FROM customer),
c AS (SELECT {_P7_CONTACT} FROM orders),
r AS (SELECT *, {Q.keyword_rank('position', FL.DealerConfig().owner_titles, len(FL.DealerConfig().owner_titles))} AS title_rank FROM c),
b AS (SELECT domain, first_name, value FROM r
      QUALIFY row_number() OVER (PARTITION BY domain ORDER BY title_rank, coalesce(confidence, 0) DESC, pos) = 1)
SELECT d.dealer_id, d.website,
       CASE WHEN d.owner_name = '' AND d.owner_email = '' THEN b.first_name ELSE d.owner_name END AS owner_name,
       CASE WHEN d.owner_name = '' AND d.owner_email = '' THEN b.value ELSE d.owner_email END AS owner_email
FROM d LEFT JOIN b ON d.website = b.domain AND trim(b.value) <> ''""")
def p07_dealer_owners(spark, sf):
    """Dealers without an owner or e-mail take the best contact of their
    site by (title rank, -confidence, position); where that contact has no
    e-mail they take nothing. The sites sit on one domain per nation."""
    dealers = _shared_columns(table(spark, sf, "customer"), _P7_DEALER)
    contacts = _shared_columns(table(spark, sf, "orders"), _P7_CONTACT).withColumn("last_name", F.lit(None).cast("string"))
    out, _coverage = FL.dealer_owners(dealers, contacts)
    return out.select("dealer_id", "website", "owner_name", "owner_email")


# Customers as listing cards, 25 to a page: branches that collapse, a person, blank and
# short addresses, cities without a comma or too short, cards without a telephone link.
_P5_CARD = ("CAST(c_custkey // 25 AS INTEGER) AS page_no, c_custkey, "
            "CASE WHEN c_custkey % 17 = 0 THEN 'John Smith' WHEN c_custkey % 19 = 0 THEN ' ' "
            "ELSE concat('Yard ', CAST(c_custkey % 700 AS VARCHAR), CASE WHEN c_custkey % 2 = 0 THEN ' Tractor, Inc.' ELSE ' Tractor Co' END, "
            "' - ', c_mktsegment) END AS name, "
            "CASE WHEN c_custkey % 11 = 0 THEN '1234567' WHEN c_custkey % 13 = 0 THEN '12 A' "
            "ELSE concat(CAST(c_custkey AS VARCHAR), ' Main Street') END AS address, "
            "CASE c_nationkey WHEN 3 THEN 'Troy, MI 48084' WHEN 4 THEN 'Lansing' WHEN 5 THEN 'Lansing,' "
            "ELSE concat('Lansing, OH 4', CAST(c_nationkey AS VARCHAR)) END AS city_line, "
            "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE concat('555', CAST(c_custkey AS VARCHAR)) END AS tel")


@register("p05_dealer_cards", f"""
WITH k AS (SELECT {_P5_CARD} FROM customer),
c AS (SELECT page_no, CAST(row_number() OVER (PARTITION BY page_no ORDER BY c_custkey) - 1 AS INTEGER) AS card_no,
             trim(split_part(name, ' - ', 1)) AS company, address, tel AS phone,
             CASE WHEN contains(city_line, ',') THEN trim(split_part(city_line, ',', 1)) ELSE '' END AS city,
             trim(regexp_extract(city_line, ',(.*)$', 1)) AS rest FROM k),
g AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(company), '\\b(inc|llc|ltd|co|corp|company|equipment)\\b\\.?', '', 'g'),
                    '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS company_key FROM c
      WHERE company <> '' AND company <> 'John Smith' AND NOT contains(lower(company), 'yard 7')
        AND length(address) >= 6 AND NOT regexp_full_match(address, '[0-9]+') AND length(city) >= 6)
SELECT company_key, page_no, card_no, company, address, city, coalesce(nullif(split_part(rest, ' ', 1), ''), 'MI') AS state,
       split_part(rest, ' ', 2) AS zip, phone
FROM g QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY page_no, card_no) = 1""")
def p05_dealer_cards(spark, sf):
    """P5: customers rendered as directory cards, 25 to a page, read back by
    the card parser (S10), cleaned, filtered and collapsed per company."""
    cards = _shared_columns(table(spark, sf, "customer"), _P5_CARD.replace(" // ", " div "))
    tel = F.when(F.col("tel") != "", F.concat(F.lit('<a href="tel:'), "tel", F.lit('">call</a>'))).otherwise("")
    card = F.concat(F.lit('<div class="card dealer-directory-listing"><a class="dealer-title-text" href="/d">'), "name",
                    F.lit('</a><div class="dealer-data-text">'), "address", F.lit('</div><div class="dealer-data-text">'), "city_line",
                    F.lit("</div>"), tel, F.lit("</div>"))
    # a page holds 25 cards, so its list is bounded
    pages = cards.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("c_custkey", card.alias("card")))).alias("cards"))
    pages = pages.select("page_no", F.concat(F.lit("<html><body>"), F.array_join("cards.card", "\n"), F.lit("</body></html>")).alias("html"))
    out = FL.dealer_cards(pages, FL.DealerConfig(excluded=("yard 7",)))
    return out.select("company_key", "page_no", "card_no", "company", "address", "city", "state", "zip", "phone")


# Orders as search hits, one result page for every 40 order keys.
_P10_LINK = ("o_orderkey // 40 AS page_no, o_orderkey, "
             "concat('https://www.', CASE WHEN o_orderpriority = '5-LOW' THEN concat('yelp.com/biz/', CAST(o_orderkey AS VARCHAR)) "
             "ELSE concat('shop', CAST(o_custkey AS VARCHAR), '.example.com/p') END) AS href, "
             "concat('Shop ', CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN ' - Home' ELSE ' CNC' END) AS title")
_P10_CONTACT = ("concat('shop', CAST(c_custkey // 2 * 2 AS VARCHAR), '.example.com') AS domain, c_custkey AS pos, c_name AS first_name, "
                "CASE c_mktsegment WHEN 'BUILDING' THEN 'Plant Manager' WHEN 'MACHINERY' THEN 'VP Operations' WHEN 'HOUSEHOLD' THEN 'Clerk' END "
                "AS position, concat('c', CAST(c_custkey AS VARCHAR), '@s.example.com') AS value")


@register("p10_machine_shops", f"""
WITH l AS (SELECT {_P10_LINK} FROM orders),
p AS (SELECT *, row_number() OVER (PARTITION BY page_no ORDER BY o_orderkey) AS pos,
             split_part(regexp_replace(href, '^https://www\\.', ''), '/', 1) AS domain FROM l),
s AS (SELECT domain, split_part(title, ' - ', 1) AS company_name FROM p WHERE NOT {Q.contains_any('domain', FL.ShopConfig().blocklist)}
      QUALIFY row_number() OVER (PARTITION BY domain ORDER BY page_no, pos) = 1),
c AS (SELECT *, {Q.contains_any('position', FL.ShopConfig().positions)} AS hit FROM (SELECT {_P10_CONTACT} FROM customer)),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY domain ORDER BY hit DESC, pos) = 1)
SELECT s.company_name, s.domain AS website, b.first_name AS contact_name, b.position AS contact_title, b.value AS contact_email,
       CASE WHEN b.domain IS NULL THEN 'not_found' WHEN b.hit THEN 'contacts:matched' ELSE 'contacts:fallback' END AS email_source
FROM s LEFT JOIN b USING (domain)""")
def p10_machine_shops(spark, sf):
    """P10: orders rendered as search-result pages of at most 40 links (S9),
    loose domain, blocklist, keep-first per domain, contact by position."""
    links = _shared_columns(table(spark, sf, "orders"), _P10_LINK.replace(" // ", " div "))
    link = F.concat(F.lit('<a rel="noopener noreferrer" class="result__a" href="'), "href", F.lit('">'), "title", F.lit("</a>"))
    # a page spans 40 order keys, so its list is bounded
    pages = links.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", link.alias("link")))).alias("links"))
    pages = pages.select("page_no", F.array_join("links.link", "<br>").alias("html"))
    contacts = _shared_columns(table(spark, sf, "customer"), _P10_CONTACT.replace(" // ", " div ")).withColumn("last_name", F.lit(""))
    return FL.machine_shops(pages, contacts)
