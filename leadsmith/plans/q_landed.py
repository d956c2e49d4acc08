"""Landed responses, daily folders, staged tiers and runs that resume
(SURVEY S12, J6, J7, S7, U2, D2, D3, A3, K5, T1, E4, F13).

Each query first lands what a service or an earlier stage would have left
(derived from the whole driver tables), then reads it back through the
library.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from leadsmith import sinks as K
from leadsmith.functions import calendar as CAL
from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.operators import candidates as C
from leadsmith.operators import dedupe as DD
from leadsmith.operators import metrics as M
from leadsmith.operators import predicates as P
from leadsmith.plans import flows as FL
from leadsmith.plans import q_flows
from leadsmith.plans import sqlbits as Q
from leadsmith.plans.q_filters import INSTITUTIONAL
from leadsmith.plans.registry import register
from leadsmith.session import checkpoint_dir
from leadsmith.sources import landed as S
from leadsmith.sources import responses as R
from leadsmith.sources.tables import table
from leadsmith.streaming import enrich as ST


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- S12: response tables ---------------------------------------------------

def _responses(spark, sf, kind: str, sent):
    """Land (key, status, body) as JSON lines, with one unreadable line a
    region between them, and read them as ``kind``."""
    junk = table(spark, sf, "region").select(F.concat(F.lit("<html>"), "r_name").alias("value"))
    path = _scratch(spark, f"s12-{kind}")
    sent.select(F.to_json(F.struct("key", "status", "body")).alias("value")).unionByName(junk).write.text(path)
    return R.results(R.landed(spark, path), kind)


def _s12_sql(good: str, dead: str, columns: str) -> str:
    """Twin of a response query: ``good`` rows and ``dead`` (key, error, raw) over the
    given columns, and the unreadable lines."""
    none = ", ".join(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", "))
    names = ", ".join(c.split()[0] for c in columns.split(", "))
    return f"""
WITH good AS ({good}), dead AS ({dead}
  UNION ALL SELECT CAST(NULL AS VARCHAR), 'unreadable line', '<html>' || r_name FROM region)
SELECT key, rank, {names}, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS raw FROM good
UNION ALL SELECT key, CAST(NULL AS INTEGER), {none}, error, raw FROM dead"""


@register("s12_organizations", _s12_sql("""
  SELECT 'Company ' || c_custkey AS key, CAST(i - 1 AS INTEGER) AS rank, 'org-' || c_custkey || '-' || i AS org_id, c_name AS name,
         CASE WHEN i = 1 THEN 'c' || c_custkey || '.example.com' END AS domain
  FROM customer, range(1, 3) r(i) WHERE i <= c_custkey % 3 AND c_custkey % 89 <> 3 AND c_custkey % 97 <> 5""", """
  SELECT 'Company ' || c_custkey AS key, CASE WHEN c_custkey % 89 = 3 THEN 'status 503' ELSE 'body does not fit' END AS error,
         CASE WHEN c_custkey % 89 = 3 THEN '' ELSE '{"organizations": [' END AS raw
  FROM customer WHERE c_custkey % 89 = 3 OR c_custkey % 97 = 5""", "org_id VARCHAR, name VARCHAR, domain VARCHAR"))
def s12_organizations(spark, sf):
    """Organisation searches; none, one or two results, cut bodies and failed requests."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    found = F.expr("""to_json(named_struct('organizations', transform(filter(array(1, 2), i -> i <= c_custkey % 3), i -> named_struct(
        'id', concat('org-', c_custkey, '-', i), 'name', c_name, 'primary_domain', CASE WHEN i = 1 THEN concat('c', c_custkey, '.example.com') END))))""")
    body = F.when(k % 89 == 3, F.lit("")).when(k % 97 == 5, F.lit('{"organizations": [')).otherwise(found)
    return _responses(spark, sf, "organizations", c.select(F.concat(F.lit("Company "), k).alias("key"), F.when(k % 89 == 3, 503).otherwise(200).alias("status"), body.alias("body")))


@register("s12_people", _s12_sql("""
  SELECT 'org-' || o_custkey AS key, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS rank,
         CAST(o_orderkey AS VARCHAR) AS id, 'F' || o_orderkey AS first_name, CASE WHEN o_orderstatus <> 'F' THEN 'L' END AS last_name,
         o_orderpriority AS title, CASE WHEN o_orderkey % 5 <> 0 THEN 'p' || o_orderkey || '@example.com' END AS email
  FROM orders WHERE o_custkey % 97 <> 5""", """
  SELECT DISTINCT 'org-' || o_custkey AS key, 'body does not fit' AS error, '{"people": "none"}' AS raw FROM orders WHERE o_custkey % 97 = 5""",
                                 "id VARCHAR, first_name VARCHAR, last_name VARCHAR, title VARCHAR, email VARCHAR"))
def s12_people(spark, sf):
    """People of an organisation in the service's order; a list that is a text is a dead letter."""
    one = F.struct(F.col("o_orderkey").alias("n"), F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("F"), "o_orderkey").alias("first_name"),
        F.when(F.col("o_orderstatus") != "F", F.lit("L")).alias("last_name"), F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("p"), "o_orderkey", F.lit("@example.com"))).alias("email")).alias("p"))
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(one)).alias("ps"))
    body = F.when(F.col("o_custkey") % 97 == 5, F.lit('{"people": "none"}')).otherwise(F.to_json(F.struct(F.col("ps.p").alias("people"))))
    return _responses(spark, sf, "people", per.select(F.concat(F.lit("org-"), "o_custkey").alias("key"), F.lit(200).alias("status"), body.alias("body")))


@register("s12_match", _s12_sql("""
  SELECT CAST(s_suppkey AS VARCHAR) AS key, CAST(0 AS INTEGER) AS rank, CASE WHEN s_suppkey % 7 <> 1 THEN s_name || '@example.com' END AS email
  FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 11 <> 2 AND s_suppkey % 13 <> 3""", """
  SELECT CASE WHEN s_suppkey % 13 <> 3 THEN CAST(s_suppkey AS VARCHAR) END AS key,
         CASE WHEN s_suppkey % 13 = 3 THEN 'no key' ELSE 'body does not fit' END AS error,
         CASE WHEN s_suppkey % 11 = 2 THEN '{"person": {"email": ' WHEN s_suppkey % 4 = 0 THEN '{"person": null}' WHEN s_suppkey % 7 = 1 THEN '{"person": {}}'
              ELSE '{"person":{"email":"' || s_name || '@example.com"}}' END AS raw
  FROM supplier WHERE s_suppkey % 11 = 2 OR s_suppkey % 13 = 3""", "email VARCHAR"))
def s12_match(spark, sf):
    """E-mail by person id; no person, a person without an e-mail, lines without a key."""
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    body = (F.when(k % 11 == 2, F.lit('{"person": {"email": ')).when(k % 4 == 0, F.lit('{"person": null}')).when(k % 7 == 1, F.lit('{"person": {}}'))
            .otherwise(F.to_json(F.struct(F.struct(F.concat("s_name", F.lit("@example.com")).alias("email")).alias("person")))))
    return _responses(spark, sf, "match", s.select(F.when(k % 13 != 3, k.cast("string")).alias("key"), F.lit(200).alias("status"), body.alias("body")))


@register("s12_suggest", _s12_sql("""
  SELECT 'brand ' || p_partkey AS key, CAST(i - 1 AS INTEGER) AS rank, p_name || ' ' || i AS name, 'b' || p_partkey || '.example.net' AS domain
  FROM part, range(1, 3) r(i) WHERE i <= p_partkey % 3 AND p_partkey % 97 <> 5 AND p_partkey % 89 <> 3""", """
  SELECT 'brand ' || p_partkey AS key, CASE WHEN p_partkey % 89 = 3 THEN 'status unknown' ELSE 'body does not fit' END AS error,
         '{"error": "limit"}' AS raw FROM part WHERE p_partkey % 97 = 5 OR p_partkey % 89 = 3""", "name VARCHAR, domain VARCHAR"))
def s12_suggest(spark, sf):
    """Company suggestions, a list without an object around it; an object in its place is a dead letter."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    found = F.expr("""to_json(transform(filter(array(1, 2), i -> i <= p_partkey % 3), i -> named_struct(
        'name', concat(p_name, ' ', i), 'domain', concat('b', p_partkey, '.example.net'))))""")
    body = F.when((k % 97 == 5) | (k % 89 == 3), F.lit('{"error": "limit"}')).otherwise(found)
    return _responses(spark, sf, "suggest", p.select(F.concat(F.lit("brand "), k).alias("key"), F.when(k % 89 != 3, 200).alias("status"), body.alias("body")))


@register("s12_videos", _s12_sql("""
  SELECT 'batch ' || event_id // 50 AS key, CAST(row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS INTEGER) AS rank,
         'v' || event_id AS video_id, CASE WHEN event_type <> 'error' THEN CAST(event_id * 3 AS VARCHAR) END AS "viewCount",
         CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS "likeCount", '0' AS "commentCount"
  FROM events WHERE event_id // 50 % 7 <> 3""", """
  SELECT DISTINCT 'batch ' || event_id // 50 AS key, 'status 429' AS error, 'slow down' AS raw FROM events WHERE event_id // 50 % 7 = 3""",
                                 'video_id VARCHAR, "viewCount" VARCHAR, "likeCount" VARCHAR, "commentCount" VARCHAR'))
def s12_videos(spark, sf):
    """Statistics of fifty videos a response; hidden counts are absent, a refused request is a dead letter."""
    e = table(spark, sf, "events").withColumn("batch", F.expr("event_id div 50"))
    one = F.struct(F.col("event_id").alias("n"), F.struct(F.concat(F.lit("v"), "event_id").alias("id"), F.struct(
        F.when(F.col("event_type") != "error", (F.col("event_id") * 3).cast("string")).alias("viewCount"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("likeCount"),
        F.lit("0").alias("commentCount")).alias("statistics")).alias("v"))
    per = e.groupBy("batch").agg(F.sort_array(F.collect_list(one)).alias("vs"))
    refused = F.col("batch") % 7 == 3
    body = F.when(refused, F.lit("slow down")).otherwise(F.to_json(F.struct(F.col("vs.v").alias("items"))))
    return _responses(spark, sf, "videos", per.select(F.concat(F.lit("batch "), "batch").alias("key"), F.when(refused, 429).otherwise(200).alias("status"), body.alias("body")))


# --- J7: a large list of substrings ------------------------------------------

@register("j07_substring_list", """
WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN upper(x) ELSE x END AS domain FROM (
  SELECT c_custkey, 'shop' || c_custkey || '.' || lower(c_mktsegment) || '.example.' || CASE WHEN c_custkey % 2 = 0 THEN 'com' ELSE 'net' END AS x FROM customer)),
b AS (SELECT DISTINCT lower('P' || l_orderkey || CASE l_linenumber % 3 WHEN 0 THEN '.building' WHEN 1 THEN '.household.ex' ELSE '.none' END) AS entry FROM lineitem
      UNION SELECT DISTINCT lower(l_returnflag || l_linestatus) FROM lineitem UNION SELECT '9.f')
SELECT c_custkey, domain FROM d WHERE NOT EXISTS (SELECT 1 FROM b WHERE contains(lower(d.domain), b.entry))""")
def j07_substring_list(spark, sf):
    """Domains that contain none of a list of substrings, one or more an
    order, of which most are in no domain; two-letter and blank ones too."""
    c = table(spark, sf, "customer")
    x = F.concat(F.lit("shop"), "c_custkey", F.lit("."), F.lower("c_mktsegment"), F.lit(".example."),
                 F.when(F.col("c_custkey") % 2 == 0, F.lit("com")).otherwise(F.lit("net")))
    doms = c.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.upper(x)).otherwise(x).alias("domain"))
    li = table(spark, sf, "lineitem")
    part = F.when(F.col("l_linenumber") % 3 == 0, ".building").when(F.col("l_linenumber") % 3 == 1, ".household.ex").otherwise(".none")
    listed = (li.select(F.concat(F.lit("P"), "l_orderkey", part).alias("entry"))
              .unionByName(li.select(F.concat("l_returnflag", "l_linestatus").alias("entry")).distinct())
              .unionByName(spark.createDataFrame([("9.f",), ("",), (None,)], "entry string")))
    return D.drop_blocked(doms, "domain", listed, mode="substring", entry="entry")


# --- U2, D2, D3: days by folder ------------------------------------------------

def _land_days(spark, sf, name: str) -> str:
    """All events in folders by day, a line of a daily index each."""
    form = F.when(F.col("event_type") == "click", "D").when(F.col("event_type") == "view", "D/A").otherwise("10-K")
    path = F.concat(F.lit("edgar/data/"), "user_id", F.lit("/"), F.lpad(F.col("event_id").cast("string"), 10, "0"), F.lit(".txt"))
    line = F.concat(F.rpad(form, 12, " "), F.rpad(F.concat(F.lit("User "), "user_id", F.lit(" Inc")), 62, " "),
                    F.lpad(F.col("user_id").cast("string"), 10, "0"), F.lit("  "), F.date_format("ts", "yyyyMMdd"), F.lit("  "), path)
    out = _scratch(spark, name)
    days = table(spark, sf, "events").select(F.to_date("ts").alias("day"), line.alias("value"))
    days.write.partitionBy("day").text(out)  # a file a task and day: a busy day is no single task
    return out


def _newest(spark, path: str) -> dt.date:
    return CAL.landed_days(spark, path).agg(F.max("day")).first()[0]


@register("d02_landed_day", """
WITH t AS (SELECT CAST(max(ts) AS DATE) + 3 AS today FROM events)
SELECT max(CAST(ts AS DATE)) AS day FROM events, t WHERE CAST(ts AS DATE) BETWEEN today - 4 AND today - 1""")
def d02_landed_day(spark, sf):
    """D2 over folders by day: the newest one within four days, no file opened."""
    path = _land_days(spark, sf, "d02")
    return CAL.latest_landed(spark, path, _newest(spark, path) + dt.timedelta(days=3))


@register("d03_landed_gaps", """
WITH t AS (SELECT CAST(max(ts) AS DATE) + 5 AS today FROM events)
SELECT CAST(today - CAST(i AS INTEGER) AS DATE) AS day FROM t, range(1, 41) r(i) WHERE CAST(today - CAST(i AS INTEGER) AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""")
def d03_landed_gaps(spark, sf):
    """D1 + D3 over folders by day: the requested days that did not land."""
    path = _land_days(spark, sf, "d03")
    wanted = CAL.last_days(spark, _newest(spark, path) + dt.timedelta(days=5), 40)
    return CAL.missing_days(wanted, CAL.landed_days(spark, path))


@register("u02_daily_index", """
WITH t AS (SELECT CAST(max(ts) AS DATE) + 2 AS today FROM events)
SELECT CAST(ts AS DATE) AS day, CASE event_type WHEN 'click' THEN 'D' ELSE 'D/A' END AS form_type, 'User ' || user_id || ' Inc' AS company_name,
       CAST(user_id AS VARCHAR) AS cik, strftime(ts, '%Y%m%d') AS date_filed,
       'edgar/data/' || user_id || '/' || lpad(CAST(event_id AS VARCHAR), 10, '0') || '.txt' AS rel_path
FROM events, t WHERE event_type IN ('click', 'view') AND CAST(ts AS DATE) BETWEEN today - 7 AND today - 1""")
def u02_daily_index(spark, sf):
    """The daily indexes of the last seven days in one scan (the newest
    day has not landed yet); other folders are pruned."""
    path = _land_days(spark, sf, "u02")
    lines = CAL.within_days(spark.read.text(path), _newest(spark, path) + dt.timedelta(days=2))
    return S.index_rows(lines, "value", keep=["day"])


# --- J6: tiers read one after the other -----------------------------------------

_TIER_SQL = "CASE split_part(regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]*)', 1), '/', 1) WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END"


@register("j06_staged", f"""
WITH h AS (SELECT {Q.host('url')} AS entity, page_id, url, {_TIER_SQL} AS tier FROM pages)
SELECT entity, arg_min(url, (tier, page_id)) FILTER (WHERE page_id % 3 <> 1) AS best_url,
       CAST(min(tier) FILTER (WHERE page_id % 3 <> 1) AS INTEGER) AS tier
FROM h WHERE entity <> '' GROUP BY entity""")
def j06_staged(spark, sf):
    """Pages of three tiers by host; a tier is read only for the hosts that
    the tiers before it left open."""
    p = table(spark, sf, "pages")
    seg = F.regexp_extract("url", r"^[a-z]+://[^/]*/([^/?#]*)", 1)
    hits = p.select(D.host("url").alias("entity"), "page_id", "url", F.when(seg == "en", 1).when(seg == "fr", 2).otherwise(3).alias("t")).where("entity <> ''")
    base = _scratch(spark, "j06")
    for t in (1, 2, 3):
        C.land_tier(hits.where(F.col("t") == t).drop("t"), f"{base}/{t}", "entity", 64)
    schema = "entity string, page_id bigint, url string, bucket int"
    tiers = [lambda t=t: spark.read.schema(schema).parquet(f"{base}/{t}") for t in (1, 2, 3)]
    out, _ = C.staged_first_valid(hits.select("entity"), tiers, "entity", ["page_id"], F.col("page_id") % 3 != 1, ["url"], "best_", buckets=64)
    return out


# --- S7: inferred CSV with a rescue column -----------------------------------------

@register("s07_csv_rescued", """
SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 1 THEN c_name END AS c_name, CASE WHEN c_custkey % 50 <> 49 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 50 = 49 THEN c_custkey || ',' || CASE WHEN c_nationkey % 5 <> 1 THEN c_name ELSE '' END END AS rescued
FROM customer WHERE c_nationkey % 5 <> 1 OR c_custkey % 50 = 49""")
def s07_csv_rescued(spark, sf):
    """S7 in one pass: types from a sample, unnamed rows drop, rows with a field
    missing are kept as lines."""
    c = table(spark, sf, "customer")
    name = F.when(F.col("c_nationkey") % 5 != 1, F.col("c_name")).otherwise("")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), name, F.when(F.col("c_custkey") % 50 != 49, F.col("c_acctbal").cast("string")))
    file = F.col("c_custkey") % 4
    lines = c.select(file.alias("file"), F.col("c_custkey").alias("at"), line.alias("value"))
    heads = spark.range(4).select(F.col("id").alias("file"), F.lit(-1).cast("bigint").alias("at"), F.lit("c_custkey,c_name,c_acctbal").alias("value"))
    path = _scratch(spark, "s07r")
    lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    back = S.read_csv_rescued(spark, f"{path}/file=*", ["c_name"], rescued="rescued")
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "rescued")


# --- K5, A3: runs that resume -----------------------------------------------------

@register("k05_resume", "SELECT c_custkey, upper(c_name) AS label, c_acctbal FROM customer")
def k05_resume(spark, sf):
    """K5: a run in six batches dies in its fourth, after the batch's rows were
    written and before they were committed; it is repeated, twice."""
    todo = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    ledger = K.CommitLedger(spark, _scratch(spark, "k05"))

    class Killed(Exception):
        pass

    def work(df):
        return df.select("c_custkey", F.upper("c_name").alias("label"), "c_acctbal")

    class Dying(K.CommitLedger):
        def commit(self, run, batch):
            if batch == 3:
                raise Killed
            super().commit(run, batch)

    try:
        K.resumable(Dying(spark, ledger.path), todo, "c_custkey", work, "first", 6)
    except Killed:
        pass
    for _ in range(2):
        K.resumable(ledger, todo, "c_custkey", work, "first", 6)
    return ledger.read("c_custkey bigint, label string, c_acctbal double").drop("run", "batch")


@register("a03_across_runs", """
SELECT CAST(o_custkey AS VARCHAR) AS cust, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, CAST(min(o_orderdate) AS DATE) AS day
FROM orders GROUP BY o_custkey""")
def a03_across_runs(spark, sf):
    """A3 in three runs by date, the second of which is repeated: together they
    keep what one run over all days keeps."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("cust"), "o_orderkey", F.to_date("o_orderdate").alias("day"))
    base = _scratch(spark, "a03")
    ledger = DD.KeyLedger(f"{base}/keys", "cust", "string", 32)
    out = K.CommitLedger(spark, f"{base}/out")
    runs = [("1", "day < '1996-01-01'"), ("2", "day between '1996-01-01' and '1997-12-31'"), ("2", "day between '1996-01-01' and '1997-12-31'"),
            ("3", "day > '1997-12-31'")]
    for run, days in runs:
        new = ledger.new(o.where(days), ["day", "o_orderkey"], run)
        out.write(new, run, 0)
        ledger.commit(new, run)
    return out.read("cust string, o_orderkey bigint, day date").drop("run", "batch")


# --- T1: lookups that land after their entity ------------------------------------

@register("t01_late_lookup", """
WITH c AS (SELECT c_custkey, c_name, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * (c_custkey % 1500) AS came FROM customer),
o AS (SELECT o_custkey, o_orderkey, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * (o_custkey % 1500) + INTERVAL 1 HOUR * (o_orderkey % 100 - 10) AS landed FROM orders)
SELECT c_custkey, c_name, min(o_orderkey) AS o_orderkey FROM c LEFT JOIN o ON o_custkey = c_custkey
  AND landed <= came + INTERVAL 48 HOUR AND landed >= came - INTERVAL 48 HOUR GROUP BY ALL""")
def t01_late_lookup(spark, sf):
    """Orders land from ten hours before to ninety hours after their
    customer, in two runs; each customer comes out once, with its first order
    of those that landed within 48 hours."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    second = F.expr("INTERVAL 1 SECOND")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", (start + second * (F.col("c_custkey") % 1500)).alias("at"))
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        (start + second * (F.col("o_custkey") % 1500) + F.expr("INTERVAL 1 HOUR") * (F.col("o_orderkey") % 100 - 10)).alias("landed"))
    base = _scratch(spark, "t01late")
    args = (spark, f"{base}/entities", "c_custkey bigint, c_name string, at timestamp", f"{base}/lookups", "c_custkey bigint, o_orderkey bigint, landed timestamp",
            "c_custkey", "at", "landed", ["o_orderkey"], ["o_orderkey"], f"{base}/out", f"{base}/ckpt")
    c.write.parquet(f"{base}/entities")
    early = F.col("landed") < start + F.expr("INTERVAL 20 HOURS")
    o.where(early).write.parquet(f"{base}/lookups/run=1")
    ST.run_late_enrichment(*args, wait="48 hours")
    o.where(~early).write.parquet(f"{base}/lookups/run=2")
    ST.run_late_enrichment(*args, wait="48 hours", close=True)
    return spark.read.parquet(f"{base}/out").select("c_custkey", "c_name", "o_orderkey")


# --- E4, F13: counts from the job that writes ------------------------------------

@register("e04_flow_counters", f"""
WITH r AS (SELECT c_acctbal, c_name, CAST(c_acctbal / 100 AS VARCHAR) AS units FROM customer JOIN nation ON c_nationkey = n_nationkey),
u AS (SELECT c_acctbal IS NOT NULL AND trim(c_name) <> '' AS named,
             regexp_matches(trim(units), '{X.NUMERIC_RE}') AND trunc(TRY_CAST(trim(units) AS DOUBLE)) BETWEEN 5 AND 50 AS fits FROM r),
o AS ({q_flows._P01_SQL})
SELECT 'registry' AS stage, 'n_rows' AS counter, count(*) AS n FROM u
UNION ALL SELECT 'registry', 'n_named', count(*) FILTER (WHERE named) FROM u
UNION ALL SELECT 'registry', 'n_in_range', count(*) FILTER (WHERE named AND fits) FROM u
UNION ALL SELECT 'records', 'n_rows', count(*) FROM o
UNION ALL SELECT 'records', 'n_email', count(*) FILTER (WHERE {Q.nonblank('email')}) FROM o
UNION ALL SELECT 'records', 'n_to_enrich', count(*) FILTER (WHERE NOT {Q.nonblank('email')}) FROM o""")
def e04_flow_counters(spark, sf):
    """What each stage of P1 read and kept, counted while its output is written."""
    counters = M.StageCounters("carriers")
    leads = FL.carrier_leads(q_flows._registry(spark, sf), counters=counters)
    K.ordered_csv(leads, _scratch(spark, "e04"), FL.CARRIER_OUTPUT, ["state", "power_units", "company"])
    return counters.frame(spark)


@register("f13_counted_once", f"""
SELECT count(*) FILTER (WHERE NOT {Q.contains_any('p_type', INSTITUTIONAL)}) AS n_kept,
       count(*) FILTER (WHERE {Q.contains_any('p_type', INSTITUTIONAL)}) AS n_removed FROM part""")
def f13_counted_once(spark, sf):
    """the kept rows are written and counted in one pass."""
    kept, counts = P.filter_counted(table(spark, sf, "part"), ~X.contains_any("p_type", INSTITUTIONAL), counters=M.StageCounters("filings"))
    kept.write.parquet(_scratch(spark, "f13"))
    return counts
