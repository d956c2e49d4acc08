"""Landed responses, substring lists, daily folders, staged tiers, runs that
resume and counters (SURVEY S12, J7, U2, D2, D3, J6, K5, A3, T1, E4, S7)."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from leadsmith import sinks as K
from leadsmith.functions import calendar as CAL
from leadsmith.functions import domains as D
from leadsmith.operators import candidates as C
from leadsmith.operators import dedupe as DD
from leadsmith.operators import metrics as M
from leadsmith.operators import predicates as P
from leadsmith.plans import flows as FL
from leadsmith.sources import landed as S
from leadsmith.sources import responses as R
from leadsmith.streaming import enrich as ST
from tests.conftest import rows


@pytest.fixture
def folder():
    return tempfile.mkdtemp(dir="/tmp")


# --- S12

def land(spark, folder, *lines):
    path = tempfile.mkdtemp(dir=folder) + "/r"
    text = [x if isinstance(x, str) else json.dumps({"key": x[0], "status": x[1], "body": x[2] if isinstance(x[2], (str, type(None))) else json.dumps(x[2])})
            for x in lines]
    spark.createDataFrame([(x,) for x in text], "value string").write.text(path)
    return path


CASES = {
    "organizations": ({"organizations": [{"id": "o1", "name": "A", "primary_domain": "a.com"}, {"id": "o2"}]},
                      [(0, "o1", "A", "a.com"), (1, "o2", None, None)], {"organizations": {"id": "o1"}}),
    "people": ({"people": [{"id": "p", "first_name": "F", "last_name": None, "title": "CEO"}], "total": 3}, [(0, "p", "F", None, "CEO", None)], {"people": 3}),
    "match": ({"person": {"email": "x@y"}}, [(0, "x@y")], {"person": "none"}),
    "contacts": ({"data": {"emails": [{"value": "v", "position": "Owner", "confidence": 90}]}}, [(0, None, None, "Owner", "v", 90)],
                 {"data": {"emails": [{"value": "v", "confidence": "high"}]}}),
    "suggest": ([{"name": "A", "domain": "a.com"}, {}], [(0, "A", "a.com"), (1, None, None)], {"name": "A"}),
    "search": ([{"href": "h", "title": "t"}], [(0, "h", None, "t")], {"results": []}),
    "channels": ({"items": [{"id": "c", "statistics": {"subscriberCount": "5"}, "contentDetails": {"relatedPlaylists": {"uploads": "u"}}}]},
                 [(0, "c", "5", None, "u")], {"items": "no"}),
    "playlist": ({"items": [{"contentDetails": {"videoId": "v", "videoPublishedAt": "2024"}}, {}]}, [(0, "v", "2024"), (1, None, None)], {"items": [1]}),
    "videos": ({"items": [{"id": "v", "statistics": {"viewCount": "7", "commentCount": "0"}}]}, [(0, "v", "7", None, "0")], {"items": [{"statistics": []}]}),
}


@pytest.mark.parametrize("kind", CASES)
def test_responses_and_their_dead_letters(spark, folder, kind):
    body, want, misfit = CASES[kind]
    empty = [] if R.RESPONSES[kind].listed else {}
    path = land(spark, folder, ("k", 200, body), ("cut", 200, json.dumps(body)[:-1]), ("misfit", 200, misfit), ("none", 200, empty), ("gone", 404, "nothing"),
                ("null", 200, None), ("odd", None, body), (None, 200, body), "<html>", "", ("k", 200, body))
    good, dead = R.scan(spark, path, kind)
    assert sorted((tuple(r) for r in good.collect()), key=repr) == sorted([("k", *w) for w in want] * 2, key=repr)
    assert sorted((r["key"] or "", r["error"]) for r in dead.collect()) == [
        ("", "no key"), ("", "unreadable line"), ("cut", "body does not fit"), ("gone", "status 404"), ("misfit", "body does not fit"),
        ("null", "body does not fit"), ("odd", "status unknown")]
    raw = {r["error"]: r["raw"] for r in dead.collect()}
    assert raw["unreadable line"] == "<html>" and raw["status 404"] == "nothing"


def test_a_pruned_scan_finds_the_same_dead_letters(spark, folder):
    path = land(spark, folder, *[(str(i), 200, CASES["contacts"][2 if i % 3 == 0 else 0]) for i in range(12)])
    good, dead = R.scan(spark, path, "contacts")
    assert good.select("rank").count() == 8 and good.select("value").distinct().count() == 1 and dead.select("key").count() == 4


def test_landed_responses_feed_a_flow(spark, folder):
    people = [{"id": "p1", "first_name": "Ann", "last_name": "Lee", "title": "Owner", "email": "ann@a.com"}, {"id": "p2", "title": "Driver"}]
    orgs, _ = R.scan(spark, land(spark, folder, ("ACME", 200, CASES["organizations"][0])), "organizations")
    who, _ = R.scan(spark, land(spark, folder, ("o1", 200, {"people": people[::-1]})), "people")
    mails, _ = R.scan(spark, land(spark, folder, ("a.com", 200, CASES["contacts"][0])), "contacts")
    pages = spark.createDataFrame([("MI", 0, 0, "7", "ACME", "10", "")], "state string, page int, pos int, dot_number string, legal_name string, nbr_power_unit string, email_address string")
    out = FL.carrier_leads(pages, orgs=orgs.withColumnRenamed("key", "company"), people=who.select(F.col("key").alias("org_id"), F.col("rank").alias("pos"), "first_name", "last_name", "title", "email"),
                           contacts=mails.select(F.col("key").alias("domain"), F.col("rank").alias("pos"), "first_name", "last_name", "position", "value"))
    assert [(r["owner_name"], r["owner_email"], r["email_source"]) for r in out.collect()] == [("Ann Lee", "ann@a.com", "people:found")]


# --- J7

def test_substring_list_equals_contains(spark):
    rng = random.Random(2)
    part = lambda n: "".join(rng.choice("abcd.") for _ in range(n))
    doms = [(i, part(rng.randint(0, 14)) if i % 9 else None) for i in range(400)] + [(900 + i, "Hot.COM") for i in range(200)]
    listed = [(part(rng.randint(1, 9)),) for _ in range(60)] + [("",), (None,), ("HOT",), ("zzzz",)]
    listed = [e for e in listed if e[0] is None or len(e[0]) != 1]
    df = spark.createDataFrame([(i, d, 1) for i, d in doms], "id int, domain string, gram int")
    bl = spark.createDataFrame(listed, "domain string")
    want = sorted(i for i, d in doms if not d or not any(e and e.lower() in d.lower() for e, in listed))
    assert 0 < len(want) < 400
    for q in (2, 3, 4, 7):
        assert [r[0] for r in rows(D.drop_containing(df, "domain", bl, q=q), "id")] == want
    assert rows(D.drop_blocked(df, "domain", bl, "substring"), "id") == [(i,) for i in want]
    assert D.drop_containing(df, "domain", bl.limit(0)).count() == 600 and D.drop_containing(df.limit(0), "domain", bl).count() == 0


def test_a_hundred_thousand_substrings(spark):
    listed = spark.range(100_000).select(F.concat(F.lit("s"), F.col("id") * 7, F.lit(".biz")).alias("domain"))
    df = spark.range(3_000).select(F.concat(F.lit("www.shops"), "id", F.lit(".biz.example.com")).alias("domain"))
    out = D.drop_blocked(df, "domain", listed, "substring")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "s7.biz" not in plan
    assert {r[0] for r in out.collect()} == {f"www.shops{i}.biz.example.com" for i in range(3_000) if i % 7}


def test_substring_list_broadcasts_only_flags(spark):
    df = spark.createDataFrame([("aaaa.com",), ("b.com",), (None,)], "domain string")
    listed = spark.createDataFrame([("aa",), ("a.c",), ("AA",), ("x.co",)], "domain string")
    plan = D.drop_containing(df, "domain", listed)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("[flag#" in line and "LeftSemi" in line for line in joins) and plan.count("SortMergeJoin") >= 4
    lower = listed.select(F.lower("domain").alias("entry")).distinct()
    pairs = D.containing(df.where("domain is not null"), lower)  # "aa" starts at three places
    assert sorted(map(tuple, pairs.collect())) == [("aaaa.com", "a.c"), ("aaaa.com", "aa")]


# --- U2, D2, D3

def test_days_are_found_without_opening_files(spark, folder):
    day = lambda n: dt.date(2024, 1, n)
    data = [(str(day(n)), f"line {n}") for n in (1, 2, 5, 6, 9)]
    spark.createDataFrame(data, "day string, value string").write.partitionBy("day").text(f"{folder}/in")
    # a folder whose file cannot be read is no trouble as long as nobody reads it
    os.makedirs(f"{folder}/in/day=2024-01-07")
    with open(f"{folder}/in/day=2024-01-07/part-0.txt.gz", "wb") as f:
        f.write(b"no gzip")
    days = CAL.landed_days(spark, f"{folder}/in")
    assert rows(days) == [(day(n),) for n in (1, 2, 5, 6, 7, 9)]
    plan = days.where(F.col("day") > F.lit(day(3)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<>" in plan
    assert CAL.latest_landed(spark, f"{folder}/in", day(9)).first()[0] == day(7)
    assert CAL.latest_landed(spark, f"{folder}/in", day(20)).first()[0] is None
    assert rows(CAL.missing_days(CAL.last_days(spark, day(8), 7), days)) == [(day(3),), (day(4),)]
    read = CAL.within_days(spark.read.text(f"{folder}/in"), day(7), 5)
    assert rows(read.select("value")) == [("line 2",), ("line 5",), ("line 6",)]
    assert "PartitionFilters: [isnotnull(day" in read._jdf.queryExecution().executedPlan().toString()


# --- J6

def test_a_tier_is_read_for_unresolved_entities_only(spark, folder):
    tier = [[(i % 40, i, f"one{i}") for i in range(200) if i % 3], [(i % 40, i, f"two{i}") for i in range(200)], [(e, 0, "three") for e in range(0, 60, 2)]]
    for n, hits in enumerate(tier):
        C.land_tier(spark.createDataFrame(hits, "e int, rank int, domain string"), f"{folder}/{n}", "e", 64)
    scans = [lambda n=n: spark.read.parquet(f"{folder}/{n}") for n in range(3)]
    entities = spark.createDataFrame([(i % 60,) for i in range(120)] + [(None,)], "e int")
    read = {}
    for limit in (10, 60, 200):
        out, read[limit] = C.staged_first_valid(entities, scans, "e", ["rank"], F.col("rank") < limit, ["domain"], buckets=64)
        want = {}
        for e in range(60):
            best = next(((min((r, d) for x, r, d in hits if x == e and r < limit)[1], n + 1) for n, hits in enumerate(tier)
                         if any(x == e and r < limit for x, r, d in hits)), (None, None))
            want[e] = best
        assert {r["e"]: (r["domain"], r["tier"]) for r in out.collect()} == want
    assert read[10][0] == read[60][0] == read[200][0]           # the first tier is read whole
    assert 200 >= read[10][1] > read[60][1] > read[200][1]      # the second by what is left (20 entities have no hit in either)
    assert read[200][1] <= 50 and read[200][2] < 30


def test_no_tier_is_read_without_entities(spark):
    def never():
        raise AssertionError("read")
    out, read = C.staged_first_valid(spark.createDataFrame([], "e int"), [never, never], "e", ["rank"], F.lit(True), ["d"])
    assert out.count() == 0 and read == [0, 0]


# --- K5, A3

class Killed(Exception):
    pass


@pytest.mark.parametrize("where", ["work", "commit"])
def test_a_killed_run_is_repeated_without_loss_or_copies(spark, folder, where):
    todo = spark.createDataFrame([(i if i % 10 else None, i) for i in range(200)], "k int, v int")
    calls = []

    class Ledger(K.CommitLedger):
        def commit(self, run, batch):
            if where == "commit" and not calls.count("died") and batch == 2 and "staged" not in self.path:
                calls.append("died")
                raise Killed
            super().commit(run, batch)

    def work(df):
        calls.append("work")
        if where == "work" and calls.count("work") == 3:
            raise Killed
        return df.withColumn("w", F.col("v") * 2)

    ledger = Ledger(spark, folder)
    with pytest.raises(Killed):
        K.resumable(ledger, todo, "k", work, "r", 5)
    part = ledger.read("k int, v int, w int")
    assert part.select("batch").distinct().count() == 2  # what is not committed is not read
    for _ in range(2):
        K.resumable(ledger, todo, "k", work, "r", 5)
    assert rows(ledger.read("k int, v int, w int").select("v", "w")) == [(i, 2 * i) for i in range(200)]
    assert calls.count("work") == 6  # five batches, one of them twice


def test_ledger_of_a_stream_writes_a_batch_once(spark, folder):
    ledger = K.CommitLedger(spark, folder)
    sink = ledger.sink("stream")
    for batch, value in ((0, 1), (1, 2), (1, 2), (0, 9)):
        sink(spark.createDataFrame([(value,)], "v int"), batch)
    assert rows(ledger.read("v int")) == [(1, "stream", 0), (2, "stream", 1)]


def test_keys_are_kept_first_across_runs(spark, folder):
    schema = "k string, day int, v string, bucket int"
    days = [[("a", 1, "x", 0), ("a", 1, "y", 0), ("b", 1, "z", 0), (None, 1, "n", 0)], [("a", 2, "no", 0), ("c", 2, "y", 0), (None, 2, "m", 0)], [("b", 3, "no", 0), ("c", 3, "no", 0)]]
    ledger = DD.KeyLedger(folder, "k", "string", 8)
    kept = []
    for run, data in enumerate(days):
        df = spark.createDataFrame(data, schema)
        for _ in range(2):  # each run is repeated
            new = ledger.new(df, ["day", "v"], str(run))
            again = rows(new, "v")
            ledger.commit(new, str(run))
        kept += again
    assert sorted(kept) == [("m",), ("n",), ("x",), ("y",), ("z",)]
    assert ledger.new(spark.createDataFrame([], schema), ["day"], "9").count() == 0


def test_a_run_reads_only_the_folders_of_its_keys(spark, folder):
    ledger = DD.KeyLedger(folder, "k", "bigint", 16)
    ledger.commit(spark.range(1000).withColumnRenamed("id", "k"), "1")
    seen = ledger.seen(spark, [3, 5], "2")
    assert 0 < seen.count() < 250
    assert "PartitionFilters: [" in seen._jdf.queryExecution().executedPlan().toString()


# --- T1

def test_a_lookup_that_lands_later_is_attached_once(spark):
    start = dt.datetime(2024, 1, 1)
    hour = lambda n: start + dt.timedelta(hours=n)
    es, ls = "id bigint, name string, at timestamp, landed int", "id bigint, came timestamp, pos int, email string"
    entities = [[(1, "A", hour(0), 1), (2, "B", hour(0), 1), (3, "C", hour(1), 1), (None, "N", hour(1), 1)], [(4, "D", hour(30), 1), (4, "D", hour(30), 1)]]
    lookups = [[(1, hour(0), 2, "a2"), (4, hour(27), 5, "d5")], [(2, hour(3), 1, "b1"), (1, hour(4), 1, "a1"), (3, hour(9), 1, "late"), (None, hour(1), 0, "n")]]
    want = [(1, "A", "a1", 1), (2, "B", "b1", 1), (3, "C", None, None), (4, "D", "d5", 5), (None, "N", None, None)]
    for max_files, first in ((None, 0), (1, 1)):
        d = tempfile.mkdtemp(dir="/tmp")
        args = (spark, f"{d}/e", es, f"{d}/l", ls, "id", "at", "came", ["pos"], ["email", "pos"], f"{d}/o", f"{d}/c", "5 hours", "9 hours", max_files)
        spark.createDataFrame(entities[0], es).write.parquet(f"{d}/e/f=0")
        spark.createDataFrame(lookups[first], ls).write.parquet(f"{d}/l/f=0")
        ST.run_late_enrichment(*args)
        spark.createDataFrame(entities[1], es).write.parquet(f"{d}/e/f=1")
        spark.createDataFrame(lookups[1 - first], ls).write.parquet(f"{d}/l/f=1")
        ST.run_late_enrichment(*args)
        ST.run_late_enrichment(*args, close=True)
        got = spark.read.parquet(f"{d}/o").select("id", "name", "email", "pos")
        assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0] or 99) == want


# --- S7

def test_rows_that_do_not_fit_the_sample_are_rescued(spark, folder):
    def write(name, *lines):
        spark.createDataFrame([(x,) for x in ("a,b", *lines)], "v string").coalesce(1).write.text(f"{folder}/{name}")
    write("csv", *[f"{i},x{i}" for i in range(20)], "oops,y", "5", "6,z,extra", ",blank", "7,")
    got = {tuple(r) for r in S.read_csv_rescued(spark, f"{folder}/csv", ["b"], lines=10).collect()}
    assert got == {(i, f"x{i}", None) for i in range(20)} | {(None, "y", "oops,y"), (5, None, "5"), (6, "z", "6,z,extra"), (None, "blank", None)}
    assert [f.dataType.simpleString() for f in S.sampled_schema(spark, f"{folder}/csv", 10)] == ["int", "string"]


# --- E4, F13

def counted_source(spark, df):
    """``df`` and an accumulator of the rows that were read from it."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), read


def test_filter_is_counted_in_one_pass(spark, folder):
    df, read = counted_source(spark, spark.range(1000).withColumn("x", F.when(F.col("id") % 10 > 0, F.col("id"))))
    kept, counts = P.filter_counted(df, F.col("x") % 3 == 0, counters=M.StageCounters("f"))
    kept.write.parquet(f"{folder}/kept")
    assert tuple(counts.first()) == (300, 600) and kept.count() == 300 and kept.columns == ["id", "x"]
    assert read.value == 1000


def test_flows_count_while_they_write(spark, folder):
    pages = [("MI", 0, i, str(i % 80), "Co" if i % 7 else " ", str(i % 60), "m@x" if i % 2 else "") for i in range(400)]
    schema = "state string, page int, pos int, dot_number string, legal_name string, nbr_power_unit string, email_address string"
    df, read = counted_source(spark, spark.createDataFrame(pages, schema))
    counters = M.StageCounters("p1")
    out = FL.carrier_leads(df, counters=counters)
    K.ordered_csv(out, f"{folder}/leads", FL.CARRIER_OUTPUT, ["state", "power_units", "company"])
    got = counters.counts()
    named = [p for p in pages if p[4].strip()]
    fits = [p for p in named if 5 <= int(p[5]) <= 50]
    assert got["registry"] == {"n_rows": 400, "n_named": len(named), "n_in_range": len(fits)} and read.value == 400
    assert got["records"]["n_rows"] == len({p[3] for p in fits}) == spark.read.csv(f"{folder}/leads", header=True).count()
    assert sum(got["records"][c] for c in ("n_email", "n_to_enrich")) == got["records"]["n_rows"]
    assert counters.frame(spark).count() == 6


def test_second_outputs_come_from_the_same_pass(spark):
    brands = spark.createDataFrame([(i, f"B{i}") for i in range(30)], "ordinal int, brand_name string")
    hits, read = counted_source(spark, spark.createDataFrame([(i, r, f"d{i}.com" if i % 3 else "bad.com") for i in range(20) for r in range(2)], "ordinal int, rank int, domain string"))
    contacts = spark.createDataFrame([("d1.com", 0, "A", "B", "CEO", "a@d1.com")], "domain string, pos int, first_name string, last_name string, position string, value string")
    cfg = FL.BridgeConfig(blocklist=("bad",))
    want, want_counts = (df.collect() for df in FL.brand_bridge(brands, hits, contacts, cfg))
    twice, before = read.value, read.value
    counters = M.StageCounters("p8")
    out, counts = FL.brand_bridge(brands, hits, contacts, cfg, counters=counters)
    assert out.collect() == want and sorted(counts.collect()) == sorted(want_counts)
    assert read.value - before == 40 < twice
    assert counters.counts()["first_hits"] == {"n_rows": 30, "n_found": 13, "n_blocked": 7, "n_not_found": 10}
