"""Candidate selection, ranking and lookups on micro-fixtures
(SURVEY J1-J9, W1-W6, A7, A8; traps C1, C9, C13, C19, C20)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.operators import candidates as C
from leadsmith.operators import dedupe as DD
from leadsmith.operators import lookup as L
from leadsmith.operators import metrics as M
from leadsmith.operators import ranking as RK
from tests.conftest import rows

HITS = [  # entity, tier, rank, href
    ("acme", 1, 0, "https://www.yelp.example.com/acme"),
    ("acme", 1, 1, "https://acme.example.com/"),
    ("bolt", 1, 0, "https://directory.example.org/b"),
    ("bolt", 2, 0, "https://bolt.example.net/"),
    ("none", 1, 0, "https://yelp.example.com/x"),
]


def hits(spark):
    df = spark.createDataFrame(HITS, "entity string, tier int, rank int, href string")
    return df.withColumn("domain", D.domain_netloc("href"))


def test_first_valid_skips_blocked_and_walks_tiers(spark):
    h = hits(spark)
    ok = ~D.blocked_substring("domain", ["yelp", "directory"])
    got = C.first_valid(h, "entity", ["tier", "rank"], ok, ["domain", "tier"])
    assert rows(got, "entity", "domain", "tier", "n_valid") == [
        ("acme", "acme.example.com", 1, 1), ("bolt", "bolt.example.net", 2, 1), ("none", None, None, 0)]


def test_first_hit_does_not_look_past_a_blocked_first_hit(spark):
    # acme's first hit is blocked; the second (valid) one is not used
    got = C.first_hit(hits(spark), "entity", ["tier", "rank"], "domain",
                      D.blocked_substring("domain", ["yelp", "directory"]))
    assert rows(got) == [("acme", None, "blocked"), ("bolt", None, "blocked"), ("none", None, "blocked")]
    counts = C.outcome_counts(got)
    assert rows(counts) == [("blocked", 3)]


def test_rejections_counted_only_up_to_first_valid(spark):
    h = hits(spark).withColumn("ord", F.col("tier") * 10 + F.col("rank"))
    reason = C.rejection_reason([("listing", D.blocked_substring("domain", ["yelp"])),
                                 ("directory", D.blocked_substring("domain", ["directory"]))])
    # Acme stops after rank 1, bolt after tier 2, none has no valid hit
    assert rows(C.rejection_counts(h, "entity", ["ord"], reason)) == [("directory", 1), ("listing", 2), ("ok", 2)]


def test_priority_pick_substring_and_ties(spark):
    people = spark.createDataFrame([
        ("d1", 0, "Co-Owner", "a@d1"), ("d1", 1, "Owner", "b@d1"), ("d1", 2, "Vice President", "c@d1"),
        ("d2", 0, None, "x@d2"), ("d2", 1, "Clerk", "y@d2"),
    ], "domain string, pos int, title string, email string")
    got = RK.priority_pick(people, "domain", "title", ["owner", "president"], "pos", ["email"])
    # C1: "Co-Owner" contains "owner" and comes first; d2 ties at 99 -> input order
    assert rows(got, "domain", "email", "title_rank") == [("d1", "a@d1", 0), ("d2", "x@d2", 99)]


def test_confidence_tiebreak_null_counts_as_zero(spark):
    people = spark.createDataFrame([
        ("d", 0, "owner", None, "a"), ("d", 1, "owner", 80, "b"), ("d", 2, "founder", 99, "c"),
    ], "domain string, pos int, title string, conf int, email string")
    got = RK.priority_pick(people, "domain", "title", ["owner", "founder"], "pos", ["email"], default_rank=2,
                           confidence="conf")
    assert rows(got, "email") == [("b",)]  # C20: NULL confidence is 0, no failure


def test_match_else_first_and_cascade(spark):
    t = spark.createDataFrame([
        ("x", 0, "Sales"), ("x", 1, "Head of Operations"), ("y", 0, None), ("y", 1, "CEO"), ("z", 0, None),
    ], "d string, pos int, title string")
    m = RK.match_else_first(t, "d", "pos", F.lower("title").contains("operations"), ["pos"])
    assert rows(m) == [("x", 1, "matched"), ("y", 0, "fallback"), ("z", 0, "fallback")]
    lv = [("ops", F.lower("title").contains("operations")), ("exec", F.lower("title").contains("ceo")),
          ("generic", F.col("title").isNotNull())]
    c = RK.cascade(t, "d", "pos", lv, ["pos"], "no_title")
    assert rows(c) == [("x", 1, "ops"), ("y", 1, "exec"), ("z", 0, "no_title")]


def test_recent_n_keeps_newest(spark):
    ev = spark.range(40).select((F.col("id") % 2).alias("u"), F.col("id").alias("ts"))
    got = RK.recent_n(ev, "u", [F.col("ts").desc()], 3)
    assert rows(got) == [(0, 34), (0, 36), (0, 38), (1, 35), (1, 37), (1, 39)]


def test_merge_back_keeps_rows_and_duplicates(spark):
    base = spark.createDataFrame([(1, "A", 1.0), (2, "A", 2.0), (3, "B", 3.0)], "id int, name string, v double")
    upd = spark.createDataFrame([(2, 20.0)], "id int, v double")
    got = L.merge_back(base, upd, "id", ["v"])
    # Keyed on a unique id, so the second 'A' does not overwrite the first
    assert rows(got) == [(1, "A", 1.0), (2, "A", 20.0), (3, "B", 3.0)]


def test_fallback_fill_labels(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    prim = spark.createDataFrame([(1, "p@x", "Owner"), (2, "", "GM")], "k int, email string, title string")
    sec = spark.createDataFrame([(2, "s@x", "CEO"), (3, None, None)], "k int, email string, title string")
    got = L.fallback_fill(base, prim, sec, "k", ["email", "title"], ("people:found", "contacts:found", "not_found"))
    assert rows(got) == [(1, "p@x", "Owner", "people:found"), (2, "s@x", "GM", "contacts:found"), (3, None, None, "not_found")]


def test_keep_first_is_partition_independent(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 2000).alias("o"),
                                  F.col("id").alias("v"))
    a = DD.keep_first(df.repartition(1), "k", ["o", "v"])
    b = DD.keep_first(df.repartition(16), "k", ["o", "v"])
    assert rows(a) == rows(b)
    assert rows(DD.keep_first(a, "k", ["o", "v"])) == rows(a)  # idempotent


def test_salted_join_refuses_sides_it_would_multiply(spark):
    one = spark.range(3).withColumnRenamed("id", "k")
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            L.salted_join(one, one, "k", how, force=True)


def test_drop_blocked_exact_and_suffix(spark):
    df = spark.createDataFrame([(1, "shop.acme.example.com"), (2, "acme.example.com"), (3, "other.example.org"),
                                (4, "notacme.example.com")], "id int, host string")
    bl = spark.createDataFrame([("acme.example.com",)], "domain string")
    assert rows(D.drop_blocked(df, "host", bl, "suffix"), "id") == [(3,), (4,)]
    assert rows(D.drop_blocked(df, "host", bl, "exact"), "id") == [(1,), (3,), (4,)]
    plan = D.drop_blocked(df, "host", bl, "suffix")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_salted_join_equals_plain_join_with_hot_key(spark):
    # one domain holds a third of all companies
    ent = spark.range(3000).select(F.col("id").alias("company_id"),
                                   F.when(F.col("id") % 3 == 0, F.lit("hot.example.com"))
                                   .otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string"),
                                                       F.lit(".example.com"))).alias("domain"))
    contacts = spark.range(200).select(
        F.when(F.col("id") < 10, F.lit("hot.example.com"))
        .otherwise(F.concat(F.lit("d"), (F.col("id") % 40).cast("string"), F.lit(".example.com"))).alias("domain"),
        F.col("id").alias("pos"), F.when(F.col("id") % 4 == 0, F.lit("Owner")).otherwise(F.lit("Clerk")).alias("title"),
        F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("@x")).alias("email"))
    plain = L.contact_lookup(ent, contacts, "domain", "title", ["owner"], "pos", ["email"], salt_buckets=None)
    salted = L.contact_lookup(ent, contacts, "domain", "title", ["owner"], "pos", ["email"], salt_buckets=8,
                              force_salt=True)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    cols = ["company_id", "domain", "email", "title_rank", "source"]
    assert rows(salted, *cols) == rows(plain, *cols)
    assert salted.count() == 3000


def test_hot_keys_of_fills_updates_and_samples_are_split(spark):
    base = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    side = spark.range(30).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("m"), "id")).alias("email"),
                                  F.lit("owner").alias("title"), (F.col("id") * 10).alias("n"))
    two = side.withColumn("email", F.concat(F.lit("s"), "k"))
    upd = side.select("k", F.col("n").alias("v"))
    for run in (lambda f: L.fallback_fill(base, side, two, "k", ["email", "title"], ("a", "b", "none"), force_salt=f),
                lambda f: L.merge_back(base, upd, "k", ["v"], force_salt=f),
                lambda f: M.empty_sample(base, "k", side.select("k", "n"), ["n"], force_salt=f)):
        plain, split = run(False), run(True)
        assert "_salt" in split._jdf.queryExecution().optimizedPlan().toString()
        assert split.columns == plain.columns and rows(split) == rows(plain) and split.count() == 900


def test_byte_sizes_of_settings_and_plans():
    assert [L._bytes(x) for x in ("10485760b", "10MB", "1.5 KiB", "16.0 B", "8.0 EiB", "-1", None, "none")] == [
        10485760, 10 << 20, 1536, 16, 8 << 60, -1, -1, -1]


def test_salted_join_is_plain_when_broadcast_sized(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k").groupBy("k").count()
    assert L.broadcast_sized(small)
    assert "_salt" not in L.salted_join(big, small, "k")._jdf.queryExecution().optimizedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not L.broadcast_sized(small)
        assert "_salt" in L.salted_join(big, small, "k")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
