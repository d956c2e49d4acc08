"""Streaming forms: restart picks up only new files; the
stateful quota equals a straight replay of the reference's throttle."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from leadsmith.streaming import enrich as ST
from tests.conftest import rows


def test_incremental_enrichment_resumes(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    schema = "company_id long, company string"
    look = spark.createDataFrame([(1, "a@x"), (3, "c@x")], "company_id long, email string")
    spark.createDataFrame([(1, "A"), (2, "B")], schema).write.parquet(f"{d}/in/batch=1")
    ST.incremental_enrichment(spark, f"{d}/in", schema, look, "company_id", f"{d}/out", f"{d}/ckpt")
    assert spark.read.parquet(f"{d}/out").count() == 2
    spark.createDataFrame([(3, "C")], schema).write.parquet(f"{d}/in/batch=2")
    ST.incremental_enrichment(spark, f"{d}/in", schema, look, "company_id", f"{d}/out", f"{d}/ckpt")
    got = rows(spark.read.parquet(f"{d}/out"), "company_id", "company", "email")
    assert got == [(1, "A", "a@x"), (2, "B", None), (3, "C", "c@x")]  # no row processed twice


def test_incremental_enrichment_in_batches_with_split_keys(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    schema = "company_id long, company string"
    side = spark.range(4).select(F.col("id").alias("company_id"), F.concat(F.lit("m"), "id").alias("email"))
    for k in range(3):
        spark.range(60).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7).alias("company_id"),
                               F.concat(F.lit(f"{k}-"), "id").alias("company")).coalesce(1).write.parquet(f"{d}/in/batch={k}")
    ST.incremental_enrichment(spark, f"{d}/in", schema, side, "company_id", f"{d}/out", f"{d}/ckpt", max_files=1, force_salt=True)
    want = spark.read.schema(schema).parquet(f"{d}/in").select("company_id", "company").join(side, "company_id", "left")
    assert rows(spark.read.parquet(f"{d}/out"), "company_id", "company", "email") == rows(want, "company_id", "company", "email")


def replay(times, cap, width):
    """The reference throttle, call by call (times in seconds)."""
    start, n, last, out = None, 0, None, []
    for t in times:
        now = t if last is None else max(t, last)
        if start is None or now - start >= width:
            start, n = now, 0
        if n >= cap:
            now = start + width
            start, n = now, 0
        n += 1
        last = now
        out.append(now)
    return out


def test_event_quota_matches_replay(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    secs = [0, 1, 2, 3, 10, 11, 70, 71, 72, 73, 200]
    ev = spark.createDataFrame([(i, base + dt.timedelta(seconds=s), 7) for i, s in enumerate(secs)] +
                               [(100, base, 8)], "event_id long, ts timestamp, user_id long")
    ev.write.parquet(f"{d}/in")
    ST.run_quota_stream(spark, f"{d}/in", ev.schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=3, window_sec=60.0, close=True)
    out = spark.read.parquet(f"{d}/out").where(F.col("caller") == 7).orderBy("event_id").collect()
    want = replay(secs, 3, 60)
    assert [(r["admitted_at"] - base).total_seconds() for r in out] == want
    assert sum(r["deferred"] for r in out) == 3  # calls at 3 s, 70 s and 73 s wait


def test_incremental_enrichment_dedupes_across_batches(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    schema = "company_id long, company string, landed_at timestamp"
    look = spark.createDataFrame([(1, "a@x")], "company_id long, email string")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    spark.createDataFrame([(1, "A", t0), (2, "B", t0)], schema).write.parquet(f"{d}/in/f=1")
    ST.incremental_enrichment(spark, f"{d}/in", schema, look, "company_id", f"{d}/out", f"{d}/ckpt",
                              event_time="landed_at", dedupe_within="1 hour")
    spark.createDataFrame([(1, "A again", t0 + dt.timedelta(minutes=5))], schema).write.parquet(f"{d}/in/f=2")
    ST.incremental_enrichment(spark, f"{d}/in", schema, look, "company_id", f"{d}/out", f"{d}/ckpt",
                              event_time="landed_at", dedupe_within="1 hour")
    got = rows(spark.read.parquet(f"{d}/out"), "company_id", "company", "email")
    assert got == [(1, "A", "a@x"), (2, "B", None)]


def test_event_quota_does_not_depend_on_batches(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    secs = [0, 90, 30, 31, 60, 2, 400, 391, 5, 500]  # files land out of order of time
    ev = [(i, base + dt.timedelta(seconds=s), 7 if i % 4 else 8) for i, s in enumerate(secs)] + [(50, None, 7)]
    schema = "event_id long, ts timestamp_ntz, user_id long"
    for i, e in enumerate(ev):
        spark.createDataFrame([e], schema).coalesce(1).write.parquet(f"{d}/in/f={i}")
    got = {}
    for n in (1, 3, 1000):
        ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out{n}", f"{d}/ckpt{n}", cap=2, window_sec=60.0, max_files=n, close=True)
        got[n] = rows(spark.read.parquet(f"{d}/out{n}"), "caller", "event_id", "admitted_at", "window_start", "deferred")
    assert got[1] == got[3] == got[1000]
    for caller in (7, 8):
        times = sorted((s, i) for i, s in enumerate(secs) if (7 if i % 4 else 8) == caller)
        want = dict(zip((i for _, i in times), replay([s for s, _ in times], 2, 60)))
        assert {r[1]: (r[2] - base).total_seconds() for r in got[1] if r[0] == caller} == want


def test_event_quota_waits_for_the_watermark(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    schema = "event_id long, ts timestamp_ntz, user_id long"

    def land(name, *events):
        spark.createDataFrame([(i, base + dt.timedelta(seconds=s), 7) for i, s in events], schema).write.parquet(f"{d}/in/f={name}")
        ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=2, window_sec=60.0, delay="100 seconds")
        return sorted(r["event_id"] for r in spark.read.schema("event_id long").parquet(f"{d}/out").collect())

    assert land("a", (0, 0), (1, 150)) == [0]         # the watermark stands at 50 s
    assert land("b", (2, 60), (3, 400)) == [0, 1, 2]  # event 2 takes its place before event 1


def test_late_events_are_dead_letters_or_take_their_place(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    schema = "event_id long, ts timestamp_ntz, user_id long"

    def land(name, close, *events):
        spark.createDataFrame([(i, base + dt.timedelta(seconds=s), c) for i, s, c in events], schema).write.parquet(f"{d}/in/f={name}")
        ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=2, window_sec=60.0, delay="100 seconds", close=close)
        out = spark.read.parquet(f"{d}/out").collect()
        return {r["event_id"]: r["admitted_at"] and (r["admitted_at"] - base).total_seconds() for r in out}, {r["event_id"] for r in out if r["outcome"] == "late"}

    assert land("a", False, (0, 100, 7), (1, 1000, 7)) == ({0: 100}, set())
    # caller 7 was admitted at 100 s, so 50 s is late; 200 s and the first call of caller 8 are behind the watermark only
    assert land("b", False, (2, 50, 7), (3, 200, 7), (4, 5, 8)) == ({0: 100, 2: None, 3: 200, 4: 5}, {2})
    assert land("c", True, (5, 1001, 7)) == ({0: 100, 2: None, 3: 200, 4: 5, 1: 1000, 5: 1001}, {2})
    # after the end: the next call in order is admitted, an earlier one is kept as late
    got, late = land("d", True, (6, 2000, 7), (7, 60, 7))
    assert (got[6], got[7], late) == (2000, None, {2, 7})


def test_event_quota_of_callers_that_share_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(ST, "QUOTA_BUCKETS", 2)
    d = tempfile.mkdtemp(dir="/tmp")
    base, schema = dt.datetime(2024, 1, 1), "event_id long, ts timestamp_ntz, user_id long"
    secs = {c: [(7 * c + 11 * i * i) % 400 for i in range(12)] for c in range(6)}
    events = [(2**60 + 100 * c + i, base + dt.timedelta(seconds=s), c or None) for c in secs for i, s in enumerate(secs[c])]
    events.append((None, base + dt.timedelta(seconds=1000), 3))
    spark.createDataFrame(events[::2], schema).coalesce(1).write.parquet(f"{d}/in/batch=1")
    spark.createDataFrame(events[1::2], schema).coalesce(1).write.parquet(f"{d}/in/batch=2")
    ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=3, window_sec=60.0, max_files=1)
    ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=3, window_sec=60.0, max_files=1, close=True)
    out = spark.read.parquet(f"{d}/out").where("outcome = 'admitted'").orderBy("ts", "event_id").collect()
    assert len(out) == len(events)
    for c in secs:
        mine = [r for r in out if r["caller"] == (c or None)]
        want = sorted((e for e in events if e[2] == (c or None)), key=lambda e: (e[1], e[0] or 0))
        assert [r["event_id"] for r in mine] == [e[0] for e in want]
        assert [(r["admitted_at"] - base).total_seconds() for r in mine] == replay([(e[1] - base).total_seconds() for e in want], 3, 60)
    # a call before an admitted one is late, whoever shares the bucket
    spark.createDataFrame([(1, base - dt.timedelta(seconds=5), 3), (2, base, 99)], schema).write.parquet(f"{d}/in/batch=3")
    ST.run_quota_stream(spark, f"{d}/in", schema, "user_id", f"{d}/out", f"{d}/ckpt", cap=3, window_sec=60.0, max_files=1)
    late = spark.read.parquet(f"{d}/out").where("outcome = 'late'")
    assert rows(late, "event_id", "admitted_at", "deferred") == [(1, None, None)]
    assert spark.read.parquet(f"{d}/out").where("caller = 99 and outcome = 'admitted'").count() == 1
