"""Structured Streaming forms of the reference's resumable loops.

T1 replaces "checkpoint after each row and resume" (the reference rewrote a
whole CSV per row): a file-source stream joined to the landed lookup table,
written by the exactly-once file sink. A restart reads only files that the
checkpoint has not seen.

T2 replaces the in-process request throttle: per caller, a window of
``window_sec`` seconds anchored at the first call admits ``cap`` calls; the
next call waits for the window end, which anchors the next window. The
recurrence is sequential per caller, so it is kept in Spark state
(``applyInPandasWithState``), callers being dealt to a fixed number of buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
from leadsmith.session import checkpoint_dir


def incremental_enrichment(spark: SparkSession, source: str, schema, lookup: DataFrame, key: str,
                           out: str, checkpoint: str, fmt: str = "parquet",
                           max_files: int | None = None, glob: str | None = None,
                           event_time: str | None = None, dedupe_within: str = "1 day",
                           force_salt: bool = False):
    """Enrich new input files as they land; returns the finished query
    (``availableNow``: process what is there, then stop).

    With ``event_time``, a key that lands again (in a later file or batch)
    within ``dedupe_within`` of its first arrival is enriched only once:
    ``dropDuplicatesWithinWatermark`` keeps bounded state per key. Hot keys
    of a batch are split as in ``salted_join``; with ``max_files`` the lookup
    is written once to the shared folder instead of being worked out per batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.format(fmt).load(source)
    if event_time is not None:
        stream = stream.withWatermark(event_time, dedupe_within).dropDuplicatesWithinWatermark([key])
    if max_files:  # several batches: the lookup is worked out once and read by each
        folder = f"{checkpoint_dir(spark).rstrip('/')}/lookup-{uuid.uuid4().hex}"
        lookup.write.parquet(folder)
        lookup = spark.read.parquet(folder)
    enriched = salted_join(stream, lookup, key, "left", DEFAULT_SALT, force=force_salt)
    q = (enriched.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def late_enrichment(entities: DataFrame, lookups: DataFrame, key: str, at: str, landed: str, order: list[str], keep: list[str],
                    wait: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """T1 where a lookup may land after its entity: every row of ``entities``
    once, with the best of the lookups that land up to ``wait`` after it.

    ``entities`` (key, ``at``, ...) and ``lookups`` (key, ``landed``, order and
    kept columns) are streams. A left outer join by key and time range keeps
    both sides in state only as long as they can still match; the best
    lookup (smallest ``order``, unique per key) is one aggregate by the
    entity's row, final when the watermark (``delay`` behind the latest rows
    of both sides) has passed. So the result does not depend on files,
    batches or on which side came first; an entity that is without a lookup
    till then has NULLs. Rows later than ``delay`` are late and are not read.
    Equal rows of ``entities`` count as one. Also works on static DataFrames.
    """
    left = entities.withWatermark(at, delay)
    right = lookups.select(F.col(key).alias("_k"), F.col(landed).alias("_landed"), F.struct(*order).alias("_order"),
                           F.struct(*keep).alias("_kept")).withWatermark("_landed", delay)
    within = (F.col(key) == F.col("_k")) & (F.col("_landed") <= F.col(at) + F.expr(f"INTERVAL {wait}")) & (F.col("_landed") >= F.col(at) - F.expr(f"INTERVAL {wait}"))
    joined = left.join(right, within, "left_outer")
    best = joined.groupBy(*[F.col(c) for c in entities.columns]).agg(F.min_by("_kept", "_order").alias("_best"))
    return best.select(*entities.columns, *[F.col("_best")[c].alias(c) for c in keep])


def run_late_enrichment(spark: SparkSession, entities: str, entity_schema: str, lookups: str, lookup_schema: str, key: str, at: str,
                        landed: str, order: list[str], keep: list[str], out: str, checkpoint: str, wait: str = "1 day",
                        delay: str = "1 hour", max_files: int | None = None, close: bool = False):
    """``late_enrichment`` of two folders into parquet, as far as the watermark
    has come; the rest waits for the next run. ``close`` ends the streams by a
    row each beside the checkpoint: all that waits is written. NULL keys and
    rows without a time match nothing; the latter are not read."""
    def stream(path, schema, end):
        reader = spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(end)
        return reader.parquet(path).select(*empty.columns).unionByName(spark.readStream.schema(schema).parquet(end))

    ends = [f"{checkpoint.rstrip('/')}-end-{side}" for side in ("entities", "lookups")]

    def run():
        result = late_enrichment(stream(entities, entity_schema, ends[0]), stream(lookups, lookup_schema, ends[1]), key, at, landed, order, keep, wait, delay)
        # the closing rows have a key and a time, as filters on these go below the watermark
        q = (result.where(F.col(at) < F.lit(CLOSING).cast("timestamp")).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    q = run()
    if close:
        for end, schema, time in ((ends[0], entity_schema, at), (ends[1], lookup_schema, landed)):
            empty = spark.createDataFrame([], schema)
            cols = [F.lit(CLOSING if c == time else "0" if c == key else None).cast(t).alias(c) for c, t in empty.dtypes]
            spark.range(1).select(*cols).write.mode("append").parquet(end)
        q = run()
    return q


# Times stay on the event clock as given (no time-zone conversion): the
# recurrence only compares and adds durations.
QUOTA_OUT = ("caller long, event_id long, ts timestamp_ntz, admitted_at timestamp_ntz, "
             "window_start timestamp_ntz, deferred boolean, late boolean")
# Callers share a group: a group costs Spark some milliseconds a batch, far more
# than a caller's events. A caller that has been admitted is one entry of the first
# six arrays, a waiting event one of the other three.
QUOTA_BUCKETS = 4096
QUOTA_STATE = ("callers array<long>, window_start array<long>, n array<long>, last array<long>, done_ts array<long>, "
               "done_id array<long>, pending_caller array<long>, pending_ts array<long>, pending_id array<long>")
_NULL = (1 << 63) - 1  # a NULL caller or id in state, where pandas would make all ids of a group floats; sorts last

# The time of the row that closes a stream; events carry earlier ones.
CLOSING = "9999-12-31 00:00:00"


_NO_TIME = np.iinfo(np.int64).min  # NaT


def _quota(cap: int, window_sec: float, buffered: bool):
    width = int(round(window_sec * 1_000_000))  # all times in microseconds

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState):
        *settled, who, ts, ids = state.get if state.exists else [[]] * 9
        known = {c: rest for c, *rest in zip(*settled)}
        frames = list(batches)  # a timed-out bucket has none
        who, ts, ids = (np.concatenate([np.array(kept, dtype=np.int64), *(f[c].to_numpy(dtype=np.int64) for f in frames)])
                        for c, kept in (("caller", who), ("ts", ts), ("event_id", ids)))
        order = np.lexsort((ids, ts, who))
        who, ts, ids = who[order], ts[order], ids[order]
        # no event up to the watermark can come any more; later ones wait
        ready = ts <= state.getCurrentWatermarkMs() * 1000 if buffered else np.ones(len(ts), dtype=bool)
        admitted, starts, deferred = [], [], []
        caller = None
        for c, t, i in zip(who[ready].tolist(), ts[ready].tolist(), ids[ready].tolist()):
            if c != caller:
                caller = c
                start, n, last, done_ts, done_id = known.get(c, (None, 0, None, None, None))
            if buffered and done_ts is not None and (t, i) < (done_ts, done_id):
                # calls before one that has been admitted can no longer take their place
                admitted.append(_NO_TIME)
                starts.append(_NO_TIME)
                deferred.append(None)
                continue
            now = t if last is None else max(t, last)   # calls are sequential
            if start is None or now - start >= width:
                start, n = now, 0                       # window expired: restart here
            full = n >= cap
            if full:                                    # wait for the window end
                now = start + width
                start, n = now, 0
            n += 1
            last, done_ts, done_id = now, t, i
            known[c] = (start, n, last, done_ts, done_id)
            admitted.append(now)
            starts.append(start)
            deferred.append(full)
        wait = [x[~ready].tolist() for x in (who, ts, ids)]
        state.update((list(known), *([v[j] for v in known.values()] for j in range(5)), *wait))
        if wait[1]:
            state.setTimeoutTimestamp(-(-min(wait[1]) // 1000))
        if deferred:
            def times(micros):
                return np.array(micros, dtype=np.int64).view("datetime64[us]")

            yield pd.DataFrame({"caller": who[ready], "event_id": ids[ready], "ts": times(ts[ready]), "admitted_at": times(admitted),
                                "window_start": times(starts), "deferred": deferred, "late": [d is None for d in deferred]})
    return fn


def event_quota(events: DataFrame, caller: str, cap: int = 50, window_sec: float = 60.0,
                delay: str | None = None) -> DataFrame:
    """Admission time per event under a fixed window anchored at the
    first call. Events of a caller are admitted in order of (time, id).

    Without ``delay`` (also for a static DataFrame) that is the order within
    a micro-batch. With it, a stream's events wait in state until the
    watermark, ``delay`` behind the latest event, has passed them: the result
    then does not depend on how events came in batches, as long as none is
    later than ``delay``. An event that comes when a later call of its caller
    has been admitted is a row too, ``late`` and without an admission; one
    that can still take its place is admitted, however late. Events without a
    time are no calls."""
    ev = events.select(F.col(caller).cast("long").alias("caller"), F.col("event_id").cast("long"),
                       F.col("ts").cast("timestamp_ntz").alias("ts"))
    timeout = GroupStateTimeout.NoTimeout
    if delay is not None:
        # A watermark needs an instant: the event clock read as UTC, whatever the
        # session's time zone. Each event is two rows: one with its time moves the
        # watermark and goes no further, one without passes it however late it is.
        # The closing row is only the former. The last test, of the event time,
        # stays above the watermark.
        at = F.expr("TIMESTAMP '1970-01-01 00:00:00Z' + (ts - TIMESTAMP_NTZ '1970-01-01 00:00:00')")
        call = F.col("ts") < F.lit(CLOSING).cast("timestamp_ntz")
        ev = (ev.where("ts IS NOT NULL")
              .select("*", F.explode(F.when(call, F.array(at, F.lit(None).cast("timestamp"))).otherwise(F.array(at))).alias("at"))
              .withWatermark("at", delay).where("at IS NULL"))
        timeout = GroupStateTimeout.EventTimeTimeout
    else:
        ev = ev.where(F.col("ts") < F.lit(CLOSING).cast("timestamp_ntz"))
    null = F.lit(_NULL).cast("bigint")
    ev = (ev.withColumn("bucket", F.pmod(F.xxhash64("caller"), F.lit(QUOTA_BUCKETS)))
          .withColumn("ts", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"))
          .withColumn("caller", F.coalesce("caller", null)).withColumn("event_id", F.coalesce("event_id", null)))
    out = ev.groupBy("bucket").applyInPandasWithState(
        _quota(cap, window_sec, delay is not None), QUOTA_OUT, QUOTA_STATE, "append", timeout)
    return out.withColumn("caller", F.nullif("caller", null)).withColumn("event_id", F.nullif("event_id", null))


def run_quota_stream(spark: SparkSession, source: str, schema, caller: str, out: str, checkpoint: str,
                     cap: int = 50, window_sec: float = 60.0, glob: str | None = None,
                     max_files: int | None = None, delay: str = "1 hour", close: bool = False):
    """T2 end to end: file stream -> per-caller quota state -> parquet, in the
    folders ``outcome=admitted`` and ``outcome=late`` (dead letters).

    Events are admitted in order of time whatever files or batches
    (``max_files``) they came in, if none is later than ``delay``. State
    carries over between batches and runs; the last ``delay`` of events waits
    for the next run. ``close`` ends the stream: it admits all that wait, and
    events that land afterwards are admitted at once, or late. Admitted and
    late rows together are all events with a time."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # the closing row lands beside the checkpoint, in a folder that is empty until then
    end, end_schema = f"{checkpoint.rstrip('/')}-end", f"{caller} long, event_id long, ts timestamp_ntz"
    spark.createDataFrame([], end_schema).write.mode("ignore").parquet(end)

    def run():
        events = reader.parquet(source).select(F.col(caller).cast("long").alias(caller), F.col("event_id").cast("long"),
                                               F.col("ts").cast("timestamp_ntz").alias("ts"))
        both = events.unionByName(spark.readStream.schema(end_schema).parquet(end))
        admitted = event_quota(both, caller, cap, window_sec, delay)
        admitted = admitted.withColumn("outcome", F.when(F.col("late"), "late").otherwise("admitted")).drop("late")
        q = (admitted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .partitionBy("outcome").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    q = run()
    if close:
        closing = spark.range(1).select(F.lit(None).cast("long").alias(caller), F.lit(None).cast("long").alias("event_id"),
                                        F.lit(CLOSING).cast("timestamp_ntz").alias("ts"))
        closing.write.mode("append").parquet(end)
        q = run()
    return q
