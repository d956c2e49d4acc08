"""Measure how much of a hot key lands in one task (event log, no UI).

Usage: python tools/skew_check.py [rows]
One key holds a third of the rows. For each operator, the largest number
of shuffle records read by a single task is taken from Spark's event log
(written to a fresh scratch folder) and printed as a share of all rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from leadsmith.operators import budget as B  # noqa: E402
from leadsmith.operators import dedupe as DD  # noqa: E402
from leadsmith.operators import lookup as L  # noqa: E402
from leadsmith.operators import metrics as M  # noqa: E402
from leadsmith.operators import ranking as RK  # noqa: E402
from leadsmith.session import DEFAULTS, checkpoint_dir  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    logs = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    b = SparkSession.builder.master("local[8]").appName("skew-check")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = (b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        ((F.col("id") * 7919) % n).alias("o"), F.lit(1).cast("bigint").alias("v"))

    per_key = df.groupBy("k").agg(F.count(F.lit(1)).alias("n_k"))  # one row per key

    people = per_key.select("k", F.col("n_k").cast("string").alias("email"), F.lit("owner").alias("title"))

    def no_broadcast(build, skew_threshold: str = "256MB"):
        def run():
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            # AQE only splits partitions above this size; 256 MB is the default
            spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", skew_threshold)
            return build()
        return run

    runs = {
        "keep_first (partial+final min_by)": lambda: DD.keep_first(df, "k", ["o"]),
        "recent_n top-15 per key (partial WindowGroupLimit)": lambda: RK.recent_n(df, "k", [F.col("o").desc()], 15),
        "lookup join, sort-merge, AQE skew threshold 256MB (default)": no_broadcast(
            lambda: df.join(per_key, "k", "left")),
        "lookup join, sort-merge, AQE skew threshold 1MB": no_broadcast(
            lambda: df.join(per_key, "k", "left"), "1MB"),
        "lookup join, salted 16 ways": no_broadcast(lambda: L.salted_join(df, per_key, "k", "left", 16, force=True)),
        "J4 fallback_fill, salted": no_broadcast(lambda: L.fallback_fill(
            df, people, people, "k", ["email", "title"], ("a", "b", "none"), force_salt=True)),
        "J9 merge_back, salted": no_broadcast(lambda: L.merge_back(
            df, per_key.withColumnRenamed("n_k", "v"), "k", ["v"], force_salt=True)),
        "A13 empty_sample, salted": no_broadcast(lambda: M.empty_sample(df, "k", per_key, ["n_k"], force_salt=True)),
        "running_sum per key (range partitions)": lambda: B.running_sum(df, ["o"], "v", group=["k"], out="rs"),
        "naive window sum per key (for contrast)": lambda: df.withColumn(
            "rs", F.sum("v").over(Window.partitionBy("k").orderBy("o"))),
    }
    marks = {}
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
        marks[name] = name
    spark.stop()

    # parse the event log: max shuffle records read by one task, per job group
    groups, stage_group, worst = {}, {}, {}
    for path in glob.glob(f"{logs}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    if g:
                        worst[g] = max(worst.get(g, 0), recs)
                        groups.setdefault(g, 0)
    print(f"rows: {n:,}; hot key share: 1/3; shuffle partitions: 16")
    for name in runs:
        w = worst.get(name, 0)
        print(f"{name}: largest shuffle read by one task = {w:,} records ({w / n:.1%} of rows)")


if __name__ == "__main__":
    main()
