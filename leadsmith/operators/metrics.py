"""Reports: funnels, coverage, hit rates, engagement.

Each report is one aggregate pass (``count_if`` over flags), so a funnel
of k stages reads the data once, not k times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.functions.text import nonblank
from leadsmith.operators.lookup import DEFAULT_SALT, salted_join


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], group: Sequence[str] = (),
           distinct: tuple[str, str] | None = None) -> DataFrame:
    """A5: rows surviving each cumulative stage (stage k = all conditions <= k);
    ``distinct=(name, key)`` adds the de-duplicated count after the last stage."""
    aggs, acc = [F.count(F.lit(1)).alias("n_raw")], F.lit(True)
    for name, cond in stages:
        acc = acc & F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(acc).alias(f"n_{name}"))
    if distinct is not None:
        aggs.append(F.count_distinct(F.when(acc, F.col(distinct[1]))).alias(f"n_{distinct[0]}"))
    return df.groupBy(*group).agg(*aggs)


def coverage_pct(present: Column, total: Column) -> Column:
    """Percentage, one decimal, guarded by max(n, 1)."""
    return F.round(present * 100.0 / F.greatest(total, F.lit(1)), 1)


def coverage(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Per column, non-blank count and share of rows."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append(F.count_if(nonblank(c)).alias(f"n_{c}"))
    out = df.groupBy(*group).agg(*aggs)
    return out.select("*", *[coverage_pct(F.col(f"n_{c}"), F.col("n_rows")).alias(f"pct_{c}") for c in cols])


def hit_rate(df: DataFrame, hit: Column, error: Column, group: Sequence[str] = ()) -> DataFrame:
    """Hits / attempted rows, rows with errors excluded from both."""
    ok = ~F.coalesce(error, F.lit(False))
    out = df.groupBy(*group).agg(F.count_if(ok).alias("n_attempted"),
                                 F.count_if(ok & F.coalesce(hit, F.lit(False))).alias("n_hits"),
                                 F.count_if(~ok).alias("n_errors"))
    return out.withColumn("hit_pct", coverage_pct(F.col("n_hits"), F.col("n_attempted")))


def engagement(df: DataFrame, group: str, views: Column, likes: Column, comments: Column,
               present: Column | None = None) -> DataFrame:
    """A10-A12 over integer counts. ``present`` marks items the statistics
    service returned (default: every row). A returned item with a hidden
    count contributes 0 and still counts as sampled, so the mean is
    total / sampled (2 dp, NULL when nothing was sampled), and the rate is
    (likes + comments) / views * 100 (4 dp, NULL when views total 0): a
    ratio of sums, not a mean of ratios. Integer sums are exact, so results
    do not depend on how partial sums are combined."""
    z = F.lit(0).cast("bigint")
    keep = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    out = df.groupBy(group).agg(
        F.count_if(keep).alias("n_sampled"),
        F.sum(F.when(keep, F.coalesce(views, z)).otherwise(z)).alias("total_views"),
        F.sum(F.when(keep, F.coalesce(likes, z)).otherwise(z)).alias("total_likes"),
        F.sum(F.when(keep, F.coalesce(comments, z)).otherwise(z)).alias("total_comments"))
    return out.select(
        group, "n_sampled", "total_views", "total_likes", "total_comments",
        F.round(F.col("total_views") / F.nullif(F.col("n_sampled"), F.lit(0)), 2).alias("mean_views"),
        F.round((F.col("total_likes") + F.col("total_comments")) * 100.0
                / F.nullif(F.col("total_views"), F.lit(0)), 4).alias("engagement_rate"))


def empty_sample(entities: DataFrame, key: str, stats: DataFrame, zero_cols: Sequence[str],
                 force_salt: bool = False) -> DataFrame:
    """Entities with no sample get zeros (counts) and NULLs (means).
    ``stats`` is one row per key; hot keys of ``entities`` are split as in
    ``salted_join``."""
    out = salted_join(entities, stats, key, "left", DEFAULT_SALT, force=force_salt)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(stats.schema[c].dataType)) for c in zero_cols})


def manifest(df: DataFrame, error: Column | None = None) -> DataFrame:
    """One row: status derived from the error count (not always
    SUCCESS, C18), rows processed and rows failed."""
    err = F.lit(False) if error is None else F.coalesce(error, F.lit(False))
    out = df.agg(F.count(F.lit(1)).alias("n_processed"), F.count_if(err).alias("n_failed"))
    status = (F.when(F.col("n_processed") == 0, F.lit("EMPTY"))
              .when(F.col("n_failed") == 0, F.lit("SUCCESS"))
              .when(F.col("n_failed") < F.col("n_processed"), F.lit("PARTIAL"))
              .otherwise(F.lit("FAILED")))
    return out.select(status.alias("status"), "n_processed", "n_failed")


def with_counters(df: DataFrame, name: str, counters: dict[str, Column]):
    """Stage counters collected as a side effect of the job that
    consumes ``df`` (no extra pass): returns (df, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count_if(F.coalesce(c, F.lit(False))).alias(k)
                                                  for k, c in counters.items()]
    return df.observe(obs, *aggs), obs


class StageCounters:
    """E4 for whole flows: what each stage kept and removed, counted by the jobs
    that run anyway.

    ``watch`` counts on the way; it belongs before a shuffle by key, since a
    range sort samples the operators right below it and would count their
    rows twice. ``settle`` writes the stage once to the shared folder and
    counts in that job: for stages that several outputs read, which are then
    computed once. A task that is run again for a lost executor may count its
    rows again in ``watch``; ``settle`` counts are final when it returns.
    """

    def __init__(self, name: str):
        self.name, self._seen = name, []

    def watch(self, df: DataFrame, stage: str, **counters: Column) -> DataFrame:
        out, obs = with_counters(df, f"{self.name}.{stage}", counters)
        self._seen.append((stage, obs))
        return out

    def settle(self, df: DataFrame, stage: str, **counters: Column) -> DataFrame:
        from leadsmith.session import cut_lineage
        return cut_lineage(self.watch(df, stage, **counters))

    def counts(self) -> dict[str, dict[str, int]]:
        """Per stage, after the jobs that pass it (it waits for them)."""
        return {stage: dict(obs.get) for stage, obs in self._seen}

    def frame(self, spark) -> DataFrame:
        """(stage, counter, n), one row a counter."""
        rows = [(stage, name, n) for stage, found in self.counts().items() for name, n in found.items()]
        return spark.createDataFrame(rows, "stage string, counter string, n bigint")
