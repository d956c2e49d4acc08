"""Choose one candidate per entity.

Candidates are rows ``(entity, rank, ...)``; the reference walks them in
rank order and stops at the first acceptable one. Here that is a single
aggregate per entity with ``min_by`` over an explicit, unique ordering:
it combines map-side (a hot entity holding a third of all rows is reduced
in every map task before the shuffle) and never sorts a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.functions.text import nonblank


def _order(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def first_valid(df: DataFrame, entity: str | Sequence[str], order: Sequence[str],
                valid: Column, keep: Sequence[str], prefix: str = "") -> DataFrame:
    """J5 (and J6 with ``order=[tier, rank]``): first acceptable row per entity.

    Entities without any acceptable row keep NULLs. ``order`` must be unique
    within an entity. Output: entity columns, ``n_candidates``, ``n_valid``
    and ``prefix + c`` for each kept column.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    pick = F.min_by(F.struct(*[F.col(c) for c in keep]), F.when(valid, _order(order)))
    agg = df.groupBy(*ents).agg(
        pick.alias("_best"),
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if(valid).alias("n_valid"),
    )
    return agg.select(*ents, "n_candidates", "n_valid",
                      *[F.col("_best")[c].alias(prefix + c) for c in keep])


def first_hit(df: DataFrame, entity: str, order: Sequence[str], value: str,
              blocked: Column) -> DataFrame:
    """Only the first hit counts; a blocked first hit is not replaced.

    Returns ``entity, value, outcome`` with outcome found / blocked /
    not_found (NULL or blank value).
    """
    first = df.groupBy(entity).agg(
        F.min_by(F.struct(F.col(value).alias("v"), blocked.alias("b")), _order(order)).alias("_h"))
    v = F.col("_h.v")
    outcome = (F.when(~nonblank(v), F.lit("not_found"))
               .when(F.col("_h.b"), F.lit("blocked"))
               .otherwise(F.lit("found")))
    return first.select(entity, F.when(outcome == "found", v).alias(value), outcome.alias("outcome"))


def rejection_reason(checks: Sequence[tuple[str, Column]]) -> Column:
    """First failing check in precedence order, else 'ok'."""
    expr = F.lit("ok")
    for label, bad in reversed(list(checks)):
        expr = F.when(bad, F.lit(label)).otherwise(expr)
    return expr


def rejection_counts(df: DataFrame, entity: str, order: Sequence[str], reason: Column) -> DataFrame:
    """Rejections counted only up to each entity's first valid hit.

    The first-valid position is found with a map-side-combined aggregate,
    then joined back on the entity key with a salted join (one row per
    entity, replicated a few ways, so a hot entity is split across tasks).
    """
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    tagged = df.withColumn("_reason", reason).withColumn("_ord", _order(order))
    first = tagged.groupBy(entity).agg(F.min(F.when(F.col("_reason") == "ok", F.col("_ord"))).alias("_stop"))
    # salted: an entity with a third of the hits is spread over several tasks
    seen = (salted_join(tagged, first, entity, "left", DEFAULT_SALT, salt_from=["_ord"])
            .where(F.col("_stop").isNull() | (F.col("_ord") <= F.col("_stop"))))
    return seen.groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def outcome_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Rows per outcome label."""
    return df.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


TIER_BUCKETS = 1024  # folders of a landed tier; the unresolved ones are a list of so many numbers at most


def tier_bucket(entity: str, buckets: int = TIER_BUCKETS) -> Column:
    """The folder in which an entity's hits are landed."""
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")


def land_tier(hits: DataFrame, path: str, entity: str, buckets: int = TIER_BUCKETS) -> None:
    """Write a tier's hits in folders by ``tier_bucket``."""
    (hits.withColumn("bucket", tier_bucket(entity, buckets)).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))


def staged_first_valid(entities: DataFrame, tiers: Sequence[Callable[[], DataFrame]], entity: str, order: Sequence[str],
                       valid: Column, keep: Sequence[str], prefix: str = "", buckets: int = TIER_BUCKETS) -> tuple[DataFrame, list[int]]:
    """J6 as it was meant: tier n + 1 is read only for entities that tiers 1..n
    left without an acceptable hit.

    ``tiers`` scan hits landed by ``land_tier``, first tier first. Before a
    tier is read, the folders that still hold unresolved entities are known
    (at most ``buckets`` numbers reach the driver) and the scan is pruned to
    them; what is read is semi-joined with the unresolved entities before
    any shuffle by entity. Unresolved entities are checkpointed between tiers,
    so no tier is read twice, and reading ends when none are left.

    Returns (entity, ``tier`` from 1, ``prefix + c`` for each kept column;
    NULLs without a hit) and the rows read of each tier. An entity's best row
    is the first valid one by ``order`` of its first tier that has one. NULL
    entities have no hits. Repeated entities are one.
    """
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    from leadsmith.operators.metrics import StageCounters
    from leadsmith.session import cut_lineage
    todo = cut_lineage(entities.where(F.col(entity).isNotNull()).select(entity).distinct().withColumn("bucket", tier_bucket(entity, buckets)))
    counters, done, read = StageCounters("staged"), [], []
    for n, scan in enumerate(tiers, 1):
        wanted = sorted(r[0] for r in todo.select("bucket").distinct().collect())
        if not wanted:
            read.append(0)
            continue
        hits = counters.watch(scan().where(F.col("bucket").isin(wanted)), f"tier {n}")
        hits = salted_join(hits.drop("bucket"), todo.select(entity), entity, "left_semi", DEFAULT_SALT)
        best = first_valid(hits, entity, order, valid, keep, prefix).where("n_valid > 0").drop("n_candidates", "n_valid")
        done.append(cut_lineage(best.withColumn("tier", F.lit(n))))
        read.append(counters.counts()[f"tier {n}"]["n_rows"])
        todo = cut_lineage(todo.join(done[-1].select(entity), entity, "left_anti"))
    out = todo.select(entity)
    for found in done:
        out = out.unionByName(found, allowMissingColumns=True)
    return out, read
