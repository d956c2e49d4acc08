"""Best row per entity by a rank.

All pickers reduce with ``min_by`` over a unique ordering struct, which
is partially aggregated before the shuffle (skew-safe). Only W6, which
keeps N rows, uses a window; Spark plans it as a partial
``WindowGroupLimit`` before the exchange, so a hot entity ships at most N
rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadsmith.functions.text import keyword_rank


def best_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column | str],
                   keep: Sequence[str], where: Column | None = None,
                   name: str = "_best") -> DataFrame:
    """Generic: row with the smallest ``order`` among rows passing ``where``.

    Groups without such a row keep NULL fields.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    ordering = F.struct(*ords)
    if where is not None:
        ordering = F.when(where, ordering)
    agg = df.groupBy(*groups).agg(F.min_by(F.struct(*[F.col(c) for c in keep]), ordering).alias(name))
    return agg.select(*groups, *[F.col(name)[c].alias(c) for c in keep])


def priority_pick(df: DataFrame, group: str, title: str, keywords: Sequence[str], pos: str,
                  keep: Sequence[str], default_rank: int = 99,
                  confidence: str | None = None) -> DataFrame:
    """Smallest keyword rank, then (W2) highest confidence, then position."""
    ranked = df.withColumn("title_rank", keyword_rank(title, keywords, default_rank))
    order: list = ["title_rank"]
    if confidence is not None:
        order.append(-F.coalesce(F.col(confidence), F.lit(0)))
    order.append(pos)
    return best_per_group(ranked, group, order, [*keep, "title_rank"])


def first_match(df: DataFrame, group: str, pos: str, match: Column, keep: Sequence[str]) -> DataFrame:
    """First row in position order that matches (NULLs when none)."""
    return best_per_group(df, group, [pos], keep, where=match)


def match_else_first(df: DataFrame, group: str, pos: str, match: Column, keep: Sequence[str],
                     labels: tuple[str, str] = ("matched", "fallback")) -> DataFrame:
    """First matching row, else the first row overall, with a label."""
    order = F.struct(F.col(pos))
    row = F.struct(*[F.col(c) for c in keep])
    agg = df.groupBy(group).agg(
        F.min_by(row, F.when(match, order)).alias("_m"),
        F.min_by(row, order).alias("_f"))
    hit = F.col("_m").isNotNull()
    pick = F.when(hit, F.col("_m")).otherwise(F.col("_f"))
    return agg.select(group, *[pick[c].alias(c) for c in keep],
                      F.when(hit, F.lit(labels[0])).otherwise(F.lit(labels[1])).alias("outcome"))


def cascade(df: DataFrame, group: str, pos: str, levels: Sequence[tuple[str, Column]],
            keep: Sequence[str], last_label: str) -> DataFrame:
    """level = first condition that holds (in list order), else the last
    level; keep the row with the smallest (level, position); label by level."""
    level = F.lit(len(levels))
    for i in reversed(range(len(levels))):
        level = F.when(levels[i][1], F.lit(i)).otherwise(level)
    names = [lbl for lbl, _ in levels] + [last_label]
    leveled = df.withColumn("_level", level)
    best = best_per_group(leveled, group, ["_level", pos], [*keep, "_level"])
    return best.withColumn("outcome", F.element_at(F.array(*[F.lit(n) for n in names]),
                                                    F.col("_level") + 1)).drop("_level")


def recent_n(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The n first rows per group by ``order`` (e.g. newest first)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
