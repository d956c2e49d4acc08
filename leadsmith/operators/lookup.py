"""Lookups that the reference did as per-row service calls.

Service responses are landed tables; each lookup becomes: reduce the
response table to one row per key (map-side combined ``min_by``), then an
equi ``left`` join. Lookup sides are never assumed small. When Spark's size
estimate says the per-key side will be broadcast, the join is plain; beyond
that, ``salted_join`` splits a hot key on the entity side explicitly (AQE's
skew split does not apply against an aggregate's output).
"""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.functions.text import blank_to_null, keyword_rank, nonblank
from leadsmith.operators.ranking import best_per_group

# Fact-to-per-key joins are salted this many ways when the per-key side is
# too large to broadcast. AQE's skew split needs both join inputs to be
# plain shuffle reads; a per-key side produced by an aggregate is not, so a
# hot key would stay in one task (measured with tools/skew_check.py).
DEFAULT_SALT = 8


_UNITS = {u: 1 << (10 * i) for i, u in enumerate(("", "k", "m", "g", "t", "p", "e"))}


def _bytes(value: str | None) -> float:
    """A byte size as Spark's settings and plans write it ('10485760b', '10MB', '1.5 GiB', '-1'); -1 if it is none."""
    m = re.fullmatch(r"\s*(-?[\d.]+(?:e\+?\d+)?)\s*([kmgtpe]?)i?b?\s*", (value or "").lower())
    return float(m.group(1)) * _UNITS[m.group(2)] if m else -1


def broadcast_sized(df: DataFrame) -> bool:
    """True when Spark's own size estimate of ``df`` is under the broadcast
    threshold, i.e. the planner will broadcast it in a join. No job runs: the
    estimate is the first of ``explain(mode="cost")``, and without one a table counts as large."""
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    if limit <= 0:
        return False
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain(mode="cost")
    found = re.search(r"Statistics\(sizeInBytes=([^,)]+)", plan.getvalue())
    size = _bytes(found.group(1)) if found else -1
    return 0 <= size <= limit


def salted_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
                salt_buckets: int = 16, salt_from: Sequence[str] | None = None,
                force: bool = False) -> DataFrame:
    """Equi-join that splits hot keys explicitly when it has to.

    ``small`` must be one row per key (a per-key reduction). If Spark's size
    estimate says it will be broadcast, a plain join is returned: a
    broadcast join processes every fact partition locally, so a hot key
    costs nothing extra. Otherwise (or with ``force``) each row of ``small``
    is replicated ``salt_buckets`` times with salt 0..n-1 and each row of
    ``big`` gets salt = hash(``salt_from`` columns) mod n, so a key holding
    a third of ``big`` is spread over n tasks instead of one. The small
    side grows n-fold (bounded by n x keys); results equal the plain join.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "semi", "left_anti", "anti"):
        raise ValueError(f"a salted join keeps the rows of its first side only: how={how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if not force and broadcast_sized(small):
        return big.join(small, keys, how)
    src = list(salt_from or [f.name for f in big.schema if f.name not in keys and "map<" not in f.dataType.simpleString()])
    # any salt in [0, n) is correct (every salt has a replica); a row hash
    # keeps it stable, a seeded random number covers key-only inputs
    salt = (F.pmod(F.xxhash64(*[F.col(c) for c in src]), F.lit(salt_buckets)) if src
            else F.floor(F.rand(42) * salt_buckets).cast("bigint"))
    salted_big = big.withColumn("_salt", salt)
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast(
        "array<bigint>")))
    return salted_big.join(salted_small, [*keys, "_salt"], how).drop("_salt")


def best_contact(contacts: DataFrame, key: str, title: str, keywords: Sequence[str], pos: str,
                 keep: Sequence[str], confidence: str | None = None) -> DataFrame:
    """W1/W2 reduction of a contact table to one row per key."""
    ranked = contacts.withColumn("title_rank", keyword_rank(title, keywords, 99 if confidence is None
                                                            else len(keywords)))
    order: list = ["title_rank"]
    if confidence is not None:
        order.append(-F.coalesce(F.col(confidence), F.lit(0)))
    order.append(pos)
    return best_per_group(ranked, key, order, [*keep, "title_rank"])


def contact_lookup(entities: DataFrame, contacts: DataFrame, key: str, title: str,
                   keywords: Sequence[str], pos: str, keep: Sequence[str],
                   confidence: str | None = None, found: str = "found",
                   missing: str = "not_found", salt_buckets: int | None = DEFAULT_SALT,
                   force_salt: bool = False) -> DataFrame:
    """Attach the best-ranked contact per key, with a provenance label.
    ``salt_buckets`` splits hot keys explicitly (``salted_join``)."""
    best = best_contact(contacts, key, title, keywords, pos, keep, confidence)
    out = (salted_join(entities, best, key, "left", salt_buckets, force=force_salt) if salt_buckets
           else entities.join(best, key, "left"))
    return out.withColumn("source", F.when(F.col("title_rank").isNotNull(), F.lit(found))
                          .otherwise(F.lit(missing)))


def fallback_fill(base: DataFrame, primary: DataFrame, secondary: DataFrame, key: str,
                  fields: Sequence[str], labels: tuple[str, str, str],
                  salt_buckets: int = DEFAULT_SALT, force_salt: bool = False) -> DataFrame:
    """Take each field from ``primary``; where blank, from ``secondary``.

    ``primary``/``secondary`` are one row per key with the same field names.
    Hot keys of ``base`` are split as in ``salted_join``.
    Label: labels[0] if primary gave the deciding field (fields[0]),
    labels[1] if secondary did, else labels[2].
    """
    p = primary.select(key, *[F.col(f).alias(f"_p_{f}") for f in fields])
    s = secondary.select(key, *[F.col(f).alias(f"_s_{f}") for f in fields])
    own = [c for c in base.columns if c != key]
    j = salted_join(base, p, key, "left", salt_buckets, own, force_salt)
    j = salted_join(j, s, key, "left", salt_buckets, own, force_salt)
    lead = fields[0]
    label = (F.when(nonblank(f"_p_{lead}"), F.lit(labels[0]))
             .when(nonblank(f"_s_{lead}"), F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))
    filled = [F.coalesce(blank_to_null(f"_p_{f}"), blank_to_null(f"_s_{f}")).alias(f) for f in fields]
    return j.select(*base.columns, *filled, label.alias("source"))


def merge_back(base: DataFrame, updates: DataFrame, key: str, fields: Sequence[str],
               salt_buckets: int = DEFAULT_SALT, force_salt: bool = False) -> DataFrame:
    """Rows present in ``updates`` take its field values; others pass.

    Keyed on a unique key (not the name, which the reference used and which
    collapses duplicates); row count of ``base`` is preserved when
    ``updates`` is unique per key. Hot keys of ``base`` are split as in
    ``salted_join``.
    """
    u = updates.select(key, *[F.col(f).alias(f"_u_{f}") for f in fields], F.lit(True).alias("_hit"))
    j = salted_join(base, u, key, "left", salt_buckets, force=force_salt)
    cols = [F.when(F.col("_hit"), F.col(f"_u_{f}")).otherwise(F.col(f)).alias(f)
            if f in fields else F.col(f) for f in base.columns]
    return j.select(*cols)


def chain(df: DataFrame, steps: Sequence[tuple[DataFrame, str | Sequence[str] | Column]],
          how: str = "left") -> DataFrame:
    """Successive equi joins (channel -> playlist -> videos -> stats)."""
    out = df
    for right, on in steps:
        out = out.join(right, on, how)
    return out


def split_errors(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead-letter rows with an ``error`` text)."""
    tagged = df.withColumn("error", error)
    return tagged.where(F.col("error").isNull()).drop("error"), tagged.where(F.col("error").isNotNull())


def on_error(df: DataFrame, failed: Column, policy: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """What happens to a row whose enrichment failed: keep / drop / default."""
    if policy == "keep":
        return df
    if policy == "drop":
        return df.where(~F.coalesce(failed, F.lit(False)))
    if policy == "default":
        return df.withColumns({c: F.when(failed, v).otherwise(F.col(c)) for c, v in (defaults or {}).items()})
    raise ValueError(policy)
