"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source s holds a share p of all tokens; its weight is p**a / sum(p**a). The
exponent a (1: as found, 0: uniform) is found by bisection, so that the
weights' entropy meets a target and no source repeats more often than
allowed within the token budget. One small aggregate over the table of
sources answers four steps; only three sums for each of the 15 exponents that
they may ask for reach the driver.

The weights are realised by permuting blocks. Each source's documents are
dealt by hash into ``BLOCKS`` blocks of ``BLOCKS`` leaves. A source's quota
is so many whole epochs and a rest. The rest takes the blocks in the order
of that epoch's permutation while they fit, then the leaves of the first
block that does not fit. So a running sum never spans more than ``BLOCKS``
rows a source, however many documents it has, and the drawn tokens stay
below the quota by less than a leaf.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import checkpointed, table

BLOCKS = 256
STEPS = 40
AHEAD = 4  # steps of the bisection that one job answers
SALT = 16


def _tokens(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _draw(seed: int, *cols):
    return F.xxhash64(F.lit(seed), *cols)


def exponent(sources: DataFrame, budget: float, entropy_gain: float, max_repeats: float) -> float:
    """The exponent, by bisection over (source, tokens): the smallest one whose
    weights gain at most ``entropy_gain`` of the way from the entropy as found
    to the uniform one and repeat no source more than ``max_repeats`` times."""
    total = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not total["t"]:
        return 1.0
    p = F.col("tokens") / F.lit(float(total["t"]))
    shares = checkpointed(sources.select(p.alias("p")))

    def measures(some: list[float]) -> dict[float, tuple[float, float]]:
        """Of each exponent: the weights' entropy and the most repeats; one job for all of them."""
        a = F.col("a")
        w = F.pow("p", a)
        r = (shares.select("p", F.explode(F.lit(some)).alias("a")).groupBy("a")
             .agg(F.sum(w).alias("z"), F.sum(w * F.log("p")).alias("l"), F.max(F.pow("p", a - 1.0)).alias("m")).collect())
        return {x["a"]: (math.log(x["z"]) - x["a"] * x["l"] / x["z"], budget / total["t"] / x["z"] * x["m"]) for x in r}

    ends = measures([0.0, 1.0])
    found, uniform = ends[1.0][0], ends[0.0][0]
    target = found + entropy_gain * (uniform - found)
    low, high = 0.0, 1.0  # at ``high`` the limits hold (or cannot hold for any exponent)
    known: dict[float, tuple[float, float]] = {}
    for _ in range(STEPS):
        mid = (low + high) / 2
        if mid not in known:  # this step's exponent and those that the next ones may ask for
            parts = 1 << AHEAD
            known = measures([low + (high - low) * k / parts for k in range(1, parts)])
        h, repeats = known[mid]
        if h <= target and repeats <= max_repeats:
            high = mid
        else:
            low = mid
        if high - low < 1e-7:
            break
    return high


def mixed(docs: DataFrame, budget_ratio: float = 1.0, entropy_gain: float = 0.5, max_repeats: float = 4.0, seed: int = 1,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs``, one row per drawn copy, and the columns n_tokens, mix_weight,
    mix_shortfall, epoch, block and mix_key (sort by it to get the mixed order).

    No source is drawn more than ``max_repeats`` times. If the budget is so
    large that no exponent allows that, quotas are cut at the limit, and
    mix_shortfall says how many tokens of its quota a source lost (else 0).

    The budget is ``budget_ratio`` times the tokens of the input; a token is
    a run of non-space bytes. Null texts have no tokens, and documents of a
    source without tokens are not drawn; documents without tokens go with
    their leaf. A null source is a source of its own; null and repeated ids
    share a leaf and are drawn together. An empty table gives an empty one.
    An input column with the name of a new one is replaced.
    """
    new = ["n_tokens", "mix_weight", "mix_shortfall", "epoch", "block", "mix_key"]
    kept = [c for c in docs.columns if c.lower() not in new]
    rows = docs.select(*kept, _tokens(text_col).alias("n_tokens"),
                       F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_llm_source"),
                       F.pmod(_draw(seed, F.col(id_col)), F.lit(BLOCKS)).cast("int").alias("block"),
                       F.pmod(_draw(seed + 1, F.col(id_col)), F.lit(BLOCKS)).cast("int").alias("_llm_leaf"))
    leaves = checkpointed(rows.groupBy("_llm_source", "block", "_llm_leaf").agg(F.sum("n_tokens").alias("tokens")))
    sources = checkpointed(leaves.groupBy("_llm_source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    total = sources.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    budget = total * budget_ratio
    a = exponent(sources, budget, entropy_gain, max_repeats)
    z = sources.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a))).alias("z")).first()["z"] or 1.0
    weight = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a)) / F.lit(z)
    asked = F.round(weight * F.lit(budget)).cast("bigint")
    quota = F.least(asked, F.floor(F.col("tokens") * F.lit(float(max_repeats))).cast("bigint"))
    plan = (sources.withColumn("mix_weight", weight).withColumn("quota", quota).withColumn("mix_shortfall", asked - quota)
            .withColumn("epochs", F.expr("quota div tokens").cast("int"))
            .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")))

    # the partial epoch: whole blocks while they fit, then leaves of the next block
    order = Window.partitionBy("_llm_source").orderBy(_draw(seed + 2, "epochs", "block"), "block")
    blocks = leaves.groupBy("_llm_source", "block").agg(F.sum("tokens").alias("size"))
    blocks = (blocks.join(plan.select("_llm_source", "epochs", "rest"), "_llm_source")
              .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    taken = blocks.where("upto <= rest").groupBy("_llm_source").agg(F.collect_set("block").alias("whole"))
    cut = (blocks.where("upto > rest").groupBy("_llm_source")
           .agg(F.min_by(F.struct("block", (F.col("rest") - F.col("upto") + F.col("size")).alias("left"), "epochs"), "upto").alias("c"))
           .select("_llm_source", F.col("c.block").alias("block"), F.col("c.left").alias("left"), F.col("c.epochs").alias("epochs")))
    by_leaf = Window.partitionBy("_llm_source").orderBy(_draw(seed + 3, "epochs", "_llm_leaf"), "_llm_leaf")
    part = (leaves.join(cut, ["_llm_source", "block"])
            .withColumn("upto", F.sum("tokens").over(by_leaf.rowsBetween(Window.unboundedPreceding, 0)))
            .where("upto <= left").groupBy("_llm_source").agg(F.first("block").alias("cut"), F.collect_set("_llm_leaf").alias("leaves")))
    decided = (plan.select("_llm_source", "mix_weight", "mix_shortfall", "epochs").join(taken, "_llm_source", "left").join(part, "_llm_source", "left")
               .select("_llm_source", "mix_weight", "mix_shortfall", "epochs", F.coalesce("whole", F.array().cast("array<int>")).alias("whole"), "cut",
                       F.coalesce("leaves", F.array().cast("array<int>")).alias("leaves")))
    # a hot source is spread over SALT keys; the other side is one row a source and salt
    decided = checkpointed(decided).withColumn("_llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = rows.withColumn("_llm_salt", F.pmod(_draw(seed + 4, F.col(id_col), F.col("n_tokens")), F.lit(SALT)).cast("int"))
    also = (F.array_contains("whole", F.col("block")) | (F.coalesce(F.col("cut") == F.col("block"), F.lit(False))
                                                         & F.array_contains("leaves", F.col("_llm_leaf"))))
    copies = F.col("epochs") + F.when(also, 1).otherwise(0)
    drawn = (rows.join(decided, ["_llm_source", "_llm_salt"]).withColumn("_llm_copies", copies).where("_llm_copies > 0")
             .withColumn("epoch", F.explode(F.expr("sequence(0, _llm_copies - 1)"))))
    # blocks of all sources, permuted anew in every epoch; documents in hash order within a block
    key = F.shiftleft(F.pmod(_draw(seed + 5, "_llm_source", "epoch", "block"), F.lit(1 << 30)), 32) + F.pmod(
        _draw(seed + 6, F.col(id_col), "epoch"), F.lit(1 << 32))
    return drawn.select(*kept, "n_tokens", "mix_weight", "mix_shortfall", "epoch", "block", key.alias("mix_key"))


def op2_mixing(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "mix_weight", "epoch", "block", "mix_key")
