"""Shared pieces of the operators: scans, folds, fixed-size count tables,
shared-folder checkpoints and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.session import checkpoint_dir
from leadsmith.sources.tables import table
from llm.words import mix

__all__ = ["Bitmap", "checkpointed", "components", "count_table", "fold", "row_key", "table"]


def fold(doc_id: str, mod: int) -> Column:
    """``crc32(doc_id as text) mod m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def row_key(id_col: str, text_col: str) -> Column:
    """A key of (id, text), nulls included: rows with equal ids and other texts have other keys."""
    return F.xxhash64(F.lit(11), F.col(id_col), F.col(text_col), F.length(text_col))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def count_table(docs: DataFrame, bits: int, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """Counts over all rows of hashes, by their low ``bits`` bits.

    Each task adds up a table of 2**bits counters and sends its non-zero
    slices of 4,096; slices are summed by slice number. The result is
    2**bits 8-byte counters whatever the input is.
    """
    size, width = 1 << bits, min(1 << bits, 4096)
    mask = np.uint64(size - 1)

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for h in hashes_of(batch):
                total += np.bincount((h & mask).astype(np.int64), minlength=size)
        cut = total.reshape(-1, width)
        for at in np.flatnonzero(cut.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "counts": pa.array([cut[at]], pa.list_(pa.int64()))})

    def add(batches):
        total = {}
        for batch in batches:
            for at, row in zip(batch["slice"].to_pylist(), batch["counts"]):
                total[at] = total.get(at, 0) + row.values.to_numpy()
        for at, row in total.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "counts": pa.array([row], pa.list_(pa.int64()))})

    schema = "slice int, counts array<bigint>"
    parts = docs.mapInArrow(count, schema).repartition("slice").mapInArrow(add, schema)
    out = np.zeros(size, dtype=np.int64)
    for row in parts.toArrow().to_batches():
        for at, counts in zip(row["slice"].to_pylist(), row["counts"]):
            out[at * width:(at + 1) * width] += counts.values.to_numpy()
    return out


class Bitmap:
    """Which values may be in a set: 2**bits flags at hashes of the values.

    The size is fixed, so it can be broadcast whatever the set's size is; it
    lets rows of other values stay where they are, and a join decides on the
    rest. A set much larger than the flags only makes it less selective.
    """

    def __init__(self, flags: np.ndarray, bits: int):
        self.flags, self.bits = flags, bits

    @staticmethod
    def _places(values: np.ndarray, bits: int) -> np.ndarray:
        return (mix(values.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)

    @staticmethod
    def of(values: DataFrame, bits: int) -> Bitmap:
        """Of a one-column DataFrame of longs; eight tasks make one bitmap each at most, one task joins them."""
        def mark(batches):
            flags = np.zeros(1 << bits, dtype=bool)
            for b in batches:
                flags[Bitmap._places(b.column(0).to_numpy(), bits)] = True
            yield pa.RecordBatch.from_pydict({"flags": pa.array([np.packbits(flags).tobytes()], pa.binary())})

        def either(batches):
            flags = np.zeros((1 << bits) // 8, dtype=np.uint8)
            for b in batches:
                for row in b["flags"]:
                    flags |= np.frombuffer(row.as_buffer(), dtype=np.uint8)
            yield pa.RecordBatch.from_pydict({"flags": pa.array([flags.tobytes()], pa.binary())})

        parts = values.distinct().coalesce(8).mapInArrow(mark, "flags binary")
        joined = parts.repartition(1).mapInArrow(either, "flags binary").collect()
        full = np.frombuffer(joined[0]["flags"], dtype=np.uint8) if joined else np.zeros((1 << bits) // 8, dtype=np.uint8)
        return Bitmap(full, bits)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        at = self._places(values, self.bits)
        return (self.flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over undirected edges (a, b).

    Alternating large-star and small-star steps: every edge is rewired to
    the smallest known neighbour until each id points at its component's
    minimum. Ids without an edge are not returned. Only counts reach the
    driver, and every round is checkpointed. A round has few exchanges, as
    the driver keeps something of every stage and task.
    """
    def both(first: tuple, second: tuple) -> Column:
        """Two rows (u, v) of one."""
        return F.inline(F.array(*(F.struct(F.col(u).alias("u"), v.alias("v")) for u, v in (first, second))))

    e = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        # settled when every id has one edge down and none of the ids above also lies below another
        sides = e.select(both(("u", F.lit(1)), ("v", F.lit(0)))).groupBy("u").agg(F.sum("v").alias("down"), F.min("v").alias("least"))
        if not sides.where("down > 1 or down > 0 and least = 0").agg(F.count("*")).first()[0]:
            break
        low = e.select(both(("u", F.col("v")), ("v", F.col("u")))).groupBy("u")
        low = checkpointed(low.agg(F.least(F.min("v"), F.col("u")).alias("m")))  # plain, so that a hot id is split in the join
        # large star: (u, v) with v > u becomes (v, smallest neighbour of u)
        big = (e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
               .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours point at the smallest of them
        tops = checkpointed(big)
        small = tops.groupBy("u").agg(F.min("v").alias("m"))
        e = tops.join(small, "u").select(both(("v", F.col("m")), ("u", F.col("m")))).where("u <> v").distinct()
        e = checkpointed(e)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
