"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine c lie sqrt(2 - 2c) apart, so all links are within
that epsilon, also after projection. Vectors are projected on the leading
principal directions and sorted by their epsilon grid cells, lexicographically
over the directions; the order is cut into blocks with bounding boxes.
Intervals of the order are joined recursively, from the whole order down:
a pair of intervals whose boxes are provably farther apart than epsilon is
skipped, any other is replaced by the pairs of its parts, until pairs of
blocks remain. Those are compared exactly, in double precision.

Equal vectors are one vector with a count. A pair of blocks returns counts
of links and a spanning forest of its links, never the links themselves, so
a dense cluster costs rows in proportion to its vectors and block pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import checkpointed, components, table

LEADING = 8  # principal directions of the grid
BLOCK = 2048  # vectors in a block; what travels is (vectors / BLOCK) ** 2 pairs of blocks at most
FAN = 4  # parts an interval is split into


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by their largest component first, whose square could be 0 or infinite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_directions(vecs: DataFrame, dim: int) -> np.ndarray:
    """(dim, up to LEADING) leading eigenvectors of the covariance of the unit
    vectors. Each task adds up its vectors' products; the rows of these
    matrices are added in Spark by row, and one matrix reaches the driver."""

    def sums(batches):
        total, outer, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for b in batches:
            x = _unit(_matrix(b["v"]))
            total, outer, n = total + x.sum(0), outer + x.T @ x, n + len(x)
        rows = np.vstack([outer, total, np.full(dim, n, dtype=np.float64)])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(dim + 2)), "x": pa.array(list(rows), pa.list_(pa.float64()))})

    def add(batches):
        rows = {}
        for b in batches:
            for i, x in zip(b["i"].to_pylist(), b["x"]):
                rows[i] = rows.get(i, 0) + x.values.to_numpy()
        if rows:
            yield pa.RecordBatch.from_pydict({"i": pa.array(list(rows), pa.int64()), "x": pa.array(list(rows.values()), pa.list_(pa.float64()))})

    schema = "i bigint, x array<double>"
    found = vecs.select("v").mapInArrow(sums, schema).repartition("i").mapInArrow(add, schema).toArrow()
    rows = dict(zip(found["i"].to_pylist(), found["x"].to_pylist()))
    outer, total, n = np.array([rows[i] for i in range(dim)]), np.array(rows[dim]), rows[dim + 1][0]
    mean = total / max(n, 1)
    _, directions = np.linalg.eigh(outer / max(n, 1) - np.outer(mean, mean))
    return np.ascontiguousarray(directions[:, ::-1][:, :LEADING])


def _forest(mask: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) that connect what the links of ``mask`` connect: every
    linked row or column to the smallest id it reaches within the mask."""
    big = np.iinfo(np.int64).max
    a, b = np.where(mask.any(1), rows, big), np.where(mask.any(0), cols, big)
    r, c = np.nonzero(mask)
    while True:
        a2, b2 = a.copy(), b.copy()
        np.minimum.at(a2, r, b[c])
        np.minimum.at(b2, c, a2[r])
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    start, to = np.concatenate([rows, cols]), np.concatenate([a, b])
    ok = (to != big) & (start != to)
    return start[ok], to[ok]


def _same_length(reps: DataFrame, dim: int, cosine: float, wire: str, size: int) -> DataFrame:
    """(id, links, a, b): counts of links of ``reps`` (id, n, v) and forest edges
    (a, b). ``wire`` is the type in which components travel without loss."""
    spark = reps.sparkSession
    eps = float(np.sqrt(max(2 - 2 * cosine, 0.0))) + 1e-7
    axes = spark.sparkContext.broadcast(principal_directions(reps, dim))
    lead = axes.value.shape[1]

    def project(batches):
        for b in batches:
            x = _unit(_matrix(b["v"]))
            p = x @ axes.value
            cell = np.floor(p / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b["id"], b["n"], b["v"], pa.array(list(p), pa.list_(pa.float64())),
                                              *(pa.array(cell[:, j]) for j in range(lead))], names=["id", "n", "v", "p", *(f"c{j}" for j in range(lead))])

    cells = [f"c{j}" for j in range(lead)]
    placed = checkpointed(reps.mapInArrow(project, "id bigint, n bigint, v array<double>, p array<double>, " + ", ".join(f"{c} int" for c in cells)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, *cells, "id").sortWithinPartitions(*cells, "id").withColumn("part", F.spark_partition_id())

    def cut(batches):
        held, seq = None, 0
        for b in batches:
            t = pa.Table.from_batches([b])
            held = pa.concat_tables([held, t]) if held is not None else t
            while held.num_rows >= size:
                yield piece(held.slice(0, size), seq)
                held, seq = held.slice(size), seq + 1
        if held is not None and held.num_rows:
            yield piece(held, seq)

    def piece(t, seq):
        t = t.combine_chunks()
        p = _matrix(t["p"].chunk(0))
        return pa.RecordBatch.from_pydict({
            "part": [t["part"][0].as_py()], "seq": [seq], "ids": [t["id"].to_pylist()], "ns": [t["n"].to_pylist()],
            "vs": [_matrix(t["v"].chunk(0)).astype(wire).tobytes()], "lo": [p.min(0).tolist()], "hi": [p.max(0).tolist()]}, schema=_BLOCK_PA)

    pieces = checkpointed(ordered.mapInArrow(cut, _BLOCK))
    # rows before each part, one number a part: a piece's place in the whole order
    sizes = {r["part"]: r["n"] for r in pieces.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).toLocalIterator()}
    offset, rows = [], 0
    for p in range(parts):
        offset.append((p, rows))
        rows += sizes.get(p, 0)
    # pieces that start in the same ``size`` rows of the order are one block, of fewer than
    # 2 * ``size`` vectors, so the number of blocks follows the vectors, not the partitions
    offsets = F.broadcast(spark.createDataFrame(offset, "part int, before bigint"))
    numbered = pieces.join(offsets, "part").withColumn("no", F.floor((F.col("before") + F.col("seq") * F.lit(size)) / size).cast("int"))

    def merge(key, t):
        t = t.sort_by([("part", "ascending"), ("seq", "ascending")]).to_pydict()
        return pa.Table.from_pydict({
            "no": [key[0].as_py()], "ids": [sum(t["ids"], [])], "ns": [sum(t["ns"], [])], "vs": [b"".join(t["vs"])],
            "lo": [np.min(t["lo"], axis=0).tolist()], "hi": [np.max(t["hi"], axis=0).tolist()]}, schema=_MERGED_PA)

    blocks = checkpointed(numbered.groupBy("no").applyInArrow(merge, "no int, ids array<bigint>, ns array<bigint>, vs binary, lo array<double>, hi array<double>"))
    at = -(-rows // size)

    boxes = [checkpointed(blocks.select("no", "lo", "hi"))]
    while FAN ** (len(boxes) - 1) < at:
        below = boxes[-1]
        low = [F.min(F.col("lo")[j]) for j in range(lead)]
        high = [F.max(F.col("hi")[j]) for j in range(lead)]
        boxes.append(checkpointed(below.groupBy(F.floor(F.col("no") / FAN).cast("int").alias("no")).agg(F.array(*low).alias("lo"), F.array(*high).alias("hi"))))

    def near(pairs, box):
        x = box.select(F.col("no").alias("i"), F.col("lo").alias("xl"), F.col("hi").alias("xh"))
        y = box.select(F.col("no").alias("j"), F.col("lo").alias("yl"), F.col("hi").alias("yh"))
        gap = [F.greatest(F.lit(0.0), F.col("yl")[d] - F.col("xh")[d], F.col("xl")[d] - F.col("yh")[d]) for d in range(lead)]
        return pairs.join(x, "i").join(y, "j").where(sum((g * g for g in gap), F.lit(0.0)) <= eps * eps).select("i", "j")

    pairs = boxes[-1].select(F.col("no").alias("i"), F.col("no").alias("j"))
    for box in boxes[-2::-1]:
        parts_of = F.sequence(F.lit(0), F.lit(FAN - 1))
        pairs = (pairs.select("i", "j", F.explode(parts_of).alias("a")).select("i", "j", "a", F.explode(parts_of).alias("b"))
                 .select((F.col("i") * FAN + F.col("a")).alias("i"), (F.col("j") * FAN + F.col("b")).alias("j")).where("i <= j"))
        pairs = checkpointed(near(pairs, box))

    def compare(batches):
        for b in batches:
            for i, j, xi, xn, xv, yi, yn, yv in zip(*(b[c].to_pylist() for c in ("i", "j", "xi", "xn", "xv", "yi", "yn", "yv"))):
                x, y = (_unit(np.frombuffer(v, dtype=wire).astype(np.float64).reshape(-1, dim)) for v in (xv, yv))
                xi, xn, yi, yn = map(np.array, (xi, xn, yi, yn))
                mask = x @ y.T >= cosine
                if i == j:
                    np.fill_diagonal(mask, False)
                if not mask.any():
                    continue
                links, back = mask @ yn, mask.T @ xn if i != j else np.zeros(len(yi), dtype=np.int64)
                a, t = _forest(mask, xi, yi)
                ids, n = np.concatenate([xi, yi]), np.concatenate([links, back])
                ids, n = ids[n > 0], n[n > 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, np.zeros(len(a), np.int64)]), mask=np.arange(len(ids) + len(a)) >= len(ids)),
                     pa.array(np.concatenate([n, np.zeros(len(a), np.int64)])),
                     *(pa.array(np.concatenate([np.zeros(len(ids), np.int64), e]), mask=np.arange(len(ids) + len(a)) < len(ids)) for e in (a, t))],
                    names=["id", "links", "a", "b"])

    x = blocks.select(F.col("no").alias("i"), F.col("ids").alias("xi"), F.col("ns").alias("xn"), F.col("vs").alias("xv"))
    y = blocks.select(F.col("no").alias("j"), F.col("ids").alias("yi"), F.col("ns").alias("yn"), F.col("vs").alias("yv"))
    both = pairs.join(x, "i").join(y, "j").select("i", "j", "xi", "xn", "xv", "yi", "yn", "yv")
    return both.mapInArrow(compare, "id bigint, links bigint, a bigint, b bigint")


_BLOCK = "part int, seq int, ids array<bigint>, ns array<bigint>, vs binary, lo array<double>, hi array<double>"
_MERGED_PA = pa.schema([("no", pa.int32()), ("ids", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())), ("vs", pa.binary()),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))])
_BLOCK_PA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), *list(_MERGED_PA)[1:]])


def near_duplicates(vecs: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing; nor do vectors of different lengths with
    each other. Equal rows (id and vector) count as one vector; equal
    vectors of different ids link. A null id links with nothing, its
    component is null and it is not kept. Other columns are ignored.
    ``block`` vectors make a block, on average.
    """
    v = F.col(vec_col).cast("array<double>")
    src = vecs.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
    sound = (F.col("id").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False))
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0))
    src = src.withColumn("ok", F.coalesce(sound, F.lit(False)))
    keyed = checkpointed(src.select("id", "ok", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"), F.size("v").alias("dim")))
    groups = checkpointed(keyed.where("ok").select("id", "k1", "k2", "dim").distinct().groupBy("k1", "k2", "dim")
                          .agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    whole = src.where("ok").select(F.col("id").alias("rep"), "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")).dropDuplicates(["rep", "k1", "k2"])
    reps = checkpointed(whole.join(groups, ["rep", "k1", "k2"]).select(F.col("rep").alias("id"), "n", "v", "dim"))
    wire = "f4" if vecs.schema[vec_col].dataType.elementType.typeName() == "float" else "f8"
    found = None
    for r in groups.select("dim").distinct().orderBy("dim").toLocalIterator():
        one = _same_length(reps.where(F.col("dim") == r["dim"]).select("id", "n", "v"), r["dim"], cosine, wire, block)
        one = checkpointed(one.withColumn("dim", F.lit(r["dim"])))
        found = one if found is None else found.unionByName(one)
    if found is None:
        return keyed.select(F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"),
                            F.col("id").isNotNull().alias("kept"))
    links = found.where("id is not null").groupBy(F.col("id").alias("rep"), "dim").agg(F.sum("links").alias("links"))
    comp = components(found.where("a is not null").select("a", "b"))
    known = (groups.join(links, ["rep", "dim"], "left").join(comp, groups["rep"] == comp["id"], "left")
             .select("k1", "k2", "dim", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("comp"),
                     F.lit(True).alias("ok")))
    out = keyed.join(known, ["k1", "k2", "dim", "ok"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op7_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_OP7 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
c AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, e.vec_id) AS component_id, coalesce(c.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
