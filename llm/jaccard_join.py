"""N-gram Jaccard join by multiple-global-order prefix filtering.

Texts become sets of word k-shingle hashes; two documents link when
``100 * |intersection| >= percent * |union|``.

Orders. A fixed table of 2**ORDER_BITS counters, summed over all documents,
gives every shingle a rarity. Order A sorts a set by (count, hash); orders
B and C by (binary logarithm of the count, another hash). Under any order,
two linked sets share a token among their first
``n - ceil(percent * n / 100) + 1``. Candidates come from a join on the
prefix tokens of order A within length and positional bounds. They are
intersected with those of B and C: ids travel with their prefixes under both
orders, and a pair stays if it shares a token under each. Only the texts of
pairs that all three orders let through are fetched and verified.

Hot groups. Equal sets are one class, linked by their signature. For each
token shared by several classes, every member is first compared with one
pivot (the class in which the token comes earliest), which is linear in the
group; only members that stay in different components are joined with each
other. So a large group of near copies costs one comparison a member and
shared token, and still no link between different components is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.operators.lookup import salted_join
from llm.common import Bitmap, checkpointed, components, count_table, row_key, table
from llm.words import SPACED_LOWER, Words, hash_run, mix, pieces, slices

ORDER_BITS = 20
ID_BITS = 23  # 1 MB of flags, by which texts outside all candidate pairs stay in the scan
_SEED_B, _SEED_C = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_TOKEN = np.uint64((1 << 44) - 1)  # a join key of 44 bits; a clash only adds a candidate


def _sets(column: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of every text, in order."""
    for part in _parts(column, k):
        yield from part


def _parts(column: pa.Array, k: int):
    """The same by pieces of the column, so that what is made of a batch need not be held whole."""
    for at, _, w in pieces(column, SPACED_LOWER):
        yield _sets_of(at, w, k)


def _sets_of(at: int, w: Words, k: int):
    runs, first = w.runs(k), w.first
    for i in range(len(first) - 1):
        n = int(first[i + 1] - first[i])
        if n >= k:
            yield at + i, np.unique(runs[first[i]:first[i + 1] - k + 1])
        elif n:
            yield at + i, np.array([hash_run(w.hashes[first[i]:first[i + 1]])], dtype=np.uint64)
        else:
            yield at + i, np.empty(0, dtype=np.uint64)


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def _order(s: np.ndarray, rarity: np.ndarray, seed: np.uint64 | None) -> np.ndarray:
    count = rarity[(s & np.uint64(len(rarity) - 1)).astype(np.int64)]
    if seed is None:
        return s[np.lexsort((s, count))]
    return s[np.lexsort((mix(s ^ seed), np.log2(count + 1).astype(np.int8)))]


def _prefix(s: np.ndarray, rarity: np.ndarray, seed: np.uint64, percent: int) -> np.ndarray:
    """The prefix tokens of a set under order B or C, 32 bits each (a clash only lets a pair through)."""
    return (_order(s, rarity, seed)[:prefix_length(len(s), percent)] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two whole sets link."""
    if not len(x) or not len(y):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _spec(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))


def link_classes(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                 order_bits: int = ORDER_BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Words are runs of non-space bytes with A-Z lower-cased. A text of fewer
    than k words is one shingle; null, empty and blank texts have none and
    link with nothing. Rows with equal sets link at once. A null id gets a
    null component and links nothing. Repeated rows give repeated results;
    different texts under one id are each judged by their own text. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    src = _spec(docs, id_col, text_col)

    def hashes(batch):
        for part in _parts(batch["text"], k):
            yield np.concatenate([s for _, s in part])

    rarity = spark.sparkContext.broadcast(count_table(src.select("text"), order_bits, hashes).astype(np.uint32))

    def signatures(batches):
        for b in batches:
            n, hi, lo = [], [], []
            for _, s in _sets(b["text"], k):
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                n.append(len(s))
                hi.append(int.from_bytes(d[:8], "little", signed=True) if len(s) else None)
                lo.append(int.from_bytes(d[8:], "little", signed=True) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())],
                names=["id", "n", "s1", "s2"])

    sigs = checkpointed(src.mapInArrow(signatures, "id bigint, n bigint, s1 bigint, s2 bigint"))
    classes = checkpointed(sigs.where("id is not null and n > 0").groupBy("s1", "s2").agg(F.min("id").alias("rep")))

    def entries(batches):
        for b in batches:
            ids, seen = b["id"].to_pylist(), set()
            for part in _parts(b["text"], k):
                who, size, pos, tok = [], [], [], []
                for i, s in part:
                    if ids[i] is None or not len(s):
                        continue
                    key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if (key, ids[i]) in seen:
                        continue
                    seen.add((key, ids[i]))
                    p = prefix_length(len(s), percent)
                    tok.append((_order(s, rarity.value, None)[:p] & _TOKEN).astype(np.int64))
                    who.append(np.full(p, ids[i], dtype=np.int64))
                    size.append(np.full(p, len(s), dtype=np.int32))
                    pos.append(np.arange(p, dtype=np.int32))
                if tok:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tok, who, size, pos)],
                                                     names=["tok", "id", "n", "pos"])

    ent = src.mapInArrow(entries, "tok bigint, id bigint, n int, pos int")
    shared = ent.groupBy("tok").agg(F.count("*").alias("c")).where("c > 1").select("tok")
    reps = classes.select(F.col("rep").alias("id")).distinct()
    near = checkpointed(ent.join(checkpointed(shared), "tok", "left_semi").join(reps, "id", "left_semi"))
    # tokens of several classes; two of them only if they can link at all
    left = F.min(F.col("n") - F.col("pos")).cast("bigint")
    several = (near.groupBy("tok").agg(F.count("*").alias("c"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("n").alias("sum"),
                                       F.min("n").alias("least"), F.max("n").alias("most"), left.alias("left"))
               .where("lo < hi").where((F.col("c") > 2) | ((F.col("least") * 100 >= F.col("most") * percent)
                                                           & (F.col("left") * (100 + percent) >= F.col("sum") * percent))).select("tok"))
    near = checkpointed(near.join(checkpointed(several), "tok", "left_semi"))

    def among(ids: DataFrame):
        """A filter of batches by id, so that other rows stay in the scan."""
        wanted = spark.sparkContext.broadcast(Bitmap.of(ids, ID_BITS))
        return lambda b: b.filter(pa.array(np.asarray(b["id"].is_valid()) & wanted.value.may_hold(b["id"].fill_null(0).to_numpy())))

    grouped = among(near.select("id"))

    def prefixes(batches):
        for b in (part for whole in batches for part in slices(whole, "text")):
            b = grouped(b)
            ids = b["id"].to_pylist()
            for part in _parts(b["text"], k):
                who, under_b, under_c = [], [], []
                for i, s in part:
                    if len(s):
                        who.append(ids[i])
                        under_b.append(_prefix(s, rarity.value, _SEED_B, percent))
                        under_c.append(_prefix(s, rarity.value, _SEED_C, percent))
                yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(under_b, pa.list_(pa.int32())), pa.array(under_c, pa.list_(pa.int32()))],
                                                 names=["id", "under_b", "under_c"])

    orders = checkpointed(src.mapInArrow(prefixes, "id bigint, under_b array<int>, under_c array<int>"))

    def intersected(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of ids that share prefix tokens under orders B and C too."""
        def side(name):
            held = among(pairs.select(name))

            def keep(batches):
                for b in batches:
                    yield held(b)

            return orders.mapInArrow(keep, orders.schema).select(F.col("id").alias(name), F.col("under_b").alias(f"{name}_b"),
                                                                 F.col("under_c").alias(f"{name}_c"))

        both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("a_b", "b_b") & F.arrays_overlap("a_c", "b_c"))
        return checkpointed(both.select("a", "b").distinct())

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of ids whose sets pass the filters of orders B and C and then link."""
        pairs = intersected(pairs)

        def texts(side):  # whole texts of the ids on one side
            held = among(pairs.select(side))

            def keep(batches):
                for b in (part for whole in batches for part in slices(whole, "text")):
                    yield held(b)

            return src.mapInArrow(keep, "id bigint, text string").select(F.col("id").alias(side), F.col("text").alias(f"{side}_text"))

        def links(batches):
            for b in batches:
                ok = [_linked(x, y, percent) for (_, x), (_, y) in zip(_sets(b["a_text"], k), _sets(b["b_text"], k))]
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        both = pairs.join(texts("a"), "a").join(texts("b"), "b")
        return both.select("a", "b", "a_text", "b_text").mapInArrow(links, "a bigint, b bigint")

    def possible(n1: str, p1: str, n2: str, p2: str):
        """Length and positional bounds: what is left from the shared token on can still reach the overlap."""
        left = F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2)).cast("bigint")
        return ((F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)
                & (left * (100 + percent) >= percent * (F.col(n1) + F.col(n2)).cast("bigint")))

    # 1. every member of a token's group against the group's pivot
    pivot = near.groupBy("tok").agg(F.min(F.struct("pos", "id", "n")).alias("p"))
    pivot = checkpointed(pivot.select("tok", F.col("p.id").alias("pid"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp")))
    first = (near.join(pivot, "tok").where("id <> pid").where(possible("n", "pos", "pn", "pp"))
             .select(F.least("id", "pid").alias("a"), F.greatest("id", "pid").alias("b")).distinct())
    first = checkpointed(first)
    links = checkpointed(verified(first))
    # 2. members that are still in different components, against each other
    label = components(links)
    member = (near.join(label, near["id"] == label["id"], "left")
              .select("tok", near["id"], "n", "pos", F.coalesce("component", near["id"]).alias("comp")))
    member = checkpointed(member)
    open_toks = member.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("tok")
    left = member.join(checkpointed(open_toks), "tok", "left_semi")
    x = left.select("tok", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "pos", "comp")))
    y = left.select("tok", *(F.col(c).alias(f"y_{c}") for c in ("id", "n", "pos", "comp")))
    second = (x.join(y, (x["tok"] == y["tok"]) & (F.col("x_comp") < F.col("y_comp")) & possible("x_n", "x_pos", "y_n", "y_pos"))
              .select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()
              .join(first, ["a", "b"], "left_anti"))
    label = components(links.unionByName(verified(checkpointed(second))))

    named = (classes.join(label, classes["rep"] == label["id"], "left")
             .select("s1", "s2", F.coalesce("component", "rep").alias("comp")))
    return (sigs.join(named, ["s1", "s2"], "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("component_id")))


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: of each component one document stays, the one
    with the smallest id.

    A document is an id and a text: other texts under the same id are other
    documents. Of equal rows (id and text) one stays. Documents without
    words and rows with a null id have no copies; all of them stay. Columns
    are unchanged.
    """
    key = "_llm_key"
    keyed = docs.withColumn(key, F.when(F.col(id_col).isNotNull(), row_key(id_col, text_col)))
    links = checkpointed(link_classes(keyed.select(key, F.col(text_col).alias("text")), k, percent, key, "text")
                         .where("n_shingles > 0 and doc_id is not null"))
    shared = links.where("component_id <> doc_id").select("component_id").distinct()
    # never broadcast: Spark would judge the shared ids by their size before the salts multiply them
    members = checkpointed(salted_join(links.select("component_id", F.col("doc_id").alias(key)).distinct(), shared.hint("merge"),
                                       "component_id", "left_semi", force=True))
    ids = keyed.select(key, F.col(id_col).alias("_llm_id")).join(members.select(key), key, "left_semi").distinct()
    first = (members.join(ids, key).groupBy("component_id")
             .agg(F.min(F.struct(F.col("_llm_id").alias("i"), F.col(key).alias("k"))).alias("m")).select(F.col("m.k").alias(key)))
    left = keyed.join(members.select(key).join(first, key, "left_anti"), key, "left_anti")
    repeated = checkpointed(links.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("c")).where("c > 1").select(key))
    if not repeated.isEmpty():
        again = left.join(repeated, key, "left_semi").dropDuplicates([key])
        left = left.join(repeated, key, "left_anti").unionByName(again)
    return left.select(*docs.columns)


def op9_jaccard_join(spark, sf_dir):
    return link_classes(table(spark, sf_dir, "documents"), k=3, percent=90)


ORACLE_OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n, sh, hash(list_sort(sh)) AS sig FROM s),
cls AS (SELECT sig, min(doc_id) AS rep FROM n WHERE n > 0 GROUP BY sig),
t AS (SELECT doc_id, n, unnest(sh) AS g FROM n JOIN cls ON n.sig = cls.sig AND n.doc_id = cls.rep),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x),
comp AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(comp.c, cls.rep, n.doc_id) AS component_id
FROM n LEFT JOIN cls ON n.sig = cls.sig AND n.n > 0 LEFT JOIN comp ON comp.x = cls.rep
"""
