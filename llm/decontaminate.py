"""Benchmark decontamination as a prefix-filtered set join.

Words are lower-cased runs of ASCII letters, digits and characters beyond
ASCII. Every item contributes its windows of ``window`` consecutive words (an
item of fewer words is one window). A document contains a window only if it
contains all of its words, so for containment 1 the necessary prefix of a
window under a rarity order is its single rarest word. Rarity is a
fixed-size table of word counts over all documents.

Only document words that may be some window's prefix word leave the scan
task: a bitmap of fixed size tells. Each goes with its place, the length of
its text and the words around it, to a Spark join with the windows on the
prefix word. Length and positional bounds drop windows that would begin
before the text or end after it; word-by-word comparison over the item-sized
window confirms the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Bitmap, checkpointed, count_table, table
from llm.words import ALNUM, pieces

RARITY_BITS = 18
BITMAP_BITS = 22  # 512 KB, whatever the benchmark's size


def item_windows(items: DataFrame, rarity, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id string, words array, key, at): each item's distinct windows; ``at``
    is the place of the rarest word, ``key``, within the window."""

    def cut(batches):
        for b in batches:
            ids = b["item_id"].to_pylist()
            who, words, key, at = [], [], [], []
            for lo, _, w in pieces(b["text"], ALNUM):
                counts = rarity.value[(w.hashes & np.uint64(len(rarity.value) - 1)).astype(np.int64)]
                for i in range(len(w.first) - 1):
                    a, z = int(w.first[i]), int(w.first[i + 1])
                    size = min(window, z - a)
                    for s in range(a, z - size + 1) if size else ():
                        p = int(np.lexsort((w.hashes[s:s + size], counts[s:s + size]))[0])
                        who.append(ids[lo + i])
                        words.append(w.hashes[s:s + size].astype(np.int64))
                        key.append(words[-1][p])
                        at.append(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(who, pa.string()), pa.array(words, pa.list_(pa.int64())), pa.array(key, pa.int64()), pa.array(at, pa.int32())],
                names=["item_id", "words", "key", "at"])

    src = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(cut, "item_id string, words array<bigint>, key bigint, at int").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    One row per input row, repeated ones too; a null id is an id like any other.
    Null, empty and wordless texts have no words and no hits; wordless items
    no windows. Items with equal windows all count. Without items nothing is
    hit. Items with a null id are not counted by id, their windows still
    hit. Other columns are ignored.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def hashes(batch):
        for _, _, w in pieces(batch["text"], ALNUM):
            yield w.hashes

    rarity = spark.sparkContext.broadcast(count_table(src.select("text"), RARITY_BITS, hashes).astype(np.uint32))
    windows = checkpointed(item_windows(items, rarity, window, item_id, item_text))

    bitmap = spark.sparkContext.broadcast(Bitmap.of(windows.select("key"), BITMAP_BITS))
    around = 2 * window - 1

    def candidates(batches):
        row = 0
        for b in batches:
            for lo, hi, w in pieces(b["text"], ALNUM):
                at = np.flatnonzero(bitmap.value.may_hold(w.hashes))
                doc = np.searchsorted(w.first, at, side="right") - 1
                padded = np.concatenate([np.zeros(window - 1, np.uint64), w.hashes, np.zeros(window - 1, np.uint64)]).astype(np.int64)
                ctx = padded[at[:, None] + np.arange(around)]
                offsets = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays(
                    [pa.array(w.hashes[at].astype(np.int64)), pa.array((at - w.first[doc]).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * around), pa.array(ctx.ravel()))],
                    names=["key", "pos", "ctx"])
                n = w.counts()
                rows, row = np.arange(row, row + hi - lo), row + hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), b["id"].slice(lo, hi - lo), pa.array(w.whole().astype(np.int64)), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), found)], names=["row", "id", "text_key", "n_words", "found"])

    schema = "row bigint, id bigint, text_key bigint, n_words bigint, found array<struct<key:bigint,pos:int,ctx:array<bigint>>>"
    scan = src.mapInArrow(candidates, schema)
    # every row also gets an entry without a place: a key of its own that fits no window
    none = F.array(F.lit(None).cast("struct<key:bigint,pos:int,ctx:array<bigint>>"))
    one = scan.select("row", "id", "text_key", "n_words", F.explode(F.concat(none, "found")).alias("f"))
    one = one.select("id", "text_key", "n_words", F.col("f.pos").alias("pos"), F.col("f.ctx").alias("ctx"),
                     F.coalesce(F.col("f.key"), F.xxhash64("row", "id", "text_key")).alias("key"))
    size = F.size("words")
    start = F.col("pos") - F.col("at")
    fits = ((one["key"] == windows["key"]) & (start >= 0) & (start + size <= F.col("n_words"))
            & (F.slice("ctx", F.lit(window) - F.col("at"), size) == F.col("words")))
    hit = one.join(windows, fits, "left").select("id", "text_key", "n_words", "item_id", F.col("pos").isNull().alias("whole"), F.when(F.col("words").isNotNull(), start).alias("start"), size.alias("len"))
    per = hit.groupBy("id", "text_key", "n_words").agg(
        F.count_if("whole").alias("rows"), F.collect_set("item_id").alias("items"), F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"))
    spans = F.filter("spans", lambda s: s["start"].isNotNull())
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(acc["end"], s["start"]))).cast("bigint").alias("n"),
            F.greatest(acc["end"], s["start"] + s["len"]).alias("end")))["n"]
    # equal rows were one group: as many again, a bounded array at a time
    per = per.select("*", covered.alias("n_hit"), F.explode(F.expr("sequence(0, rows - 1, 10000)")).alias("at"))
    per = per.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(10_000), F.col("rows") - F.col("at")).cast("int"))))
    return per.select(F.col("id").alias("doc_id"), "n_words", "n_hit",
                      F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                      (F.size(spans) > 0).alias("contaminated"))


def op10_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_OP10 = r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM documents, low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM benchmark, low),
bw AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g, least(10, len(ws)) AS n
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, ns WHERE len(ws) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
