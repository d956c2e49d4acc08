"""Substring dedup by a relative Lempel-Ziv parse.

Documents that a scan task reads one after the other, up to about
``BLOCK_WORDS`` words, are a *reference block* with an index of its own: the hash of each seed (``window`` consecutive words) to
the block's earliest (doc_id, place). A block's seeds are dealt out by an
anchor of the seed, the smallest hash among its short runs of words, so that
neighbouring seeds travel together; a bucket thus sees one entry of each
block for a seed, and finds the earliest place over every indexed block.

Factors are then parsed greedily: a factor starts at a word whose seed
occurs earlier, in a document with a smaller id, and extends over the words
while the next seed's earliest place is the next place of the same source;
its length is a seed at least. Where it ends, the seeds that start in its
last words and run over its boundary are looked up like any other, so a
match across a boundary opens a factor that overlaps the last one. Words
covered by factors are duplicate spans; all others are literals.

Hot anchors: a short phrase that stands in very many documents, between
other words each time, is the anchor of very many different seeds. Anchors
are counted over all documents in 2**ANCHOR_BITS counters; the seeds of a
counter beyond ``1 / SPLIT`` of a bucket are dealt out by anchor and seed, in
as many parts as it takes. Equal seeds still meet, so results are the same.

Hot groups: within a block only the smallest document id of a seed asks the
buckets; the block itself knows the answer for all others. A seed that
stands in a third of all rows brings one entry a block to its bucket. The
number of buckets follows the number of characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import count_table, table
from llm.words import SPACED, Words, mix, pieces

ANCHOR_WORDS = 4
BUCKET_CHARS = 8_000_000  # characters of text behind a bucket, on average
ANCHOR_BITS = 18
SPLIT = 4  # an anchor's seeds are split beyond this part of a bucket
BLOCK_WORDS = 1_000_000  # words after which a reference block is closed

KNOWN = 10_000  # factors a block already knows that travel in one row
_SPAN = "array<struct<id:bigint,key:bigint,start:int,n:int,src:bigint,at:int>>"
_SPAN_PA = pa.list_(pa.struct([("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("src", pa.int64()), ("at", pa.int32())]))


def _anchor(w: Words, window: int) -> np.ndarray:
    """The smallest hash of ``ANCHOR_WORDS`` words within the window from each word on."""
    k = min(ANCHOR_WORDS, window)
    r = w.runs(k)
    n = max(len(w.hashes) - window + 1, 0)
    low = r[:n].copy()
    for i in range(1, window - k + 1):
        np.minimum(low, r[i:i + n], out=low)
    return low


def _parts(counts: np.ndarray, buckets: int) -> np.ndarray:
    """In how many parts the seeds of each anchor counter are dealt out: one, but
    for counters of more than ``1 / SPLIT`` of an average bucket and far above
    the average counter."""
    share = max(counts.sum() / buckets / SPLIT, 1)
    hot = (counts > share) & (counts > 8 * counts.mean())
    return np.where(hot, np.ceil(counts / share), 1).astype(np.int32)


def _buckets(anchor: np.ndarray, seed: np.ndarray, parts: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every seed: by its anchor, of split anchors by part too."""
    n = parts[(anchor & np.uint64(len(parts) - 1)).astype(np.int64)].astype(np.uint64)
    part = mix(seed) % n
    return (np.where(part > 0, mix(anchor + part), anchor) % np.uint64(buckets)).astype(np.int64)


def _factors(doc, pos, src, at) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors over looked-up seeds in (doc, pos) order: the first seed of
    each factor and the number of its seeds."""
    goes_on = (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1] + 1) & (src[1:] == src[:-1]) & (at[1:] == at[:-1] + 1)
    begins = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(doc) else np.empty(0, dtype=np.int64)
    return begins, np.diff(np.append(begins, len(doc)))


def _flat(ids, keys, doc, pos, src, at, window) -> dict[str, pa.Array]:
    """Factors of looked-up seeds, one row each; ``doc`` indexes ids and keys."""
    o = np.lexsort((pos, doc))
    doc, pos, src, at = doc[o], pos[o], src[o], at[o]
    b, n = _factors(doc, pos, src, at)
    return {"id": pa.array(ids[doc[b]]), "key": pa.array(keys[doc[b]]), "start": pa.array(pos[b].astype(np.int32)),
            "n": pa.array((n + window - 1).astype(np.int32)), "src": pa.array(src[b]), "at": pa.array(at[b].astype(np.int32))}


def factors(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
            bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """(id, key, start, n, src, at): factors of n words, with source document and place.

    ``key`` is a hash of the text's words, so rows of one id with different
    texts keep their own factors.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chars = src.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    buckets = int(max(16, chars // bucket_chars))

    def anchors(batch):
        for _, _, w in pieces(batch["text"], SPACED):
            yield _anchor(w, window)[w.run_ok(window)]

    parts = spark.sparkContext.broadcast(_parts(count_table(src.select("text"), ANCHOR_BITS, anchors), buckets))

    def index(batches):
        for b in batches:
            valid = np.asarray(b["id"].is_valid())
            ids = np.where(valid, b["id"].to_numpy(zero_copy_only=False), 0).astype(np.int64)
            held, words = [], 0
            for lo, hi, w in pieces(b["text"], SPACED):
                r = w.runs(window)
                doc = w.doc_of()[:len(r)]
                ok = w.run_ok(window) & valid[lo:hi][doc]
                at = doc[ok]
                held.append((lo, hi, w.whole().astype(np.int64), r[ok], _anchor(w, window)[ok], (at + lo).astype(np.int32),
                             (np.flatnonzero(ok) - w.first[at]).astype(np.int32)))
                words += len(w.hashes)
                if words >= BLOCK_WORDS:
                    yield from block(ids, held)
                    held, words = [], 0
            if held:
                yield from block(ids, held)

    def block(all_ids, held):
        first_row = held[0][0]
        ids = all_ids[first_row:held[-1][1]]
        keys, h, a, d, p = (np.concatenate([x[i] for x in held]) for i in range(2, 7))
        d -= first_row
        # the block's index: the earliest (id, place) of every seed
        rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        o = np.lexsort((p, rank[d], h))
        first = np.concatenate([[True], h[o][1:] != h[o][:-1]]) if len(o) else np.empty(0, dtype=bool)
        lead = np.empty(len(o), dtype=np.int64)
        lead[o] = o[np.flatnonzero(first)][np.cumsum(first) - 1]
        known = ids[d[lead]] < ids[d]
        if known.any():
            x = np.flatnonzero(known)
            row = _flat(ids, keys, d[x], p[x], ids[d[lead[x]]], p[lead[x]], window)
            known_spans = pa.StructArray.from_arrays(list(row.values()), names=list(row))
            for at in range(0, len(known_spans), KNOWN):
                part = known_spans.slice(at, KNOWN)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([int(h[at % len(h)] % np.uint64(buckets))], pa.int32()),
                    "spans": pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part),
                    **{c: pa.nulls(1, pa.binary()) for c in ("hash", "doc", "pos", "len")},
                    "ids": pa.nulls(1, pa.list_(pa.int64())), "keys": pa.nulls(1, pa.list_(pa.int64()))}, schema=_INDEX_PA)
        ask = np.flatnonzero(~known)
        where = _buckets(a[ask], h[ask], parts.value, buckets)
        o = np.argsort(where, kind="stable")
        ask, where = ask[o], where[o]
        for c in np.split(np.arange(len(ask)), np.flatnonzero(np.diff(where)) + 1) if len(ask) else ():
            e = ask[c]
            used, local = np.unique(d[e], return_inverse=True)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([int(where[c[0]])], pa.int32()), "spans": pa.nulls(1, _SPAN_PA), "hash": [h[e].tobytes()], **_runs(local, p[e]),
                "ids": pa.array([ids[used]], pa.list_(pa.int64())),
                "keys": pa.array([keys[used]], pa.list_(pa.int64()))}, schema=_INDEX_PA)

    def look_up(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        out = []
        known = t.filter(t["spans"].is_valid())
        if known.num_rows:
            flat = known["spans"].combine_chunks().flatten()
            out.append(pa.table([flat.field(c) for c in _OUT_PA.names], schema=_OUT_PA))
        t = t.filter(t["hash"].is_valid())
        if t.num_rows:
            H, D, P, I, K, base = [], [], [], [], [], 0
            for hb, doc, pos, n, ids, keys in zip(*(t[c] for c in ("hash", "doc", "pos", "len", "ids", "keys"))):
                doc, pos = _places(doc.as_py(), pos.as_py(), n.as_py())
                H.append(np.frombuffer(hb.as_py(), dtype=np.uint64))
                D.append(doc + base)
                P.append(pos)
                I.append(ids.values.to_numpy())
                K.append(keys.values.to_numpy())
                base += len(I[-1])
            h, d, p, ids, keys = (np.concatenate(x) for x in (H, D, P, I, K))
            o = np.lexsort((p, ids[d], h))
            first = np.concatenate([[True], h[o][1:] != h[o][:-1]])
            lead = o[np.flatnonzero(first)][np.cumsum(first) - 1]
            late = ids[d[lead]] < ids[d[o]]
            x, lead = o[late], lead[late]
            if len(x):
                out.append(pa.table(_flat(ids, keys, d[x], p[x], ids[d[lead]], p[lead], window), schema=_OUT_PA))
        return pa.concat_tables(out) if out else _OUT_PA.empty_table()

    asked = src.mapInArrow(index, _INDEX)
    return asked.groupBy("bucket").applyInArrow(look_up, "id bigint, key bigint, start int, n int, src bigint, at int")


def _runs(doc: np.ndarray, pos: np.ndarray) -> dict:
    """Places as runs of neighbouring words: text, first word, length (up to 255)."""
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)])
    at = np.arange(len(doc))
    new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % 255 == 0
    starts = np.flatnonzero(new)
    return {"doc": [doc[starts].astype(np.int32).tobytes()], "pos": [pos[starts].astype(np.int32).tobytes()],
            "len": [np.diff(np.append(starts, len(doc))).astype(np.uint8).tobytes()]}


def _places(doc: bytes, pos: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The (text, word) of every place of ``_runs``."""
    n = np.frombuffer(n, dtype=np.uint8).astype(np.int64)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.frombuffer(doc, dtype=np.int32).astype(np.int64), n), (np.repeat(np.frombuffer(pos, dtype=np.int32), n) + within).astype(np.int32)


_INDEX = f"bucket int, spans {_SPAN}, hash binary, doc binary, pos binary, len binary, ids array<bigint>, keys array<bigint>"
_INDEX_PA = pa.schema([("bucket", pa.int32()), ("spans", _SPAN_PA), ("hash", pa.binary()), ("doc", pa.binary()), ("pos", pa.binary()),
                       ("len", pa.binary()), ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))])
_OUT_PA = pa.schema(list(_SPAN_PA.value_type))


def strip_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans): documents without the
    words of repeats; ``spans`` are the merged word ranges [start, end).

    Words are runs of non-space bytes, unchanged. Null, empty and blank texts
    have no words and keep the empty text. A null id is neither a source nor
    stripped. Rows of one id never count as each other's sources; repeated
    rows give repeated results. Texts shorter than a window stay whole. Other
    columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def key(batches):
        for b in batches:
            out = [w.whole() for _, _, w in pieces(b["text"], SPACED)]
            k = np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(k), b["text"]], names=["id", "key", "text"])

    found = (factors(docs, window, id_col, text_col).groupBy("id", "key")
             .agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    both = src.mapInArrow(key, "id bigint, key bigint, text string").join(found, ["id", "key"], "left")

    def cut(batches):
        for b in batches:
            total, gone, kept, ranges = [], [], [], []
            for text, spans in zip(b["text"].to_pylist(), b["spans"].to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                merged = []
                for s in sorted((x["start"], x["start"] + x["n"]) for x in spans or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                at, left = 0, []
                for s, e in merged:
                    left += words[at:s]
                    at = e
                left += words[at:]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                ranges.append(merged)
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(ranges, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    return both.select("id", "text", "spans").mapInArrow(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, spans array<array<int>>")


def op3_substring_dedup(spark, sf_dir):
    kept = strip_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_OP3 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
m AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN m USING (g) WHERE low < doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d),
k AS (SELECT w.doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY w.pos) FILTER (gone.pos IS NULL) AS kept
      FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.pos = gone.pos GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
