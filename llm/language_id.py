"""Language ID by nearest centroid.

A text is a vector over hashed n-grams of its lower-cased bytes (1 to 3, all
non-letters one space), weighted by log(1 + count) times the inverse document
frequency and normalised. Every language gets several centroids from
spherical k-means; a text takes the language of the centroid with the
highest cosine, and is rejected when it is farther from it than nearly all
of that centroid's own members.

Document frequencies count all rows that may be learned from. Centroids are
fitted on at most ``per_lang`` of them for each language, those with the
smallest hash of their id. The model is (languages x centroids x 2**BITS)
floats and goes to the tasks by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import count_table, fold, table

BITS = 12
PER_LANG = 1500
CENTROIDS = 4

_SPACE = np.ones(256, dtype=bool)  # bytes that stand for a space
_SPACE[97:123] = False
_SPACE[128:] = False


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte 1- to 3-grams."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)
    gap = _SPACE[b]
    b = np.where(gap, np.uint8(32), b)[~(gap & np.concatenate([[False], gap[:-1]]))].astype(np.uint32)
    out = np.zeros(1 << BITS, dtype=np.int64)
    gram = b
    for n in range(3):
        h = (gram * np.uint32(2654435761) + np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        out += np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
        if len(gram) < 2:
            break
        gram = gram[:-1] * np.uint32(256) + b[n + 1:]
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    n = np.linalg.norm(v)
    return v / n if n else v


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    reach: np.ndarray  # the lowest cosine that is not rejected

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected); ``und`` without a letter or a language."""
        if not self.langs or not has_letter(text):
            return "und", 0.0, True
        cos = self.centroids @ weighted(ngram_counts(text), self.idf)
        i = int(np.argmax(cos))
        return self.langs[i], float(min(max(cos[i], 0.0), 1.0)), bool(cos[i] < self.reach[i])


def cluster(x: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first members; (centroids, place of each row)."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen].copy()
    for _ in range(rounds):
        at = np.argmax(x @ c.T, axis=1)
        new = np.stack([x[at == j].sum(0) if (at == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c):
            break
        c = new
    return c, np.argmax(x @ c.T, axis=1)


def sampled(rows: DataFrame, sizes: list[tuple[str, int]], per_lang: int) -> DataFrame:
    """(lang, text, _order): about 1.2 times ``per_lang`` rows of each language, equal
    rows once. They are drawn by a hash of id and text, so neither many null
    ids nor one id with many texts come as a whole. ``sizes`` has one row a
    language, as few as the model has; it is broadcast, so that texts outside the sample are not shuffled."""
    per = F.broadcast(rows.sparkSession.createDataFrame(sizes, "lang string, n bigint"))
    drawn = (rows.withColumn("_order", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))).join(per, "lang")
             .where(F.col("_order") < F.ceil(F.lit(1.2 * per_lang * (1 << 30)) / F.col("n"))))
    return drawn.select("lang", "text", "_order").distinct()


def fit(rows: DataFrame, centroids: int = CENTROIDS, per_lang: int = PER_LANG, reject: float = 0.005) -> Model:
    """Learn from (id, text, lang); rows without a language, a text or a letter
    teach nothing. ``reject`` is the part of a centroid's own members that lies
    beyond its reach."""
    rows = rows.where("lang is not null and text is not null and text rlike '\\\\p{L}'")

    def grams(batch):
        for text in batch["text"].to_pylist():
            yield np.flatnonzero(ngram_counts(text)).astype(np.uint64)

    df = count_table(rows.select("text"), BITS, grams)
    sizes = [(r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()]
    n = sum(k for _, k in sizes)
    idf = np.log((1 + n) / (1 + df)) + 1
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def centre(t: pa.Table) -> pa.Table:
        t = t.sort_by([("_order", "ascending"), ("text", "ascending")]).slice(0, per_lang)
        x = np.stack([weighted(ngram_counts(s), shared.value) for s in t["text"].to_pylist()]).astype(np.float32)
        c, at = cluster(x, centroids)
        cos = (x * c[at]).sum(1)
        found = [j for j in range(len(c)) if (at == j).any()]
        return pa.table({"lang": [t["lang"][0].as_py()] * len(found), "centroid": pa.array([c[j] for j in found], pa.list_(pa.float32())),
                         "reach": pa.array([float(np.quantile(cos[at == j], reject)) for j in found], pa.float64())})

    found = sampled(rows, sizes, per_lang).groupBy("lang").applyInArrow(centre, "lang string, centroid array<float>, reach double")
    out = sorted(found.toArrow().to_pylist(), key=lambda r: (r["lang"], r["centroid"]))
    return Model(idf, [r["lang"] for r in out], np.array([r["centroid"] for r in out]).reshape(len(out), 1 << BITS), np.array([r["reach"] for r in out]))


def identify(docs: DataFrame, train_where: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(id, lang_pred, score, rejected), one row per input row.

    Learned from the rows of ``docs`` where ``train_where`` (a condition over
    ``id``) holds. ``und``, score 0 and rejected for texts that are null or
    without a letter, and for all texts if no language was learned. Rejected
    texts still tell the nearest language. Ties go to the first language in
    order of name. Null ids and repeated rows are kept; other columns are
    ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(src.where(train_where), **how))

    def run(batches):
        for b in batches:
            lang, score, out = zip(*map(model.value.classify, b["text"].to_pylist())) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                                             names=["id", "lang_pred", "score", "rejected"])

    return src.select("id", "text").mapInArrow(run, "id bigint, lang_pred string, score double, rejected boolean")


def op1_language_id(spark, sf_dir):
    found = identify(table(spark, sf_dir, "documents"), fold("id", 5) != 0)
    return found.select(F.col("id").alias("doc_id"), (fold("id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")
