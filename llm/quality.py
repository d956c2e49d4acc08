"""Quality classifier: a sparse ensemble of rules over text statistics.

Each text becomes a row of statistics (``text_stats``). Shallow trees grown
on resampled labelled rows give conjunctive rules, one for every path from
the root to a node; a logistic model with an L1 penalty keeps few of them;
the kept rules are compiled into one Spark column expression, so scoring the
corpus needs no model object.

The model is fitted on at most ``max_rows`` labelled rows, the ones with the
smallest hash of their id; statistics are computed over whole texts of all
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import checkpointed, fold, table
from llm.words import SPACED, pieces, slices

MAX_ROWS = 20_000

STATS = ["chars", "words", "lines", "word_len", "letters", "upper", "digits", "stops", "marks", "symbols", "spaces",
         "wide", "distinct", "echo", "triples", "ending"]


def _class(pattern) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[c if isinstance(c, int) else ord(c) for c in pattern]] = True
    return out


_UPPER, _LOWER = _class(range(65, 91)), _class(range(97, 123))
_WIDE, _LEAD = _class(range(0xC0, 0x100)), _class([*range(0x80), *range(0xC0, 0x100)])
_KINDS = {"letter": _UPPER | _LOWER | _WIDE, "upper": _UPPER, "digit": _class(range(48, 58)), "stop": _class(".,;:"),
          "mark": _class("!?"), "symbol": _class("#$%&*|~^_+=<>{}[]\\/@`"), "space": _class(" \t\n\r\v\f"), "line": _class("\n"),
          "wide": _WIDE, "char": _LEAD}


def _stats(column: pa.Array) -> dict[str, np.ndarray]:
    cols = {s: [] for s in STATS}
    for _, _, w in pieces(column, SPACED):
        at = w.offsets
        n = {}
        for kind, member in _KINDS.items():
            sums = np.zeros(len(w.data) + 1, dtype=np.int64)
            np.cumsum(member[w.data], out=sums[1:])
            n[kind] = (sums[at[1:]] - sums[at[:-1]]).astype(float)
        words, chars = w.counts().astype(float), np.maximum(n["char"], 1)
        doc = w.doc_of()
        distinct, echo, triples = (np.zeros(len(words)) for _ in range(3))
        runs = w.runs(3)
        for i in range(len(words)):
            a, z = int(w.first[i]), int(w.first[i + 1])
            if z > a:
                distinct[i] = len(np.unique(w.hashes[a:z])) / (z - a)
                echo[i] = (w.hashes[a:z - 1] == w.hashes[a + 1:z]).sum() / (z - a)
            if z - a >= 3:
                triples[i] = len(np.unique(runs[a:z - 2])) / (z - a - 2)
        last = np.append(w.starts[1:], len(w.data)) - 1  # last byte before the next word
        ends = np.zeros(len(words))
        if len(doc):
            tail = w.data[np.maximum(last - 1, 0)]
            np.add.at(ends, doc, ~_KINDS["letter"][tail] & ~_KINDS["digit"][tail] & (tail < 0x80))
        word_n = np.maximum(words, 1)
        new = {"chars": np.log1p(n["char"]), "words": np.log1p(words), "lines": n["line"] / word_n,
               "word_len": (n["char"] - n["space"]) / word_n, "letters": n["letter"] / chars,
               "upper": n["upper"] / np.maximum(n["letter"], 1), "digits": n["digit"] / chars, "stops": n["stop"] / word_n,
               "marks": n["mark"] / word_n, "symbols": n["symbol"] / word_n, "spaces": n["space"] / chars, "wide": n["wide"] / chars,
               "distinct": distinct, "echo": echo, "triples": triples, "ending": ends / word_n}
        for s in STATS:
            cols[s].append(new[s])
    return {s: np.concatenate(c) if c else np.empty(0) for s, c in cols.items()}


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one double per statistic) of every whole text; null counts as empty."""

    def run(batches):
        for b in batches:
            s = _stats(b["text"])
            yield pa.RecordBatch.from_arrays([b["id"], *(pa.array(s[c]) for c in STATS)], names=["id", *STATS])

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id bigint, " + ", ".join(f"{s} double" for s in STATS))


@dataclass(frozen=True)
class Rules:
    """``score = sigmoid(base + sum of weights of the rules that hold)``; a rule is
    a tuple of (statistic, is_greater, threshold)."""

    base: float
    rules: tuple[tuple[tuple[tuple[str, bool, float], ...], float], ...]

    def column(self, prefix: str = "") -> Column:
        """The model as a Spark expression over the statistics' columns."""
        total = F.lit(self.base)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for stat, greater, cut in conditions:
                holds &= (F.col(prefix + stat) > cut) if greater else (F.col(prefix + stat) <= cut)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(x, y, rng, depth: int, leaf: int):
    """Rules of one tree: at every node the best Gini split over a random half of the statistics."""
    out, todo = [], [(np.arange(len(y)), (), 0)]
    while todo:
        rows, path, d = todo.pop()
        if path:
            out.append(path)
        if d == depth or len(rows) < 2 * leaf or y[rows].min() == y[rows].max():
            continue
        best = (1e-9, None, None)
        p = y[rows].mean()
        for f in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            o = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows[o], f], np.cumsum(y[rows[o]])
            n = np.arange(1, len(rows) + 1)
            ok = np.flatnonzero((v[:-1] < v[1:]) & (n[:-1] >= leaf) & (len(rows) - n[:-1] >= leaf))
            if not len(ok):
                continue
            left, right = t[ok] / n[ok], (t[-1] - t[ok]) / (len(rows) - n[ok])
            gain = p * (1 - p) - (n[ok] * left * (1 - left) + (len(rows) - n[ok]) * right * (1 - right)) / len(rows)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], f, (v[ok[i]] + v[ok[i] + 1]) / 2)
        _, f, cut = best
        if f is None:
            continue
        low = x[rows, f] <= cut
        todo.append((rows[low], (*path, (int(f), False, float(cut))), d + 1))
        todo.append((rows[~low], (*path, (int(f), True, float(cut))), d + 1))
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 2e-3, seed: int = 7) -> Rules:
    """Rules from trees on bootstrap rows, weighted by lasso logistic regression
    (accelerated proximal gradient). With one class or no rows, the smoothed base rate."""
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    if len(y) < 4 or y.min() == y.max():
        return Rules(base, ())
    rng = np.random.default_rng(seed)
    found: dict = {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        for path in _paths(x[rows], y[rows], rng, depth, max(2, len(rows) // 200)):
            found.setdefault(path)
    paths = list(found)
    if not paths:
        return Rules(base, ())
    seen, kept = set(), []
    for path in paths:  # of rules that hold on the same rows, the first
        hold = np.ones(len(y), dtype=bool)
        for f, greater, cut in path:
            hold &= (x[:, f] > cut) == greater
        key = np.packbits(hold).tobytes()
        if key not in seen:
            seen.add(key)
            kept.append((path, hold))
    paths, z = [path for path, _ in kept], np.empty((len(y), len(kept)))
    for j, (_, hold) in enumerate(kept):
        z[:, j] = hold
    mean, scale = z.mean(0), np.array([max(hold.std(), 0.05) for _, hold in kept])
    del kept, seen
    z -= mean
    z /= scale  # the only matrix of rows and rules: this runs in the driver
    step = 4 * len(y) / max(float(np.linalg.eigvalsh(z.T @ z)[-1]), 1e-9)
    w = v = np.zeros(len(paths))
    b, t = base, 1.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-(z @ v + b)))
        b -= float((p - y).mean()) * 2
        new = v - step * (z.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    weights = w / scale
    kept = np.flatnonzero(w)
    return Rules(float(b - (weights * mean).sum()),
                 tuple((tuple((STATS[f], g, c) for f, g, c in paths[j]), float(weights[j])) for j in kept))


def fit_quality(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                max_rows: int = MAX_ROWS) -> Rules:
    """Fit on at most ``max_rows`` rows of ``stats`` that have a label, drawn by a
    hash of id and statistics; rows far beyond the last one drawn stay where they are read.

    Several labels of one id count as their majority (a tie as 1); null
    labels and ids are left out.
    """
    known = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("double").alias("label"))
             .where("id is not null and label is not null").groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    reach = 1.2 * max_rows * (1 << 30) / max(known.count(), 1)
    rows = (stats.join(known, "id").withColumn("_order", F.pmod(F.xxhash64("id", *STATS), F.lit(1 << 30)))
            .where(F.col("_order") < F.lit(reach)).orderBy("_order", "id", *STATS).limit(max_rows).select(*STATS, "label").toArrow())
    x = np.column_stack([rows[s].to_numpy() for s in STATS]) if rows.num_rows else np.zeros((0, len(STATS)))
    return fit_rules(x, rows["label"].to_numpy().astype(float))


def score_quality(docs: DataFrame, labels: DataFrame, train_where: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.7, max_rows: int = MAX_ROWS) -> DataFrame:
    """(id, score, predicted), one row per input row.

    ``train_where`` is a condition over ``id`` that says whose labels may be
    learned. Null and empty texts get the score of their statistics (all 0).
    Repeated rows give repeated results, a null id is scored and never
    learned; without labels every score is 0.5. Other columns are ignored.
    """
    stats = checkpointed(text_stats(docs, id_col, text_col))
    model = fit_quality(stats.where(train_where), labels, label_col, id_col, max_rows)
    scored = stats.select("id", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, train_where: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.7, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns as they are.

    One scan fits the model, a second one scores and filters rows where they
    are read, so no text is shuffled. Cases as in ``score_quality``.
    """
    model = fit_quality(text_stats(docs, id_col, text_col).where(train_where), labels, label_col, id_col, max_rows)
    at = docs.columns.index(text_col)
    prefix = "_llm_stat_"

    def run(batches):
        for b in (part for whole in batches for part in slices(whole, at)):
            s = _stats(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(s[c]) for c in STATS)],
                                             names=[*b.schema.names, *(prefix + c for c in STATS)])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + s, T.DoubleType()) for s in STATS)])
    return docs.mapInArrow(run, schema).where(model.column(prefix) >= threshold).select(*docs.columns)


def op6_quality(spark, sf_dir):
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("id", 4) != 2)
    return scored.select(F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "score", "predicted")
