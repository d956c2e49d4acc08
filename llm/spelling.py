"""Spelling variants by dense prefix-suffix tiling.

Two words are one inserted, deleted or replaced code point apart exactly if
their common prefix and common suffix together reach the longer length minus
one. So one of the two reaches half of it: every word is dealt to the groups
of its first and of its last half, for its own length and the one above, and
near words meet in at least one of them.

Within a group words are rows of padded code-point matrices, aligned left for
prefixes and right for suffixes, and whole tiles are compared column by
column. A group of more than ``TILE`` words is cut to blocks by a hash, and
every pair of its blocks is a unit of work of its own, dealt by Spark. Pairs
never leave a tile: a word takes its number of near words and the best of
them along. A pair that shares both halves counts in the prefix group only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.operators.lookup import salted_join
from llm.common import checkpointed, table

TILE = 512
HOT_ROWS = 100_000  # rows of the list of large groups that are broadcast at most

LETTERS = "[A-Za-zÀ-ÿ]"


def vocabulary(docs: DataFrame, min_len: int = 6, min_count: int = 5, id_col: str = "doc_id", text_col: str = "text", edit=None) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z in lower case, with at least
    ``min_len`` code points and ``min_count`` occurrences over all rows.

    ``edit(id, run)`` may change each run (both columns). Null and empty
    texts have no words, a null id is the empty text; repeated rows count
    again; other columns are ignored.
    """
    # a shorter run cannot become longer: a match of {min_len,} is a whole run
    runs = F.regexp_extract_all(F.col(text_col), F.lit(LETTERS + "{%d,}" % min_len), F.lit(0))
    one = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    one = one.withColumn("run", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = one.select((edit(F.col("id"), F.col("run")) if edit else F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_len).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _near(x: list[str], y: list[str], width: int, suffix_group: bool) -> np.ndarray:
    """Which words of x and y, of ``width`` or one code point less, are one edit apart."""

    def matrices(words):
        size = np.array([len(w) for w in words])
        left = np.zeros((len(words), width), np.uint32)
        right = np.zeros((len(words), width), np.uint32)
        for n in (width, width - 1):
            at = size == n
            if at.any():
                codes = np.frombuffer("".join(w for w in words if len(w) == n).encode("utf-32-le"), np.uint32).reshape(-1, n)
                left[at, :n], right[at, width - n:] = codes, codes
        return left, right, size < width

    xl, xr, x_short = matrices(x)
    yl, yr, y_short = (xl, xr, x_short) if y is x else matrices(y)

    def common(a, b, columns):
        alive, n = np.ones((len(a), len(b)), bool), np.zeros((len(a), len(b)), np.int32)
        for j in columns:
            alive &= a[:, j, None] == b[None, :, j]
            if not alive.any():
                break
            n += alive
        return n

    prefix = common(xl, yl, range(width))
    near = (prefix + common(xr, yr, reversed(range(width))) >= width - 1) & ~(x_short[:, None] & y_short[None, :])
    near &= prefix < width  # not the word itself
    if suffix_group:
        near &= prefix < width // 2
    return near


def _best(near: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of near words of each row and the column of the best: largest n, then first."""
    return near.sum(axis=1), np.where(near, n[None, :], -1).argmax(axis=1)


def _compared(units: DataFrame) -> DataFrame:
    """(word, n_near, neg_n, form) of rows sorted by unit."""

    def unit(width, side, lo, hi, words, ns, blocks):
        """Rows of one unit: a block with itself, or two blocks with each other."""
        if len(words) < 2 or max(map(len, words)) < width:
            return
        order = sorted(range(len(words)), key=words.__getitem__)
        words, n, block = [words[i] for i in order], np.array([ns[i] for i in order]), np.array([blocks[i] for i in order])
        a = np.flatnonzero(block == lo)
        b = a if lo == hi else np.flatnonzero(block == hi)
        x = [words[i] for i in a]
        y = x if lo == hi else [words[i] for i in b]
        if not x or not y:
            return
        near = _near(x, y, width, side == "s")
        for mine, theirs, hit in ((a, b, near),) if lo == hi else ((a, b, near), (b, a, near.T)):
            count, best = _best(hit, n[theirs])
            for i in np.flatnonzero(count):
                yield words[mine[i]], int(count[i]), -int(n[theirs[best[i]]]), words[theirs[best[i]]]

    def run(batches):
        key, held = None, ([], [], [])
        out = []

        def flush():
            if key is not None:
                out.extend(unit(key[1], key[0], key[3], key[4], *held))

        for b in batches:
            for *k, word, n, block in zip(*(b[c].to_pylist() for c in ("side", "width", "part", "lo", "hi", "word", "n", "block"))):
                if k != key:
                    flush()
                    key, held = k, ([], [], [])
                for to, v in zip(held, (word, n, block)):
                    to.append(v)
            if len(out) >= 5_000:
                yield _batch(out)
                out.clear()
        flush()
        if out:
            yield _batch(out)

    return units.mapInArrow(run, "word string, n_near bigint, neg_n bigint, form string")


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                      names=["word", "n_near", "neg_n", "form"])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): for every word of (word, n) that has words one
    edit away, their number and the one of largest n (ties: smallest). Words
    are distinct, not null and not empty."""
    size = F.length("word")
    key = ["side", "width", "part"]
    dealt = words.select("word", "n", F.explode(F.array(*(
        F.struct(F.lit(side).alias("side"), (size + more).alias("width"), part.alias("part"))
        for more in (0, 1)
        for half in [((size + more) / 2).cast("int")]
        for side, part in (("p", F.substring(F.col("word"), F.lit(1), half)), ("s", F.right("word", half)))))).alias("k")
    ).select("word", "n", "k.*")
    large = checkpointed(dealt.groupBy(*key).count().where(F.col("count") > tile)
                         .select(*key, F.ceil(F.col("count") / tile).cast("int").alias("blocks")))
    n_large = large.count()
    if n_large:
        dealt = dealt.join(F.broadcast(large), key, "left") if n_large <= HOT_ROWS else salted_join(dealt, large, key)
    blocks = F.coalesce("blocks", F.lit(1)) if n_large else F.lit(1)
    units = (dealt.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "word", "n", "block"))
    found = _compared(units.repartition(*key, "lo", "hi").sortWithinPartitions(*key, "lo", "hi", "word"))
    best = F.min(F.struct("neg_n", "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.neg_n")).alias("best_n"), F.col("b.form").alias("best"))


def variants(words: DataFrame, ratio: int = 5, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    A word's form is its near word of largest n (ties: smallest in code-point
    order) if that n is ``ratio`` times its own or more. The root is the end
    of the chain of forms, the word itself without one. An empty table gives
    no rows.
    """
    words = checkpointed(words.select("word", "n"))
    near = near_words(words, tile)
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = checkpointed(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")))
    # n grows by ``ratio`` with each step, so chains are short; each round doubles the steps taken
    ends = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = checkpointed(ends.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if not ends.where("next is not null").count():
            break
        ends = ends.drop("next")
    return out.join(ends.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def slipped(id_text: Column, run: Column, one_in: int = 199) -> Column:
    """The run without one code point if the crc32 h of ``<id>:<run>`` is a multiple
    of ``one_in``: the one at h modulo the length."""
    h = F.crc32(F.concat(id_text, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def op13_spelling(spark, sf_dir):
    return variants(vocabulary(table(spark, sf_dir, "documents"), edit=slipped))


ORACLE_OP13 = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
                         lambda a, s: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY b) AS t FROM range(256) r(b)),
runs AS (SELECT id, run, count(*) AS n FROM (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
raw AS (SELECT id, run, n, hex(encode(id || ':' || run)) AS x FROM runs WHERE length(run) >= 6),
coded AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, [CAST(('0x' || x[2 * i - 1:2 * i]) AS BIGINT) FOR i IN range(1, length(x) // 2 + 1)]),
                 lambda a, s: xor(t[1 + xor(a & 255, s)], a >> 8)), 4294967295) AS h FROM raw, tab),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM coded)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
dels AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other FROM dels a JOIN dels b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
         UNION SELECT a.word, b.word FROM dels a JOIN v b ON a.rest = b.word
         UNION SELECT b.word, a.word FROM dels a JOIN v b ON a.rest = b.word),
best AS (SELECT near.word, count(*) AS n_near, first(v.word ORDER BY v.n DESC, v.word) AS form, max(v.n) AS form_n
         FROM near JOIN v ON v.word = near.other GROUP BY near.word),
f AS (SELECT v.word, v.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN form_n >= 5 * v.n THEN form END AS form,
             CASE WHEN form_n >= 5 * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS spot, 0 AS steps FROM f UNION ALL
         SELECT walk.word, f.form, steps + 1 FROM walk JOIN f ON f.word = walk.spot WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(spot, steps) AS root FROM walk GROUP BY word)
SELECT f.word, f.form, ends.root, f.n, f.n_near, f.form_n FROM f JOIN ends USING (word)
"""
