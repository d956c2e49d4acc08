"""Conversation prefix trie by range minima over sorted sequences.

A conversation becomes one binary: the 16-byte digests of its turns (role and
text), one after the other, so that texts never leave the scan. Conversations
are range-partitioned and sorted by that binary and their id; every distinct
prefix is then one interval of rows, copies are dealt evenly, and no key
gathers them in one task.

Within a block of rows the longest common prefixes (LCPs) of neighbours get a
sparse table of range minima. Each candidate prefix (a row and a depth)
searches its left and its right extent by itself, in halving steps over that
table; no stack is kept and the order of candidates does not matter. The
candidates whose left extent is their own row are the block's nodes, in
pre-order, so that a subtree is a run of nodes and its sums are differences
of prefix sums.

A node that touches neither end of its block is complete. All others are
prefixes of the block's first or last row. These two rows go on to the next
level, with what the block adds to each of their prefixes, and the same
search runs over them; levels shrink by half a block each, and the last one
is a single block. What travels back down is the smallest member of the
prefixes of those rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import checkpointed, table

BLOCK = 16_384  # conversations searched together
CELLS = 1 << 20  # turns searched together, unless fewer than 8 conversations have them
KEY = 16

_NONE = np.iinfo(np.int64).max
_SUMS = ("convs", "kids", "leaves", "saved")  # added up over rows; ``low`` is their smallest id

NODE, PIECE, ITEM, LINK = range(4)
_OUT = pa.schema([
    ("kind", pa.int8()), ("block", pa.int64()), ("side", pa.int32()), ("pdepth", pa.int32()),
    *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    ("node", pa.binary()), ("ends", pa.list_(pa.int64())), ("seq", pa.binary()), ("words", pa.list_(pa.int32())),
    *((c, pa.list_(pa.int64())) for c in ("low", *_SUMS)),
    ("to_block", pa.int64()), ("to_side", pa.int32()), ("chain", pa.list_(pa.int64())),
])
_OUT_DDL = ("kind tinyint, block bigint, side int, pdepth int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
            "n_children bigint, n_leaves bigint, saved_tokens bigint, node binary, ends array<bigint>, seq binary, words array<int>, "
            "low array<bigint>, convs array<bigint>, kids array<bigint>, leaves array<bigint>, saved array<bigint>, "
            "to_block bigint, to_side int, chain array<bigint>")


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k holds the minimum of 2**k values from each place on."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half, low = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(low[:-half], low[half:]))
    return levels


def extent_left(lcp: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first row that shares ``depth`` turns with ``row``, for each candidate."""
    at = row.copy()
    for k in reversed(range(len(lcp))):
        to = at - (1 << k)
        ok = to >= 0
        ok[ok] = lcp[k][to[ok] + 1] >= depth[ok]
        at = np.where(ok, to, at)
    return at


def extent_right(lcp: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last row that shares ``depth`` turns with ``row``, for each candidate."""
    n, at = len(lcp[0]), row.copy()
    for k in reversed(range(len(lcp))):
        to = at + (1 << k)
        ok = to < n
        ok[ok] = lcp[k][at[ok] + 1] >= depth[ok]
        at = np.where(ok, to, at)
    return at


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi], lo < hi, by two overlapping powers of two."""
    levels = minima(values)
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), dtype=values.dtype)
    for level in np.unique(k):
        m = k == level
        out[m] = np.minimum(levels[level][lo[m]], levels[level][hi[m] - (1 << int(level))])
    return out


@dataclass
class Rows:
    """Sorted rows of a block. A cell is a row and a depth; ``low`` and the
    sums hold what the row adds to the node of that cell alone."""

    seq: list[bytes]
    words: np.ndarray  # of all turns
    ids: np.ndarray | None  # conversation of each row, on the first level
    low: np.ndarray
    sums: dict[str, np.ndarray]
    origin: list[tuple[int, int]] | None = None  # (block, side) on the level below

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        seq = batch["seq"].to_pylist()
        words = batch["words"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if "low" in batch.schema.names:
            flat = {c: batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("low", *_SUMS)}
            origin = list(zip(batch["block"].to_pylist(), batch["side"].to_pylist()))
            return Rows(seq, words, None, flat.pop("low"), flat, origin)
        ids = batch["id"].to_numpy(zero_copy_only=False)
        last = np.cumsum([len(s) // KEY + 1 for s in seq]) - 1
        cells = int(last[-1]) + 1
        low, convs, zero = np.full(cells, _NONE), np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        low[last], convs[last] = ids, 1
        return Rows(seq, words, ids, low, {"convs": convs, "kids": zero, "leaves": zero, "saved": zero})


def _lists(flat: np.ndarray, counts: np.ndarray, kind=None) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind or pa.int64()))


def _prefixes(seq: bytes) -> list[bytes]:
    """Digest of every prefix of the turns, the empty one first."""
    h = hashlib.blake2b(digest_size=KEY)
    out = [h.digest()]
    for at in range(0, len(seq), KEY):
        h.update(seq[at:at + KEY])
        out.append(h.copy().digest())
    return out


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    """A batch of the common schema; columns that are not given are null."""
    cols = {"kind": np.full(n, kind, np.int8), **columns}
    arrays = []
    for f in _OUT:
        x = cols.get(f.name)
        arrays.append(pa.nulls(n, f.type) if x is None else x if isinstance(x, pa.Array) else pa.array(x, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_OUT)


def search(rows: Rows, block: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Nodes, pieces, rows of the next level and links of one block."""
    n = len(rows.seq)
    size = np.array([len(s) // KEY for s in rows.seq])
    turn0 = np.concatenate([[0], np.cumsum(size)])
    cell0 = turn0[:-1] + np.arange(n)
    keys = np.frombuffer(b"".join(rows.seq), dtype=np.uint64).reshape(-1, 2)

    # LCPs of neighbours, in turns; row 0 shares nothing, not even the root
    lcp = np.full(n, -1, dtype=np.int64)
    if n > 1:
        common = np.minimum(size[1:], size[:-1])
        row = np.repeat(np.arange(1, n), common)
        j = np.arange(len(row)) - np.repeat(np.cumsum(common) - common, common)
        differ = (keys[turn0[row - 1] + j] != keys[turn0[row] + j]).any(axis=1)
        lcp[1:] = common
        np.minimum.at(lcp, row[differ], j[differ])
    levels = minima(lcp)

    row = np.repeat(np.arange(n), size + 1)
    depth = np.arange(len(row)) - cell0[row]
    left = extent_left(levels, row, depth)
    first = left == row
    number = np.cumsum(first) - 1
    node_of = number[cell0[left] + depth]
    left, d = row[first], depth[first]
    right = extent_right(levels, left, d)
    m = len(left)
    seen = np.arange(m)
    end = np.searchsorted(left, right, side="right")  # nodes are in pre-order

    def within(x):
        run = np.concatenate([[0], np.cumsum(x)])
        return run[end] - run[:m]

    own = {c: np.zeros(m, np.int64) for c in _SUMS}
    for c, x in own.items():
        np.add.at(x, node_of, rows.sums[c])
    low = np.full(m, _NONE)
    np.minimum.at(low, node_of, rows.low)
    parent = np.where(d > 0, node_of[cell0[left] + np.maximum(d, 1) - 1], -1)
    word = np.zeros(m, np.int64)
    word[d > 0] = rows.words[turn0[left[d > 0]] + d[d > 0] - 1]

    n_convs, smallest = within(own["convs"]), _range_min(low, seen, end)
    kids = own["kids"] + np.bincount(parent[parent >= 0], minlength=m)
    leaves = within(own["leaves"] + (kids == 0))
    saved = within(own["saved"] + (n_convs - 1) * word)
    opened = np.zeros(m, bool) if last else (left == 0) | (right == n - 1)

    # nodes that are complete; the parent may be open, then its row tells it later
    done = ~opened
    top = done & (parent >= 0) & opened[parent]
    known = done & (parent >= 0) & ~top
    side = (left[parent] != 0).astype(np.int32)
    out = {"block": np.full(m, block), "side": pa.array(side, mask=~top), "pdepth": pa.array((d - 1).astype(np.int32), mask=~top),
           "conv_id": smallest, "depth": d, "parent_conv_id": pa.array(smallest[parent], mask=~known), "n_convs": n_convs,
           "n_children": kids, "n_leaves": leaves, "saved_tokens": saved}
    if rows.ids is not None:
        whole = np.zeros(m, np.int64)  # conversations that end at the node: rows left, left + 1, ...
        np.add.at(whole, node_of[cell0 + size], 1)
        at = np.repeat(left - (np.cumsum(whole) - whole), whole) + np.arange(int(whole.sum()))
        out["ends"] = _lists(rows.ids[at], whole)
    else:
        out["node"] = pa.array([p for i in range(n) for p in _prefixes(rows.seq[i])[max(int(lcp[i]) + 1, 0):]], pa.binary())
    pick = pa.array(np.flatnonzero(done))
    if len(pick):
        yield _rows(NODE, len(pick), **{c: (x if isinstance(x, pa.Array) else pa.array(x)).take(pick) for c, x in out.items()})
    if rows.origin is not None:  # what the level below asks for: the members of its rows' prefixes
        over = np.add.reduceat(opened[node_of].astype(np.int64), cell0)  # the topmost cells are the open ones
        deepest = node_of[cell0 + np.maximum(over - 1, 0)]
        keep = ~opened[node_of]
        yield _rows(LINK, n, block=np.full(n, block), side=(left[deepest] != 0).astype(np.int32), pdepth=over.astype(np.int32),
                    to_block=np.array([o[0] for o in rows.origin]), to_side=np.array([o[1] for o in rows.origin], np.int32),
                    chain=_lists(smallest[node_of[keep]], size + 1 - over))
    if last:
        return

    # the first and the last row, with what complete nodes add to their prefixes
    up = {c: x.copy() for c, x in own.items()}
    low = low.copy()
    closed = np.flatnonzero(top)
    for c, x in {"convs": n_convs, "leaves": leaves, "saved": saved}.items():
        np.add.at(up[c], parent[closed], x[closed])
    np.add.at(up["kids"], parent[closed], 1)
    np.minimum.at(low, parent[closed], smallest[closed])
    ends = [0] if rows.seq[0] == rows.seq[-1] else [0, n - 1]
    cells = [np.arange(cell0[r], cell0[r] + size[r] + 1) for r in ends]
    flat, counts = np.concatenate(cells), np.array([len(c) for c in cells])
    mine = np.concatenate([np.ones(len(cells[0]), bool), *(left[node_of[c]] != 0 for c in cells[1:])])  # counted once
    at = node_of[flat]
    yield _rows(ITEM, len(ends), block=np.full(len(ends), block), side=np.arange(len(ends), dtype=np.int32),
                seq=[rows.seq[r] for r in ends],
                words=_lists(np.concatenate([rows.words[turn0[r]:turn0[r + 1]] for r in ends]), counts - 1, pa.int32()),
                low=_lists(np.where(mine, low[at], _NONE), counts),
                **{c: _lists(np.where(mine, x[at], 0), counts) for c, x in up.items()})
    if rows.ids is not None:
        names = [p for r in ends for p in _prefixes(rows.seq[r])]
        pieces = [(names[i], rows.ids[left[v]:left[v] + whole[v]]) for i, v in enumerate(at) if mine[i] and whole[v]]
        if pieces:
            yield _rows(PIECE, len(pieces), node=[p for p, _ in pieces], conv_id=np.array([int(x[0]) for _, x in pieces]),
                        ends=_lists(np.concatenate([x for _, x in pieces]), np.array([len(x) for _, x in pieces])))


def _searched(sorted_rows: DataFrame, block: int, last: bool) -> DataFrame:
    """``search`` over consecutive blocks of every partition."""

    def run(batches):
        task, k = TaskContext.get().partitionId() << 32, 0
        held, n, turns = [], 0, 0
        for b in batches:
            start = 0
            for i, c in enumerate(pc.binary_length(b["seq"]).to_pylist()):
                n, turns = n + 1, turns + c // KEY
                if not last and (n >= block or (n >= 8 and turns >= CELLS)):
                    yield from search(_joined([*held, b.slice(start, i + 1 - start)]), task | k, last)
                    held, n, turns, k, start = [], 0, 0, k + 1, i + 1
            if start < len(b):
                held.append(b.slice(start))
        if held:
            yield from search(_joined(held), task | k, last)

    return sorted_rows.mapInArrow(run, _OUT_DDL)


def _joined(batches: list[pa.RecordBatch]) -> Rows:
    return Rows.of(pa.Table.from_batches(batches).combine_chunks().to_batches()[0])


@dataclass
class Trie:
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and either ``ends``, the ids of the
    conversations that end there, ascending, or ``node``, a digest under which
    ``pieces`` (node, first, ids) holds those ids in runs, ascending by
    ``first``: a node of very many copies is never one row."""

    nodes: DataFrame
    pieces: DataFrame


def turn_keys(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turn, key, words) of rows with an id: a digest of role and text and the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * KEY).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))


def ordered_turns() -> Column:
    """All turns of a group as an array of (turn, key, words), null turns first."""
    return F.sort_array(F.collect_list(F.struct("turn", "key", "words")))


def sequences(convs: DataFrame) -> DataFrame:
    """(id, seq, words) of (id, turns)."""
    return convs.select("id", F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), "")).alias("seq"),
                        F.transform("turns", lambda t: t["words"].cast("int")).alias("words"))


def prefix_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                block: int = BLOCK) -> Trie:
    """The trie of all conversations of (id, turn, role, text) rows.

    A null role or text is an empty one; a null turn stands first. Rows of
    one conversation with equal turns all count, in the order of their
    digests. Rows with a null id belong to no conversation and are left out,
    as members are named by ids. An empty table has no nodes. Long texts
    count by their digest; a conversation costs a task 24 bytes a turn. Other
    columns are ignored. Digests have 128 bits.
    """
    rows = turn_keys(turns, id_col, turn_col, role_col, text_col)
    return trie_of(sequences(rows.groupBy("id").agg(ordered_turns().alias("turns"))), block)


def trie_of(convs: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of rows (id, seq, words), ids distinct and not null. ``block``: 8 or more."""
    levels = [checkpointed(_searched(convs.repartitionByRange("seq", "id").sortWithinPartitions("seq", "id"), block, False))]
    order = ["seq", "block", "side"]
    while n := (items := levels[-1].where(F.col("kind") == ITEM).select(*order, "words", "low", *_SUMS)).count():
        last = n <= block
        dealt = items.repartition(1) if last else items.repartitionByRange(max(n // (4 * block), 1), *order)
        levels.append(checkpointed(_searched(dealt.sortWithinPartitions(*order), block, last)))
    parts, chains = [], None
    for out in reversed(levels):
        nodes = out.where(F.col("kind") == NODE).select("block", "side", "pdepth", "conv_id", "depth", "parent_conv_id", "n_convs",
                                                        "n_children", "n_leaves", "saved_tokens", "ends", "node")
        if chains is not None:
            waits = nodes.where("side is not null").join(chains, ["block", "side"], "left")
            nodes = nodes.where("side is null").unionByName(waits.withColumn("parent_conv_id", F.col("chain")[F.col("pdepth")]).drop("chain"))
        parts.append(nodes.drop("block", "side", "pdepth"))
        link = out.where(F.col("kind") == LINK).select("block", "side", F.col("pdepth").alias("t"), "to_block", "to_side", F.col("chain").alias("rest"))
        if chains is not None:
            link = link.join(chains, ["block", "side"], "left").withColumn(
                "rest", F.when(F.col("t") > 0, F.concat(F.slice("chain", F.lit(1), F.col("t")), F.col("rest"))).otherwise(F.col("rest")))
        chains = link.select(F.col("to_block").alias("block"), F.col("to_side").alias("side"), F.col("rest").alias("chain"))
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    pieces = levels[0].where(F.col("kind") == PIECE).select("node", F.col("conv_id").alias("first"), F.col("ends").alias("ids"))
    return Trie(nodes, pieces)


def ends_digest(trie: Trie) -> DataFrame:
    """``nodes`` with ends_sha256 in place of ``ends`` and ``node``: of the ids that
    end there, comma-joined. Ids in pieces are read in order, one piece at a time."""

    def digest(batches):
        node, h = None, None
        for b in batches:
            for at, ids in zip(b["node"].to_pylist(), b["ids"]):
                text = ",".join(map(str, ids.values.to_pylist())).encode()
                if at != node:
                    if node is not None:
                        yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "sha": [h.hexdigest()]})
                    node, h = at, hashlib.sha256(text)
                else:
                    h.update(b"," + text)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "sha": [h.hexdigest()]})

    read = trie.pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, sha string")
    here = F.sha2(F.array_join(F.col("ends").cast("array<string>"), ",").cast("binary"), 256)
    small = trie.nodes.where("node is null").withColumn("ends_sha256", here)
    split = trie.nodes.where("node is not null").join(read, "node", "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256))).drop("sha")
    return small.unionByName(split).drop("ends", "node")


def rebuilt(rows: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(id, turns): conversation c begins with the first h turns of conversation
    c - c % family and goes on with its own turns after its first h; h is the
    crc32 of the decimal id modulo ``heads``. ``rows`` are ``turn_keys``.

    One shuffle, by family: at most 2 * family - 1 conversations (ids around
    zero) share a first one.
    """
    c = F.col("id")
    base = F.col("base")
    convs = rows.withColumn("base", c - c % family).repartition("base").groupBy("base", "id").agg(ordered_turns().alias("turns"))
    head = F.max(F.when(c == base, F.slice("turns", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    none = F.array().cast("array<struct<turn:bigint,key:string,words:int>>")
    own = F.filter("turns", lambda t, k: k >= F.col("h"))
    return (convs.withColumn("head", F.coalesce(head, none)).withColumn("h", h)
            .select("id", F.concat(F.slice("head", F.lit(1), F.col("h")), own).alias("turns")))


def op11_prefix_trie(spark, sf_dir):
    rows = turn_keys(table(spark, sf_dir, "conversations")).withColumn("turn", F.col("turn").cast("bigint"))
    nodes = ends_digest(trie_of(sequences(rebuilt(rows))))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLE_OP11 = r"""
WITH t AS (
  SELECT conv_id AS c, sha256(length(r) || ':' || r || x)[1:32] AS k, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)[1:32]) AS i
  FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
bits AS (SELECT c, flatten([[ord(CAST(c AS VARCHAR)[j]), -1, -1, -1, -1, -1, -1, -1, -1] FOR j IN range(1, length(CAST(c AS VARCHAR)) + 1)]) AS steps
         FROM (SELECT DISTINCT c FROM t)),
ids AS (SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295, steps), lambda a, s:
                CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h FROM bits),
re AS (SELECT ids.c, t.i, t.k, t.w FROM ids JOIN t ON t.c = ids.b WHERE t.i <= ids.h
       UNION ALL SELECT ids.c, 1000000 + t.i, t.k, t.w FROM ids JOIN t ON t.c = ids.c WHERE t.i > ids.h),
q AS (SELECT ids.c, coalesce(list(re.k ORDER BY re.i) FILTER (WHERE re.k IS NOT NULL), []) AS ks,
             coalesce(list(re.w ORDER BY re.i) FILTER (WHERE re.k IS NOT NULL), []) AS ws
      FROM ids LEFT JOIN re ON re.c = ids.c GROUP BY ids.c),
m AS (SELECT c, d, array_to_string(ks[1:d], ',') AS p, CASE WHEN d > 0 THEN array_to_string(ks[1:d - 1], ',') END AS pp,
             CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, len(ks) = d AS ends, ks
      FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM q)),
n AS (SELECT d, p, any_value(pp) AS pp, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w, any_value(ks[1:d]) AS ks,
             coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ends
      FROM m GROUP BY d, p),
kids AS (SELECT d - 1 AS d, pp AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY 1, 2),
up AS (SELECT e AS d, array_to_string(ks[1:e], ',') AS p, sum((n_convs - 1) * w) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
       FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM n) x LEFT JOIN kids ON kids.d = x.d AND kids.p = x.p GROUP BY 1, 2)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       up.leaves AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN up ON up.d = n.d AND up.p = n.p LEFT JOIN kids ON kids.d = n.d AND kids.p = n.p
LEFT JOIN n o ON o.d = n.d - 1 AND o.p = n.pp
"""
