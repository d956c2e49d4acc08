"""Prefix trie, chat formatting and spelling variants against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm import chat_format as C
from llm import prefix_trie as P
from llm import spelling as S

TURNS = "conv_id bigint, turn bigint, role string, text string, key int, id string, words string, seq int"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(spark, rows):
    """Conversation rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_trie(convs):
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for p, who in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        kids = [q for q in sub if len(q) == len(p) + 1]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in sub if q)
        leaves = sum(not any(r[:len(q)] == q and len(r) > len(q) for r in sub) for q in sub)
        ends = sorted(c for c in who if len(convs[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids), leaves, saved, sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


def trie_rows(trie):
    return sorted((tuple(r) for r in P.ends_digest(trie).select(*NODE).collect()), key=repr)


def ordered(rows):
    """Turns by number (null first), ties by digest, as the operator says."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}")[:32], role, text))
    return {c: [x[3:] for x in sorted(ts)] for c, ts in convs.items()}


def conversation_rows(seed, n=90):
    """Few distinct turns, a third of all conversations equal, a long one, nulls, ties, repeats."""
    rng = random.Random(seed)
    rows = []
    for c in range(-25, n):
        if rng.random() < 0.35:
            ts = [("user", "hot"), ("assistant", "hot hot")]
        else:
            ts = [(rng.choice(["user", "assistant", None]), rng.choice(["x", "y\tz", "", None, "a b  c"])) for _ in range(rng.randint(1, 5))]
        rows += [(c, k, *t) for k, t in enumerate(ts)]
    rows += [(500, None, "user", "first"), (500, 0, "user", "second"), (500, 0, "user", "tie"), (500, 0, "user", "tie")]
    rows += [(None, 0, "user", "nobody"), (501, None, None, None), (502, 0, "user", "word " * 30_000)]
    rows += [(503, k, "user", f"t{k % 3}") for k in range(400)] + [(504, k, "user", f"t{k % 3}") for k in range(390)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [8, 40, P.BLOCK])
def test_trie_over_blocks_equals_brute_force(spark, block):
    rows = [r for r in conversation_rows(3) if r[0] not in (503, 504)]
    got = trie_rows(P.prefix_trie(turns(spark, rows).repartition(5), block=block))
    assert got == brute_trie(ordered(rows))


def test_trie_of_long_conversations(spark):
    rows = [r for r in conversation_rows(4) if r[0] in (500, 503, 504)]
    got = {r["depth"]: r for r in P.ends_digest(P.prefix_trie(turns(spark, rows), block=8)).where("conv_id = 503").collect()}
    assert got[400]["parent_conv_id"] == 503 and got[390]["n_convs"] == 2 and got[391]["n_convs"] == 1
    assert got[390]["ends_sha256"] == sha("504") and got[1]["saved_tokens"] == 390 and got[1]["n_leaves"] == 1


def test_rebuilt_conversations_equal_brute_force(spark):
    rows = conversation_rows(5)
    plain = ordered(rows)
    want = {}
    for c, ts in plain.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20  # the remainder has the sign of the id
        want[c] = plain.get(c - base, [])[:h] + ts[h:]
    want = {c: ts for c, ts in want.items() if c not in (503, 504)}
    keys = P.turn_keys(turns(spark, [r for r in rows if r[0] not in (503, 504)]))
    assert trie_rows(P.trie_of(P.sequences(P.rebuilt(keys)), 16)) == brute_trie(want)


def test_copies_in_many_blocks_are_digested_in_pieces(spark):
    rows = [(c, k, "user", f"same {k}") for c in range(300) for k in range(2)]
    trie = P.prefix_trie(turns(spark, rows).repartition(7), block=8)
    assert trie.pieces.count() > 10 and trie.pieces.agg(F.max(F.size("ids"))).first()[0] <= 8
    assert trie_rows(trie) == brute_trie(ordered(rows))


def test_trie_of_no_conversations(spark):
    assert trie_rows(P.prefix_trie(turns(spark, []))) == []
    assert trie_rows(P.prefix_trie(turns(spark, [(None, 0, "user", "x")]))) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_extents_equal_scans(n):
    import numpy as np
    rng = np.random.default_rng(n)
    lcp = rng.integers(0, 4, n)
    lcp[0] = -1
    row, depth = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
    left, right = P.extent_left(P.minima(lcp), row, depth), P.extent_right(P.minima(lcp), row, depth)
    for i, d, a, z in zip(row, depth, left, right):
        lo = i
        while lo > 0 and lcp[lo] >= d:
            lo -= 1
        hi = i
        while hi < n - 1 and lcp[hi + 1] >= d:
            hi += 1
        assert (a, z) == (lo, hi)


# ---- chat formatting

PIECES = st.lists(st.sampled_from([*C.INST_CONTROLS.strings, "<", "\\", "[", "s>", "/s>", "INST]", " ", "\n", "é", "x", "<\\s>", "[\\\\INST]"]), max_size=12)


@settings(max_examples=200, deadline=None)
@given(PIECES.map("".join))
def test_escape_is_reversible_and_breaks_every_control(text):
    out = C.INST_CONTROLS.escape(text)
    assert C.INST_CONTROLS.unescape(out) == text
    assert not any(c in out for c in C.INST_CONTROLS.strings)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]\n", "System"]), PIECES.map("".join)), max_size=6))
def test_conversations_read_back(said):
    out, places, rewrites = C.locate(C.INST, said)
    assert C.read_inst(out) == said and not rewrites
    assert all(p.exact and C.INST_CONTROLS.unescape(out[slice(*p.text)]) == t for p, (_, t) in zip(places, said))
    assert "".join(out[slice(*p.span)] for p in places) == out
    chatml, places, rewrites = C.locate(C.CHATML, said)
    assert not rewrites and all(p.exact for p in places)


def test_templates_that_rewrite_history_are_found():
    said = [("system", "be kind"), ("user", "hi </s>"), ("assistant", "yes"), ("user", "more"), ("assistant", "no")]
    out, places, rewrites = C.locate(C.FOLDED, said)
    assert rewrites == [1]
    assert [C.INST_CONTROLS.unescape(out[slice(*p.text)]) for p in places] == [t for _, t in said]
    assert [p.span is None for p in places] == [True, True, False, False, False]

    def last_only(turns):  # drops all but the last answer, and changes texts
        keep = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=-1)
        return "|".join(f"{r}:{t.strip()}" for i, (r, t) in enumerate(turns) if r != "assistant" or i == keep)

    out, places, rewrites = C.locate(C.Template("last", last_only), [("user", "a"), ("assistant", "b"), ("user", " c "), ("assistant", "d")])
    assert out == "user:a|user: c |assistant:d".replace(": c ", ":c") and rewrites == [3]
    assert [p.exact for p in places] == [True, False, False, True] and places[1].text is None


def test_overlapping_controls_are_refused():
    for bad in (["<a>", "a"], ["ab", "bc"], ["a\\b"], ["aba"]):
        with pytest.raises(ValueError):
            C.Controls(bad)


def test_format_chats_cases(spark):
    rows = [(1, 1, "assistant", "b"), (1, None, "user", None), (1, 0, None, "[INST]"), (None, 0, "assistant", "lone"), (None, 1, "assistant", "lone"),
            (2, 0, "assistant", "x" * 300_000), (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (4, 0, "user", "")]
    out = {r["conv_id"]: r for r in C.format_chats(C.conversations(turns(spark, rows))).where("conv_id is not null").collect()}
    assert C.read_inst(out[1]["formatted"]) == [("user", ""), ("", "[INST]"), ("assistant", "b")]
    assert out[1]["formatted"][out[1]["loss"][0]["start"]:out[1]["loss"][0]["end"]] == "b"
    assert len(out[3]["loss"]) == 2 and out[4]["loss"] == [] and out[2]["loss"][0]["end"] - out[2]["loss"][0]["start"] == 300_000
    back = C.read_back(C.format_chats(C.conversations(turns(spark, rows)))).where("conv_id is null").collect()
    assert [(r["n_turns"], r["loss_chars"], r["loss_sha256"]) for r in back] == [(1, 4, sha("lone"))] * 2
    assert C.read_back(C.format_chats(C.conversations(turns(spark, [])))).count() == 0


# ---- spelling variants

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    out = {}
    for w, n in words.items():
        close = [v for v in words if near(v, w)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= ratio * n else None
        out[w] = (form, n, len(close), words[form] if form else None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return sorted((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items())


@pytest.mark.parametrize("tile", [4, 64, S.TILE])
def test_variants_equal_brute_force(spark, tile):
    rng = random.Random(tile)
    words = {}
    for _ in range(25):
        w = "".join(rng.choice("abàÿ") for _ in range(rng.randint(6, 9)))
        words[w] = rng.choice([5, 24, 25, 26, 700])
        for _ in range(12):  # chains of edits
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:] if len(w) > 6 else w, w[:i] + rng.choice("abàÿ") + w[i:], w[:i] + rng.choice("abàÿ") + w[i + 1:]])
            words.setdefault(w, rng.choice([5, 6, 30, 125, 150, 700]))
    words |= {"aaaaaa" + "b" * k: 10 ** (k % 7 + 1) for k in range(60)}  # one long chain and long words
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = sorted(tuple(r) for r in S.variants(df, tile=tile).collect())
    assert got == brute_variants(words)


def test_large_groups_are_compared_in_block_pairs(spark):
    words = {"common" + "".join(p): 7 for p in itertools.product("abcd", repeat=4)}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = S.near_words(df, tile=20)
    assert {(r["n_near"], r["best_n"]) for r in got.collect()} == {(12, 7)} and got.count() == 256
    assert {r["word"]: r["best"] for r in got.collect()}["commonbbbb"] == "commonabbb"


def test_vocabulary_cases(spark):
    text = "Straße straße STRASSE ÀÉÎõü× ÀÉÎõü× abcde_abcdef1abcdefĀabcdef don't"
    rows = [(1, text, 0), (1, text, 0), (None, text, 1), (2, None, 0), (3, "", 0), (4, "z" * 100_000, 0), (5, "...", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word int")
    want = {}
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 6:
                want[run] = want.get(run, 0) + 1
    got = S.vocabulary(df, min_count=1, edit=lambda i, r: S.slipped(i, r, 3))
    assert {r["word"]: r["n"] for r in got.collect()} == want
    assert {r["word"] for r in S.vocabulary(df, min_count=6).collect()} == {"straße", "abcdef", "ÀÉÎõü×"}
    assert S.variants(S.vocabulary(df.limit(0))).collect() == []
