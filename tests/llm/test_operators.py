"""Edge cases and brute-force twins of the training-data operators."""

import base64
import hashlib
import json
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from llm import (
    common,
    decontaminate,
    embedding_dedup,
    html_extract,
    jaccard_join,
    language_id,
    licenses,
    mixing,
    quality,
    secrets,
    substring_dedup,
    words,
)
from llm.common import Bitmap, components, fold
from llm.words import ALNUM, SPACED, SPACED_LOWER, Words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id string, id string, key int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, g, s, None, 1.0, "c", "i", 7) for i, t, g, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta omega sigma theta kappa lambda rho".split()) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def mixed_rows():
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(1, 60)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for t in base[:10]:  # copies, near copies, shared passages, other case and spaces
        words = t.split()
        words[len(words) // 2] = "changed"
        rows += [(len(rows), t), (len(rows) + 1, " ".join(words)), (len(rows) + 2, sentence(rng, 8) + "\n" + t), (len(rows) + 3, t.upper().replace(" ", "\t"))]
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "one"), (None, base[0]), (None, None), (904, LONG), (905, LONG + " end"), (0, base[0])]
    rng.shuffle(rows)
    return [(i, t, "en", "s") for i, t in rows]


@pytest.mark.parametrize("alphabet,pattern,lower", [(SPACED, r"[^\x20\x09-\x0D]+", False), (SPACED_LOWER, r"[^\x20\x09-\x0D]+", True),
                                                    (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
def test_words_split_like_their_patterns(alphabet, pattern, lower):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAZ09 .\t\n-_é\u0085漢") for _ in range(rng.randint(0, 50))) for _ in range(200)] + ["", None]
    w = Words.of(texts, alphabet)
    plain = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if lower else t or "") for t in texts]
    assert w.counts().tolist() == [len(p) for p in plain]
    hashes = {}
    for word, h in zip((x for p in plain for x in p), w.hashes.tolist()):
        assert hashes.setdefault(word, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(1, 31)) and all(got[i] == 100 for i in range(101, 140)) and got[201] == 200
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_jaccard_join_against_all_pairs(spark, mixed_rows):
    for k, percent in ((3, 90), (5, 80)):
        got = jaccard_join.link_classes(docs(spark, mixed_rows), k, percent).collect()
        sets = []
        for i, t, *_ in mixed_rows:
            w = (t or "").encode().lower().split()
            sets.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
        parent = {i: i for i, _ in sets if i is not None}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, x in sets:
            for b, y in sets:
                if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
        want = sorted((str(i), len(s), None if i is None else find(i)) for i, s in sets)
        assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == want


def test_without_copies_keeps_one_of_each(spark, mixed_rows):
    d = docs(spark, mixed_rows)
    left = jaccard_join.without_copies(d)
    assert left.columns == d.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(0) == 1 and ids.count(None) == 2 and 904 in ids and 905 not in ids and {900, 901, 902} <= set(ids)


def test_substring_dedup_against_windows(spark, mixed_rows):
    rows = [r for r in mixed_rows]
    got = substring_dedup.strip_repeats(docs(spark, rows), window=5).collect()
    low = {}
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for j in range(len(w) - 4):
            if i is not None:
                key = tuple(w[j:j + 5])
                low[key] = min(low.get(key, i), i)
    want = []
    for i, t, *_ in rows:
        w, gone = (t or "").encode().split(), set()
        for j in range(len(w) - 4):
            if i is not None and low[tuple(w[j:j + 5])] < i:
                gone |= set(range(j, j + 5))
        want.append((str(i), len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == sorted(want)


def test_hot_anchors_are_split(spark):
    """A short phrase in a third of the rows, between other words each time."""
    rng = random.Random(3)
    phrase = min((f"if you like {n}" for n in range(200)), key=lambda p: Words.of([p], SPACED).runs(4)[0])  # an anchor wherever it stands
    rows = [(i, f"{sentence(rng, 14)} {phrase if i % 3 == 0 else ''} {sentence(rng, 14)}", "en", "s") for i in range(3000)]
    rows += [(5000 + i, f"{sentence(rng, 3)} {rows[i * 7][1]}", "en", "s") for i in range(100)]
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in substring_dedup.strip_repeats(docs(spark, rows)).collect()}
    for i, t, *_ in rows:
        w = t.split()
        assert got[i] == ((len(w) - 3, " ".join(w[:3])) if i >= 5000 else (0, " ".join(w)))
    w = Words.of([t for _, t, *_ in rows], SPACED)
    ok = w.run_ok(13)
    anchor, seed = substring_dedup._anchor(w, 13)[ok], w.runs(13)[ok]
    counts = np.bincount((anchor & np.uint64((1 << substring_dedup.ANCHOR_BITS) - 1)).astype(np.int64), minlength=1 << substring_dedup.ANCHOR_BITS)
    for buckets in (16, 64):
        parts = substring_dedup._parts(counts, buckets)
        split = np.bincount(substring_dedup._buckets(anchor, seed, parts, buckets), minlength=buckets)
        whole = np.bincount((anchor % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        assert split.max() < 3 * split.mean() and whole.max() > 3 * whole.mean()
        same = substring_dedup._buckets(np.repeat(anchor[:50], 2), np.repeat(seed[:50], 2), parts, buckets)
        assert (same[::2] == same[1::2]).all()


def test_prefixes_of_linked_sets_meet_under_every_order():
    rng = np.random.default_rng(4)
    rarity = rng.integers(1, 50, 1 << 10).astype(np.uint32)
    for _ in range(300):
        n, percent = int(rng.integers(1, 60)), int(rng.choice([80, 90]))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.08], rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64)]))
        if jaccard_join._linked(x, y, percent):
            for seed in (jaccard_join._SEED_B, jaccard_join._SEED_C):
                assert np.isin(*(jaccard_join._prefix(s, rarity, seed, percent) for s in (x, y))).any()


def test_factors_name_their_source(spark):
    text = " ".join(f"a{i}" for i in range(40))
    d = docs(spark, [(1, "x " + text, "en", "s"), (2, "y z " + text + " q", "en", "s")])
    f = substring_dedup.factors(d, window=13).orderBy("start").collect()
    assert {(r["id"], r["src"]) for r in f} == {(2, 1)} and all(r["at"] == r["start"] - 1 for r in f)
    covered = {w for r in f for w in range(r["start"], r["start"] + r["n"])}
    assert covered == set(range(2, 42))


def test_decontamination_against_windows(spark, mixed_rows):
    items = [(1, mixed_rows[3][1]), (2, "ONE!"), (3, None), (4, ""), (5, LONG[:300]), (6, LONG[:300]), (None, "zzz yyy")]
    bench = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id bigint, text string, n_words int")
    rows = mixed_rows + mixed_rows[:7] * 2
    got = decontaminate.contamination(docs(spark, rows), bench, window=4).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(4, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add(i)
    want = []
    for i, t, *_ in rows:
        w, hit, found = split(t), set(), set()
        for g, who in wins.items():
            for j in range(len(w) - len(g) + 1):
                if w[j] == g[0] and tuple(w[j:j + len(g)]) == g:
                    hit |= set(range(j, j + len(g)))
                    found |= {str(x) for x in who if x is not None}
        want.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((str(r["doc_id"]), *(r[c] for c in cols)) for r in got) == sorted(want)


@pytest.mark.parametrize("block", [2048, 7])
def test_embedding_dedup_against_all_pairs(spark, block):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(base)]
    for v in base[:12]:
        for s in (0.05, 0.12):
            rows.append((len(rows), [x + rng.gauss(0, s) for x in v]))
        rows.append((len(rows), list(v)))
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0] * 7 + [float("nan")]), (504, [1.0] * 7 + [None]), (505, [1.0, 2.0]),
             (506, [2.0, 4.0]), (None, base[0]), (507, [float("inf")] + [1.0] * 7)]
    v = spark.createDataFrame([(i, x, i) for i, x in rows], "vec_id bigint, embedding array<double>, n int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(v, block=block).collect()}
    sound = {i: x for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)}

    def cos(x, y):
        return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y)) if len(x) == len(y) else -1

    link = {i: [j for j, y in sound.items() if j != i and cos(x, y) >= 0.95] for i, x in sound.items()}
    for i, _ in rows:
        if i is None:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in link.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(link.get(i, [])), min(seen), min(seen) == i)
    assert got[None]["component_id"] is None and len(got) == len(rows)


def test_language_id(spark):
    sf = "/root/testdata/sf0.01"
    found = language_id.op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98
    rows = [(i, t, g, "s") for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 6)]
    odd = [(90, None, "en", None), (91, "", "de", None), (92, "12 +-", None, None), (None, "und der", "de", None), (93, LONG, None, None), (90, None, "en", None)]
    got = language_id.identify(docs(spark, rows + odd), F.lit(True)).collect()
    by = {r["id"]: r for r in got}
    assert len(got) == 18 and by[0]["lang_pred"] == "en" and by[1]["lang_pred"] == "de" and by[None]["lang_pred"] == "de"
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (90, 91, 92)) and by[93]["rejected"]
    none = language_id.identify(docs(spark, odd), F.lit(False)).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and language_id.identify(docs(spark, []), F.lit(True)).count() == 0


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.97
    odd = docs(spark, [(1, None, None, None), (2, "", None, None), (None, "a b", None, None), (3, LONG, None, None), (1, None, None, None)])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    got = quality.score_quality(odd, labels, F.lit(True)).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    assert quality.accepted(odd, labels, F.lit(True)).columns == odd.columns


def test_rules_hold_as_columns(spark):
    rng = __import__("numpy").random.default_rng(3)
    x = rng.random((400, len(quality.STATS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    model = quality.fit_rules(x, y)
    df = spark.createDataFrame(x.tolist(), quality.STATS).select(model.column().alias("s")).collect()
    assert sum((r["s"] >= 0.5) == bool(t) for r, t in zip(df, y)) >= 390 and 0 < len(model.rules) < 120


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.randint(1, 30)), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1500)]
    rows += [(9001, None, "en", "empty"), (None, "a b", "en", None), (9002, "c", "en", None), (1, rows[1][1], "en", rows[1][3])]
    d = docs(spark, rows)
    got = mixing.mixed(d, entropy_gain=0.5, max_repeats=4)
    assert got.columns[:len(d.columns)] == d.columns
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    total = sum(size.values())
    drawn = {r["source"]: r for r in got.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.first("mix_weight").alias("w"), F.max("epoch").alias("e")).collect()}
    assert "empty" not in drawn and abs(sum(r["w"] for r in drawn.values()) - 1) < 1e-9
    p = {s: n / total for s, n in size.items() if n}
    a = math.log(drawn["hot"]["w"] / drawn["s1"]["w"]) / math.log(p["hot"] / p["s1"])
    z = sum(q ** a for q in p.values())
    assert 0 < a < 1 and all(abs(r["w"] - p[s] ** a / z) < 1e-9 for s, r in drawn.items())
    for s, r in drawn.items():
        assert r["t"] <= round(r["w"] * total) and r["t"] >= r["w"] * total - 60 and r["w"] * total / size[s] <= 4 + 1e-6
    # an epoch that is drawn whole holds every document of its source once
    whole = got.where("source = 's1' and epoch = 0").count() if drawn["s1"]["e"] >= 1 else None
    assert whole in (None, sum(s == "s1" for *_, s in rows))
    assert mixing.mixed(docs(spark, [])).count() == 0
    again = mixing.mixed(d.repartition(7), entropy_gain=0.5, max_repeats=4)
    key = ["doc_id", "epoch", "mix_key"]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, again.select(key).collect()))


def test_secrets(spark):
    import base64
    import json
    enc = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{enc({'alg': 'HS256', 'typ': 'JWT'})}.{enc({'sub': 'me'})}.c2lnbmF0dXJl"
    fake = f"{enc(['alg'])}.{enc({'sub': 'me'})}.c2lnbmF0dXJl"
    octets = bytes([4, 0x60]) + bytes(range(96))
    inner = bytes.fromhex("020100300d06092a864886f70d0101010500") + octets
    der = bytes([0x30, 0x81, len(inner)]) + inner
    key = base64.b64encode(der).decode()
    ssh = base64.b64encode(b"openssh-key-v1\0" + b"\0\0\0\4none\0\0\0\4none\0\0\0\0\0\0\0\1" + bytes(30)).decode()
    rows = [(1, f"x é Token = '{'A' * 12}' AKIA{'B' * 14} {'0af' * 6}"), (2, f"see {token} and {fake}"), (3, f"{key} {key[:-8]}"),
            (4, der.hex()), (5, f"-----BEGIN PRIVATE KEY-----\n{key[:64]}\n{key[64:]}\n-----END PRIVATE KEY-----"), (6, ssh), (7, None), (8, ""),
            (9, "password: short"), (None, "secret=abcdefghijkl"), (10, LONG)]
    d = docs(spark, [(i, t, None, None) for i, t in rows])
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan(d).collect()}
    assert [s[0] for s in got[1]] == ["assign", "access", "hex"] and got[1][0][1:] == (4, 25)
    assert got[2] == [("signed", 4, 4 + len(token))]
    assert got[3] == [("key", 0, len(key))] and [s[0] for s in got[4]] == ["hex", "key"]
    assert "key" in [s[0] for s in got[5]] and got[6][0][0] == "ssh" and got[7] == got[8] == got[9] == got[10] == []
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(d).collect()}
    assert clean[2] == f"see [secret] and {fake}" and clean[7] is None and clean[10] == LONG and clean[None] == "[secret]"
    assert secrets.redacted(d).columns == d.columns


def test_secrets_in_their_leaked_forms():
    enc = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    octets = bytes([4, 0x60]) + bytes(range(96))
    inner = bytes.fromhex("020100300d06092a864886f70d0101010500") + octets
    key = base64.b64encode(bytes([0x30, 0x81, len(inner)]) + inner).decode()
    ssh = base64.b64encode(b"openssh-key-v1\0" + b"\0\0\0\4none\0\0\0\4none\0\0\0\0\0\0\0\1" + bytes(range(150))).decode()

    def wrapped(text, n, by):
        return by.join(text[i:i + n] for i in range(0, len(text), n))

    for body, kind in ((key, "key"), (ssh, "ssh")):
        for by in ("\n", "\r\n", "\\n", "\\r\\n", "\\\\n"):
            pem = f"-----BEGIN PRIVATE KEY-----{by}{wrapped(body, 64, by)}{by}-----END PRIVATE KEY-----"
            for text in (f'{{"private_key": "{pem}\\n", "id": 1}}', f"KEY='{pem}{by}'"):
                assert [(secrets.KINDS[k], text[s:e]) for s, k, e in secrets.scan_text(text)] == [(kind, pem)]
            for n in (64, 76):
                bare = wrapped(body, n, by)
                text = f"see{by}{bare}{by}and more{by}"
                assert [(secrets.KINDS[k], text[s:e]) for s, k, e in secrets.scan_text(text)] == [(kind, bare)]
    escaped = "-----BEGIN PRIVATE KEY-----\\n" + key.replace("/", "\\/") + "\\n-----END PRIVATE KEY-----"
    assert (0, 4, len(escaped)) in secrets.scan_text(escaped)
    assert secrets.scan_text(wrapped(key[:-8], 64, "\n")) == []
    token = f"{enc({'alg': 'HS256'})}.{enc({'sub': 'me'})}.c2lnbmF0dXJl"
    for before in ("sessionid.", "sessionid.anotherword.", "www.sessionid."):
        assert secrets.scan_text(before + token) == [(len(before), 3, len(before + token))]
    assert [x[1] for x in secrets.scan_text(f"{token} sessionid.{token}")] == [3, 3]


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"]
    changed = mit.replace("without restriction", "without any restriction").replace("publish, ", "")
    rows = [(1, "Text before. " + mit), (2, changed), (3, "under the MIT License and the mit-license; General Public License"), (4, None), (5, ""),
            (6, "permission is hereby granted, free of charge"), (None, mit), (7, LONG), (1, "Text before. " + mit)]
    got = {}
    for r in licenses.scan(docs(spark, [(i, t, None, None) for i, t in rows])).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[1]) == 2 and got[1][0]["labels"] == "mit" and got[1][0]["score"] == 1.0 and got[1][0]["findings"][0]["start"] == 2
    assert got[2][0]["labels"] == "mit" and 0.8 < got[2][0]["score"] < 1 and len(got[2][0]["findings"]) == 1
    assert (got[3][0]["n_base"], got[3][0]["first_word"], got[3][0]["last_word"], got[3][0]["base_labels"]) == (3, 2, 8, "gpl,mit")
    assert [got[i][0]["labels"] for i in (4, 5, 6, 7)] == [""] * 4 and got[None][0]["labels"] == "mit" and got[4][0]["first_word"] is None


def test_licenses_with_repeated_phrases(spark):
    bsd = licenses.TEMPLATES["bsd"]
    numbered = bsd.replace("met: Redist", "met: 1. Redist").replace("disclaimer. Redist", "disclaimer. 2. Redist")
    words, edited = numbered.split(), []
    for i in range(8, 60, 6):
        for j in range(i + 8, 68, 9):
            edited.append(" ".join([*words[:i], "plainly", *words[i:j], "also", *words[j:]]))
    rows = [(1, bsd), (2, numbered), (3, numbered + " More text. " * 30 + numbered), (4, bsd.replace("Redistributions in binary", "Redistribution in any binary"))]
    rows += [(100 + n, t) for n, t in enumerate(edited)]
    got = {r["doc_id"]: r for r in licenses.scan(docs(spark, [(i, t, None, None) for i, t in rows])).collect()}
    assert got[1]["score"] == 1.0 and got[2]["score"] > 0.9 and got[4]["score"] > 0.8
    assert [f["template"] for f in got[2]["findings"]] == ["bsd"] and len(got[3]["findings"]) == 2
    assert (got[2]["findings"][0]["start"], got[2]["findings"][0]["end"]) == (0, got[2]["n_words"])
    assert all(got[100 + n]["labels"] == "bsd" and got[100 + n]["score"] > 0.7 for n in range(len(edited)))


def test_html(spark):
    page = ('<html><body><header class="site"><h1>Site</h1></header><div id="cookie-notice">We use</div><nav><ul><li><a href="/">x</a></ul></nav>'
            '<main><article><header><h1>T &amp; u</h1><p>by me</p></header><p>One  two&nbsp;three <a href=x>link</a><br>four.<p>Five <b>six</b> seven.'
            '<aside>side</aside><form><input><label>q</label></form><div class="comments"><p>bad</p></div><script>var a="</p>";</script>'
            '<ul><li>l1<li>l2</ul></article></main><footer>f</footer></body></html>')
    short = "<body><div class=menu3>m</div><div class='content12'><p>Only this.</p></div><foot"
    rows = [(1, "http://a.b/1", page), (2, "http://a.b/2", page.replace("T &amp; u", "V")), (3, None, None), (4, "x", ""), (5, "http://c/", short),
            (None, "http://A.B/3", page), (6, "http://c/2", "plain <b>text</b>"), (7, "http://c/3", "<p>" + "a " * 100_000)]
    got = {r["page_id"]: r for r in html_extract.main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")).collect()}
    assert got[1]["text"] == "T & u\nOne two three link four.\nFive six seven.\nl1\nl2" == got[None]["text"] and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] == got[4]["text"] == "" and got[5]["text"] == "Only this." and got[6]["text"] == "plain text"
    assert got[7]["n_chars"] == 199_999 and len(got) == len(rows)


def test_html_keeps_all_of_an_article():
    lead, body = "lead " * 40, "body text " * 200
    whole = f"H\n{lead.strip()}\n{body.strip()}"
    nested = f"<h1>H</h1><p>{lead}</p><div class=body><p>{body}</p></div>"
    split = f"<section class=one><h1>H</h1><p>{lead}</p></section><section class=two><p>{body}</p></section>"
    for page in (f"<article>{nested}</article>", f"<div class=post>{nested}</div>", f"<main>{split}</main>", f"<body>{split}</body>"):
        page = f"<html><body>{page}<div class=links><p><a href=x>Other page, other page</a></p></div></body></html>"
        assert html_extract.extract(page, None) == whole
        assert html_extract.extract(page, [html_extract.best_container(html_extract.parse(page)).path]) == whole
    # the host's other layout has its text in the box that is a short note here
    mixed = f"<html><body><div class=box><p>A note.</p></div><article>{nested}</article></body></html>"
    assert html_extract.extract(mixed, ["/html/body/div.box"]) == whole
    assert html_extract.extract("<html><body><div class=box><p>All of it.</p></div></body></html>", ["/html/body/article", "/html/body/div.box"]) == "All of it."


def test_html_mixed_layouts_of_a_host(spark):
    body = "body text " * 100
    box = f"<html><body><div class=box><p>{body}</p></div></body></html>"
    other = f"<html><body><div class=box><p>A note.</p></div><article><h1>H</h1><p>{body}</p></article></body></html>"
    pages = spark.createDataFrame([(i, "http://a.b/", box if i < 8 else other) for i in range(10)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(pages).collect()}
    assert got[0] == body.strip() and got[9] == f"H\n{body.strip()}"


def test_html_clutter_names():
    body = "body text " * 100
    side = "<div class=sidebar><p>side</p></div>"
    for said in ('class="content has-sidebar"', "class=no-sidebar", 'class="main with-header"', "id=search-results"):
        assert html_extract.extract(f"<body><div {said}><h1>H</h1><p>{body}</p></div>{side}</body>", None) == f"H\n{body.strip()}"
    assert html_extract.extract(f"<body><span id=search-results><h1>H</h1><p>{body}</p></span>{side}</body>", None) == f"H\n{body.strip()}"
    assert html_extract.extract(f"<body><div class=widget><main><p>Short.</p></main></div><p>{body}</p></body>", None).startswith("Short.")
    # what is clutter stays clutter, also if it is longer than the article
    for said in ("class=ad", "id=comments", "class=related-posts", "class=sidebar", "hidden"):
        assert html_extract.extract(f"<body><article><p>Short.</p></article><div {said}><article><p>{body}</p></article></div></body>", None) == "Short."
    assert html_extract.extract("<article><p class=ad>Buy<p>One</p><p>Two</p></article>", None) == "One\nTwo"
    assert html_extract.extract("<article><p hidden>Buy<p>One<ul><li hidden>x<li>y</ul><dl><dt class=ad>a<dd>b</dl>"
                                "<table><tr hidden><td>c<tr><td>d</table></article>", None) == "One\ny\nb\nd"


def test_empty_tables(spark):
    d = docs(spark, [])
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert jaccard_join.link_classes(d).count() == 0 and substring_dedup.strip_repeats(d).count() == 0
    assert decontaminate.contamination(d, bench).count() == 0 and licenses.scan(d).count() == 0 and secrets.scan(d).count() == 0
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    assert html_extract.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
    some = docs(spark, [(1, "a b c", None, None)])
    assert decontaminate.contamination(some, bench).first()["contaminated"] is False


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).cache()
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    poor = {r["doc_id"] for r in quality.op6_quality(spark, sf).where("predicted = 0").collect()}
    leaked = {r["doc_id"] for r in decontaminate.op10_decontamination(spark, sf).where("contaminated").collect()}
    assert ids and not ids & poor and not ids & leaked and ids <= {r["doc_id"] for r in source.select("doc_id").collect()}
    left = jaccard_join.link_classes(out.dropDuplicates(["doc_id"]))
    assert left.where("component_id <> doc_id").count() == 0
    assert not [r for r in out.select("text").collect() if secrets.scan_text(r["text"])]
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and set(source.columns) <= set(out.columns)
    assert fold("doc_id", 4) is not None


def test_repeated_rows_are_contaminated_one_by_one(spark):
    bench = spark.createDataFrame([(1, "a b c d"), (2, "z")], "item_id bigint, text string")
    d = docs(spark, [(1, "x a b c d", None, None)] * 3 + [(1, "clean", None, None), (None, "a b c d", None, None), (2, None, None, None)] * 2)
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(d, bench, window=4).collect())
    assert got == [(0, 4, 4, 1)] * 2 + [(1, 1, 0, 0)] * 2 + [(1, 5, 4, 1)] * 3 + [(2, 0, 0, 0)] * 2


def test_mixing_never_repeats_beyond_the_limit(spark):
    rng = random.Random(8)
    d = docs(spark, [(i, sentence(rng, 9), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(600)])
    got = mixing.mixed(d, budget_ratio=10.0, max_repeats=4)
    assert got.groupBy("doc_id").count().agg(F.max("count"), F.min("count")).first() == (4, 4)
    short = {r["source"]: r["s"] for r in got.groupBy("source").agg(F.max("mix_shortfall").alias("s")).collect()}
    assert sum(short.values()) == 600 * 9 * 10 - 600 * 9 * 4
    assert mixing.mixed(d).agg(F.max("mix_shortfall")).first()[0] == 0


def test_vectors_of_any_scale(spark):
    base = [[1.0, 1.0], [3.0, 1.0], [1.0, -1.0]]
    rows = [(10 * k + i, [x * s for x in v], 0) for k, s in enumerate((1e-200, 1.0, 1e200, 1e-310)) for i, v in enumerate(base)]
    rows += [(100, [0.0, 0.0], 0), (10, [1.0, 1.0], 0), (101, None, 0)]  # a repeated row links as one vector
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())
    want = [(10 * k + i, 3, i) for k in range(4) for i in range(3)] + [(10, 3, 0), (100, 0, 100), (101, 0, 101)]
    assert got == sorted(want)


def test_pipeline_stages_judge_rows_by_id_and_text(spark):
    rng = random.Random(3)
    one, two, three = (sentence(rng, 40) for _ in range(3))
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").where("text is not null").first()["text"]
    near = one.split()
    near[-1] = "other"
    rows = [(5, one, "en", "s"), (7, " ".join(near), "en", "s"), (7, two, "en", "s"), (7, two, "en", "s"), (None, one, "en", "s"), (None, three, "en", None),
            (8, None, None, None), (8, None, None, None), (9, "", "en", "s"), (10, one + " " + item, "en", "s"), (10, three + " end of it", "en", "s"),
            (None, item, "en", "s")]
    d = docs(spark, rows).withColumnRenamed("id", "_id")
    left = corpus_pipeline.one_of_each(spark, d, "/root/testdata/sf0.001")
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:20]) for r in left.collect())
    assert left.columns == d.columns
    assert got == sorted([(5, one[:20]), (7, two[:20]), (8, ""), (8, ""), (9, ""), (10, one[:20]), (10, three[:20]), (0, item[:20]), (0, one[:20]), (0, three[:20])])
    clean = corpus_pipeline.decontaminated(spark, d, "/root/testdata/sf0.001")
    assert clean.columns == d.columns and clean.count() == 10 and sorted(r[0] for r in clean.where("doc_id = 10").select("text").collect()) == [three + " end of it"]
    empty = d.limit(0)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name
    assert corpus_pipeline.without_secrets(spark, d, "").count() == len(rows)


@pytest.mark.parametrize("page", [
    "<p x='" * 20_000, "<div>" * 50_000 + "x", "<p" * 100_000, "<p" * 100_000 + ">", "<span class=ad>x" * 20_000, "<a b=\"'c" * 30_000 + ">",
    "".join(f"<x{i} class=ad>x" for i in range(20_000)), "<div>" * 20_000 + "</section>" * 40_000, "<ul><li>some text here" * 10_000, "<!x" * 100_000])
def test_broken_and_deep_pages_take_linear_time(page):
    import time
    start = time.process_time()
    html_extract.extract(page, None)
    assert time.process_time() - start < 5


def test_articles_within_forms_noscript_and_odd_names():
    body = "body text " * 100
    whole = f"H\n{body.strip()}"
    art = f"<h1>H</h1><p>{body}</p>"
    search = "<form class=search><label>Find</label><input><p>in all</p></form>"
    for page in (f"<body><form id=aspnet><input type=hidden>{art}<button>go</button></form></body>", f"<body><form><article>{art}</article></form></body>",
                 f"<body><noscript><article>{art}</article></noscript></body>", f"<body>{search}<article>{art}{search}</article><noscript>no script</noscript></body>"):
        assert html_extract.extract(page, None) == whole
    lead = "lead text " * 20
    page = f"<body><article><header><h1>H</h1><p>{lead}</p><p>by me</p></header><p>{body}</p></article></body>"
    assert html_extract.extract(page, None) == f"H\n{lead.strip()}\n{body.strip()}"
    odd = "a paragraph of some length that says what the share price did in the year, and why it did"
    page = f"<body><article>{art}<div class=share-price><p>{odd}</p></div><p class=search-engine>{odd}</p><section id=notice-period><p>{odd}</p></section></article></body>"
    assert html_extract.extract(page, None) == "\n".join([whole] + [odd] * 3)
    page = f"<body><article>{art}<div class=share><p>{odd}</p></div><div class=social-share><p>{odd}</p></div><div class=share-links><a href=x>{odd}</a></div><p class=share-price>up</p><div class=related-posts><p>{odd}</p></div></article></body>"
    assert html_extract.extract(page, None) == whole


def test_pages_are_extracted_like_their_known_layout(spark):
    """Every page of sf0.1 through the operator equals a plain extraction by its marked-up article."""
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r["text"] for r in html_extract.op4_html_extraction(spark, sf).collect()}
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        blocks = [b for b in got[i].split("\n") if b]
        visible = " ".join(re.sub(r"<[^>]*>", "", __import__("html").unescape(page)).split())
        assert all(" ".join(b.split()) in visible for b in blocks) or "&lt;" in page


def given(spark, sf="/root/testdata/sf0.01"):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_base_secrets_against_their_patterns(spark):
    patterns = [("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?((?-i:[A-Za-z0-9+/_.=-]+))", 2, 12),
                ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
    got = {r["doc_id"]: r for r in secrets.op5_secrets(spark, "/root/testdata/sf0.01").collect()}
    texts = given(spark)
    assert len(got) == len(texts)
    for i, text in texts:
        found = []
        for rank, (kind, pattern, group, least) in enumerate(patterns):
            found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
        r = got[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(f[1] == k for f in found) for k in range(3)]
        joined = ",".join(f[2] for f in sorted(found))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert {f[2] for f in found} <= set(r["spans"].split(","))


def test_base_licenses_against_their_words(spark):
    got = {r["doc_id"]: r for r in licenses.op8_licenses(spark, "/root/testdata/sf0.01").collect()}
    for i, text in given(spark):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = []
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            p = phrase.split()
            places += [(k, label) for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
        r, at = got[i], [k for k, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(at), min(at, default=None), max(at, default=None))
        base = {label for _, label in places}
        assert r["base_labels"] == ",".join(sorted(base)) and base <= set(r["labels"].split(",")) | ({""} - base)
        assert 0 <= r["score"] <= 1


def test_language_sample_is_bounded_for_null_and_repeated_ids(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("id"),
                                    F.concat(F.lit("text "), F.when(F.col("id") % 9 < 7, F.col("id")).otherwise(F.lit(1))).alias("text"), F.lit("en").alias("lang"))
    drawn = language_id.sampled(rows, [("en", 9000)], 500)
    assert 300 < drawn.count() < 800 and drawn.count() == drawn.distinct().count()


def test_quality_sample_is_bounded(spark):
    rows = [(i, f"word {i} " * (1 + i % 7), "en", "s") for i in range(400)] + [(5, f"other {i}", "en", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, quality int")
    got = quality.score_quality(docs(spark, rows), labels, F.lit(True), max_rows=100).collect()
    assert len(got) == 600 and all(0 <= r["score"] <= 1 for r in got)


def test_jaccard_hashes_come_by_pieces(spark, monkeypatch):
    class Caught(Exception):
        pass

    def catch(_, bits, hashes):
        raise Caught(hashes)

    monkeypatch.setattr(jaccard_join, "count_table", catch)
    with pytest.raises(Caught) as caught:
        jaccard_join.link_classes(docs(spark, [(1, "a b c", "en", "web")]), k=3)
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(3000)] + [None, "", "one two"]
    out = list(caught.value.args[0](pa.RecordBatch.from_pydict({"text": pa.array(texts)})))
    assert sum(map(len, out)) == 3000 * 198 + 1  # of a batch of 5 MB no more than a piece is held
    assert len(out) > 3 and max(x.nbytes for x in out) < 2 << 20


def test_texts_are_handed_on_by_slices():
    class Frame:
        columns = ["doc_id", "text"]
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            raise Caught(run)

    class Caught(Exception):
        pass

    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(3000)] + [None, "", "é one", "token = abcdefghijkl12", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    assert [t for s in words.slices(batch.slice(2), "text") for t in s["text"].to_pylist()] == texts[2:]
    assert not list(words.slices(batch.slice(0, 0), 1))
    assert max(len(w.data) for _, _, w in words.pieces(batch["text"], words.SPACED)) <= 1 << 18
    with pytest.raises(Caught) as caught:
        secrets.redacted(Frame())
    out = list(caught.value.args[0](iter([batch])))
    assert [t for b in out for t in b["text"].to_pylist()] == [*texts[:-2], "[secret]", None]
    assert len(out) > 3 and max(b.nbytes for b in out) < 2 << 20  # of a batch of 5 MB


def _jobs(spark, group, run):
    """What run() returns, and the number of Spark jobs it took."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rules_are_fitted_in_the_memory_of_one_matrix():
    rng = np.random.default_rng(3)
    x = rng.random((quality.MAX_ROWS, len(quality.STATS)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.random(len(x)) > 0.9).astype(float)
    tracemalloc.start()
    try:
        rules = quality.fit_rules(x, y)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(rules.rules) > 50
    assert peak < 100e6  # 30 trees of 14 paths: 67 MB for 20,000 rows


def test_settled_components_take_no_round(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(common, "checkpointed", lambda df, f=common.checkpointed: kept.append(df) or f(df))
    stars = spark.createDataFrame([(1, i) for i in range(2, 30)] + [(i, 40) for i in range(41, 60)], "a bigint, b bigint")
    assert {(r["id"], r["component"]) for r in components(stars).collect()} == {(i, 1) for i in range(2, 30)} | {(i, 40) for i in range(41, 60)}
    assert len(kept) == 1
    rng, edges, low = random.Random(8), [], {i: i for i in range(300)}
    for _ in range(260):
        a, b = rng.randrange(300), rng.randrange(300)
        edges.append((a, b))
        low = {i: min(low[a], low[b]) if low[i] in (low[a], low[b]) else low[i] for i in low}
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(i, i) == low[i] for i in low)


def test_bitmaps_reach_the_driver_as_one(spark):
    values = common.checkpointed(spark.range(0, 3_000, 3, 20))
    flags, jobs = _jobs(spark, "bitmap", lambda: Bitmap.of(values, 16))
    assert flags.may_hold(np.arange(0, 3_000, 3)).all() and flags.may_hold(np.arange(10_000, 20_000)).sum() < 500
    assert jobs <= 4  # one for each exchange; eight more when the driver asked task by task
    assert not Bitmap.of(values.where("id < 0"), 16).may_hold(np.arange(100)).any()


def test_exponent_answers_several_steps_a_job(spark):
    tokens = [5, 70, 900, 12_000]
    sources = common.checkpointed(spark.createDataFrame([(str(t), t) for t in tokens], "_llm_source string, tokens bigint"))
    total = sum(tokens)
    for budget, gain, most in ((total, 0.5, 4.0), (total, 0.9, 100.0), (3 * total, 0.2, 3.5)):
        def measures(a, budget=budget):
            z = sum((t / total) ** a for t in tokens)
            w = [(t / total) ** a / z for t in tokens]
            return -sum(x * math.log(x) for x in w), max(x * budget / t for x, t in zip(w, tokens))

        low, high = 0.0, 1.0
        target = measures(1.0)[0] + gain * (measures(0.0)[0] - measures(1.0)[0])
        while high - low >= 1e-7:
            mid = (low + high) / 2
            h, repeats = measures(mid)
            low, high = (low, mid) if h <= target and repeats <= most else (mid, high)
        got, jobs = _jobs(spark, f"exponent {budget} {gain}", lambda b=budget, g=gain, m=most: mixing.exponent(sources, b, g, m))
        assert abs(got - high) < 2e-7
        assert jobs < 25


def test_salted_component_ids_are_not_broadcast(spark, monkeypatch):
    plans = []

    def seen(df, f=jaccard_join.checkpointed):
        out = f(df)
        if "_salt" in (plan := df._jdf.queryExecution().executedPlan().toString()):
            plans.append(plan)
        return out

    monkeypatch.setattr(jaccard_join, "checkpointed", seen)
    rows = [(i, f"some words that stand in the copies of text {i % 40}", "en", "s") for i in range(200)]
    assert {r["doc_id"] for r in jaccard_join.without_copies(docs(spark, rows)).collect()} == set(range(40))
    assert plans and all("SortMergeJoin" in x and "BroadcastHashJoin" not in x for x in plans)
