"""License scan by diagonal voting.

Words are lower-cased runs of ASCII letters, digits and characters beyond
ASCII. All rolling k-word hashes of the documents are joined in Spark with
the places of the same k words in license templates. A hit at document word
p and template word t votes for the diagonal p - t. Votes are added up by
(document, template, diagonal); a diagonal joins every earlier one that is near
in shift and place, as single inserted or dropped words make them, whatever
diagonals a template's repeated phrases put between them; a joined group is a
finding when the template words it covers are a large enough part of the
template.

Templates are the library's own constants, so their table is small and
broadcast; a bitmap of their hashes, of fixed size, keeps other document
hashes from leaving the scan task. Base phrases are counted in the same scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import checkpointed, table
from llm.words import ALNUM, Words, hash_run, hash_word, pieces

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Openings of public license texts.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
              "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
              "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
              "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
           "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
           "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
           "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
           "distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
           "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

BITMAP_BITS = 20


def template_places(spark: SparkSession, templates: dict[str, str], k: int) -> DataFrame:
    """(hash, template, t, size): every k-word place of every template."""
    rows = []
    for name, text in templates.items():
        w = Words.of([text], ALNUM)
        rows += [(int(np.int64(np.uint64(h).astype(np.int64))), name, t, len(w.hashes)) for t, h in enumerate(w.runs(k))]
    return spark.createDataFrame(rows, "hash bigint, template string, t int, size int")


def joined(runs: list[dict], k: int, max_shift: int) -> list[tuple[int, int, int]]:
    """(start, end, covered template words) of every group of diagonals; ``runs``
    has (from, diagonal, to, ts) in order of ``from``."""
    group = list(range(len(runs)))

    def of(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    earlier: dict[int, int] = {}
    for i, r in enumerate(runs):
        for shift in range(-max_shift, max_shift + 1):
            j = earlier.get(r["diagonal"] + shift)
            if j is not None and r["from"] - runs[j]["to"] <= k + 2 * max_shift:
                p, q = sorted((of(i), of(j)))
                group[q] = p
        earlier[r["diagonal"]] = i
    members: dict[int, list[dict]] = {}
    for i, r in enumerate(runs):
        members.setdefault(of(i), []).append(r)
    return [(min(r["from"] for r in g), max(r["to"] for r in g) + k, len({t + x for r in g for t in r["ts"] for x in range(k)}))
            for g in members.values()]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, k: int = 5,
         min_cover: float = 0.5, max_shift: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, findings).

    ``findings`` holds (template, start, end, cover): word spans [start, end)
    and the covered part of the template. ``score`` is the best cover, and at
    least 0.5 where a base phrase stands. Null and empty texts have no words,
    empty labels and score 0. One row per input row, also for null ids and
    repeated rows; equal texts share their findings. Other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    spark = docs.sparkSession
    places = template_places(spark, templates, k)
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    low = np.uint64((1 << BITMAP_BITS) - 1)
    for text in templates.values():
        bits[(Words.of([text], ALNUM).runs(k) & low).astype(np.int64)] = True
    bitmap = spark.sparkContext.broadcast(np.packbits(bits))
    wanted = [(len(p.split()), np.uint64(hash_run([hash_word(x, ALNUM) for x in p.split()])), label) for p, label in phrases.items()]

    def run(batches):
        seen = np.unpackbits(bitmap.value).astype(bool)
        for b in batches:
            for lo, hi, w in pieces(b["text"], ALNUM):
                n = hi - lo
                base, first, last = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
                labels = [set() for _ in range(n)]
                for size, h, label in wanted:
                    at = np.flatnonzero((w.runs(size) == h) & w.run_ok(size))
                    doc = np.searchsorted(w.first, at, side="right") - 1
                    for p, d in zip((at - w.first[doc]).tolist(), doc.tolist()):
                        base[d] += 1
                        first[d] = p if first[d] < 0 else min(first[d], p)
                        last[d] = max(last[d], p)
                        labels[d].add(label)
                r = w.runs(k)
                at = np.flatnonzero(seen[(r & low).astype(np.int64)] & w.run_ok(k))
                doc = np.searchsorted(w.first, at, side="right") - 1
                hits = pa.StructArray.from_arrays([pa.array(r[at].astype(np.int64)), pa.array((at - w.first[doc]).astype(np.int32))], names=["hash", "p"])
                cuts = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                none = first < 0
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(lo, n), pa.array(w.whole().astype(np.int64)), pa.array(w.counts().astype(np.int64)), pa.array(base),
                     pa.array(first, mask=none), pa.array(last, mask=none), pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                     pa.ListArray.from_arrays(cuts, hits)],
                    names=["doc_id", "text_key", "n_words", "n_base", "first_word", "last_word", "base", "hits"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = checkpointed(src.mapInArrow(run, "doc_id bigint, text_key bigint, n_words bigint, n_base bigint, first_word bigint, "
                                            "last_word bigint, base array<string>, hits array<struct<hash:bigint,p:int>>"))
    hits = (rows.where(F.size("hits") > 0).dropDuplicates(["doc_id", "text_key"])
            .select("doc_id", "text_key", F.explode("hits").alias("h")).select("doc_id", "text_key", "h.hash", "h.p"))
    votes = (hits.join(F.broadcast(places), "hash").withColumn("diagonal", F.col("p") - F.col("t"))
             .groupBy("doc_id", "text_key", "template", "size", "diagonal")
             .agg(F.min("p").alias("from"), F.max("p").alias("to"), F.collect_set("t").alias("ts")))
    # a group covers k words a vote at most, so others cannot reach min_cover
    together = (votes.groupBy("doc_id", "text_key", "template", "size")
                .agg(F.sort_array(F.collect_list(F.struct("from", "diagonal", "to", "ts"))).alias("runs"), F.sum(F.size("ts")).alias("n"))
                .where(F.col("n") * k >= F.col("size") * min_cover))

    def join(batches):
        for b in batches:
            at, out = [], []
            for i, (size, runs) in enumerate(zip(b["size"].to_pylist(), b["runs"].to_pylist())):
                for start, end, words in joined(runs, k, max_shift):
                    if words / size >= min_cover:
                        at.append(i)
                        out.append((start, end, words / size))
            rows = pa.array(at, pa.int64())
            start, end, cover = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(b[c].take(rows) for c in ("doc_id", "text_key", "template")), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                 pa.array(cover, pa.float64())], names=["doc_id", "text_key", "template", "start", "end", "cover"])

    merged = (together.select("doc_id", "text_key", "template", "size", "runs")
              .mapInArrow(join, "doc_id bigint, text_key bigint, template string, start int, end int, cover double"))
    found = (merged.groupBy("doc_id", "text_key")
             .agg(F.sort_array(F.collect_list(F.struct("template", "start", "end", "cover"))).alias("findings"), F.max("cover").alias("best")))
    one = rows.drop("hits").alias("r").join(
        found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.text_key") == F.col("f.text_key")), "left")
    mine = F.coalesce(F.transform("findings", lambda x: x["template"]), F.array().cast("array<string>"))
    return one.select("r.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.array_union("base", mine)), ",").alias("labels"),
                      F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"), "findings")


def op8_licenses(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("findings")
