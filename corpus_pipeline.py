"""The corpus pipeline: documents, stage by stage, to a mixed training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadsmith.session import checkpoint_dir
from llm import decontaminate, jaccard_join, mixing, quality, secrets
from llm.common import fold, row_key, table


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts (score 0.7 or more). Null and
    empty texts are scored like any other; repeated rows and null ids each by their text."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), fold("id", 4) != 2)


def one_of_each(spark, docs, sf_dir):
    """One document, the one with the smallest id, of each near-duplicate group
    (five-word shingles, Jaccard similarity 0.8 or more). A document is an id
    and a text; of equal rows one stays. Documents without words and rows
    with a null id stay."""
    return jaccard_join.without_copies(docs)


def decontaminated(spark, docs, sf_dir):
    """Documents without ten consecutive words of a benchmark item. Each row is
    judged by its own text, whatever its id; null and empty texts stay."""
    keyed = docs.withColumn("_llm_key", row_key("doc_id", "text"))
    found = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="_llm_key")
    hit = found.where("contaminated").select(F.col("doc_id").alias("_llm_key")).distinct()
    return keyed.join(hit, "_llm_key", "left_anti").select(*docs.columns)


def without_secrets(spark, docs, sf_dir):
    """All documents, secrets in the text replaced by a mark; n_chars follows the
    text. A null text stays null, and so does its n_chars."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixed_sources(spark, docs, sf_dir):
    """Copies of documents drawn to temperature-mixed source weights. A null source
    is a source; documents without tokens go with their leaf."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing sources", mixed_sources),
]

ORACLE_SQL = None  # the classifier is fitted, which SQL cannot express; tests/llm checks run() against brute force


def run(spark, sf_dir):
    """The stages applied to ``documents``, each result written to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
