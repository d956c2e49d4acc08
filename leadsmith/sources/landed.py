"""Scans of landed service responses and files.

The reference fetched registry pages, indexes, filings and web pages over
HTTP one at a time. Here they are files that were landed beforehand and
are read as DataFrames: Spark splits and parallelises the scans.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsmith.functions.text import _c, nonblank, rstrip, strip, strip_leading_zeros

# --- S1 / S2: paged registry -------------------------------------------------


def registry_pages(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed JSON pages (``state=../page=..`` folders) with an explicit
    schema: no inference pass, partition pruning on state."""
    return spark.read.schema(schema).json(path)


def page_prefix(df: DataFrame, key: str, page: str, page_size: int, first_page: int = 0, cut: bool = True) -> DataFrame:
    """A key's data ends at its first short page, or before its first
    missing page (a failed fetch returned nothing and ended that key);
    later pages are not part of the result. Adds ``truncated``: rows existed
    after the cut (the reference silently ignored them). ``cut=False`` keeps
    every row and adds ``after_gap``: the row itself stands after the cut
    (both flags are NULL without a key).

    Everything runs on the page-count table (one row per key and page):
    the first missing page is found with a hash anti-join of pages against
    their successors, not with a window over a key's pages, so a key with
    most of the pages is still spread over many tasks.
    """
    counts = df.groupBy(key, page).agg(F.count(F.lit(1)).alias("_n"))
    succ = counts.select(key, (F.col(page) - 1).alias(page))
    ends = counts.join(succ, [key, page], "left_anti")            # pages with no successor
    gaps = ends.groupBy(key).agg((F.min(page) + 1).alias("_gap"))  # first missing page after a present one
    per_key = counts.groupBy(key).agg(
        F.min(F.when(F.col("_n") < page_size, F.col(page))).alias("_short"),
        F.min(page).alias("_first"), F.max(page).alias("_last"))
    stops = per_key.join(gaps, key, "left").select(
        key, "_last",
        # keep pages <= _stop
        F.least(F.coalesce("_short", "_gap"), F.col("_gap") - 1,
                F.when(F.col("_first") > first_page, F.lit(first_page - 1))).alias("_stop"))
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    j = salted_join(df, stops, key, "left", DEFAULT_SALT)  # a hot key is split across tasks
    kept = j.where(F.col(page) <= F.col("_stop")) if cut else j.withColumn("after_gap", F.col(page) > F.col("_stop"))
    return kept.withColumn("truncated", F.col("_last") > F.col("_stop")).drop("_stop", "_last")


# --- S3: nested registry results ---------------------------------------------

REGISTRY_RESULT = ("struct<results:array<struct<basic:struct<organization_name:string>,"
                   "addresses:array<struct<city:string,state:string>>>>>")


def registry_results(pages: DataFrame, json_col: str, order: Sequence[str]) -> DataFrame:
    """S3: ``results[]`` -> name and first address; rows without a name or an
    address are skipped. Keeps ``order`` columns and adds ``pos``."""
    parsed = pages.withColumn("_r", F.from_json(_c(json_col), REGISTRY_RESULT))
    ex = parsed.select(*order, F.posexplode("_r.results").alias("pos", "res"))
    first = F.get(F.col("res.addresses"), 0)
    out = ex.select(*order, "pos", strip(F.col("res.basic.organization_name")).alias("name"),
                    first["city"].alias("city"), first["state"].alias("state"))
    return out.where(nonblank("name") & F.col("city").isNotNull())


# --- S4: fixed-width daily index ---------------------------------------------

# Header lines of a daily index that are not data, and the
# number, day and path that end a data line.
INDEX_SKIP_PREFIXES = ["Description:", "Last Data", "Comments:", "Anonymous", "Form Type"]
INDEX_TAIL_RE = r"(\d{7,10})\s+(\d{8})\s+(edgar/data/\S+)\s*$"


def index_rows(lines: DataFrame, line: str = "value", forms: Sequence[str] = ("D", "D/A"),
               keep: Sequence[str] = ()) -> DataFrame:
    """S4 + F18: parse fixed-width lines: 12-char form type, name up to the
    trailing ``cik date path``; header, dash and blank lines and other form
    types are dropped. All columnar, no Python.

    The tail regex is the only costly expression; it is evaluated once per
    candidate line (the cheap form-type test comes first) and its three
    fields are split out of the match instead of re-running the regex."""
    raw = rstrip(line)
    skip = raw.startswith("-") | (raw == "")
    for p in INDEX_SKIP_PREFIXES:
        skip = skip | raw.startswith(p)
    form = strip(F.substring(raw, 1, 12))
    cand = lines.select(*keep, raw.alias("_l"), form.alias("form_type"), skip.alias("_skip")) \
                .where(~F.col("_skip") & F.col("form_type").isin(list(forms)))
    parsed = cand.select(*keep, "_l", "form_type", F.regexp_extract("_l", INDEX_TAIL_RE, 0).alias("_tail"))
    parts = F.split(F.col("_tail"), r"\s+")
    return parsed.where(F.col("_tail") != "").select(
        *keep, "form_type",
        strip(F.expr("substring(_l, 13, greatest(length(_l) - length(_tail) - 12, 0))")).alias("company_name"),
        strip_leading_zeros(F.get(parts, 0)).alias("cik"),
        F.get(parts, 1).alias("date_filed"),
        F.get(parts, 2).alias("rel_path"))


# --- S5: whole documents ------------------------------------------------------

def whole_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(path, text)``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"),
                                                        F.col("value").alias("text"))


# --- S6 / S7: CSV between stages -------------------------------------------------

def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV, every column a string, NULL -> ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema).fillna("")


def read_csv_inferred(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Inferred types; rows kept only when the required fields are
    non-blank (a missing value is blank, never the text 'nan', C4)."""
    df = spark.read.csv(path, header=True, inferSchema=True)
    cond = F.lit(True)
    for c in required:
        cond = cond & nonblank(F.col(c).cast("string"))
    return df.where(cond)


SAMPLE_LINES = 10_000


def sampled_schema(spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> T.StructType:
    """Types inferred from the first ``lines`` lines (the bound of what is read
    and of what reaches the driver). A header that comes again is not data."""
    head = [r["value"] for r in spark.read.text(path).limit(lines).collect()]
    data = head[:1] + [x for x in head[1:] if x != head[0]]
    return spark.read.csv(spark.sparkContext.parallelize(data, 1), header=True, inferSchema=True).schema


def read_csv_rescued(spark: SparkSession, path: str, required: Sequence[str], schema: T.StructType | None = None,
                     rescued: str = "_rescued", lines: int = SAMPLE_LINES) -> DataFrame:
    """S7 in one pass: types from a bounded sample (or given), and a column
    that holds the whole line of a row that does not fit them.

    A later value of another type, a missing or an extra field makes the row
    a rescued one: fields that fit are read, the others are NULL, and
    nothing is lost. Other rows are kept when their required fields are
    non-blank (C4). Records are lines: quoted line breaks are not read.
    """
    fields = (schema or sampled_schema(spark, path, lines)).fields
    full = T.StructType([*fields, T.StructField(rescued, T.StringType())])
    df = spark.read.csv(path, header=True, schema=full, mode="PERMISSIVE", columnNameOfCorruptRecord=rescued)
    filled = F.lit(True)
    for c in required:
        filled = filled & nonblank(F.col(c).cast("string"))
    return df.where(F.col(rescued).isNotNull() | filled)


# --- S8: inline seed list ----------------------------------------------------

def seed_list(spark: SparkSession, rows: Iterable[tuple], schema: str, head: int | None = None) -> DataFrame:
    """A small configured list with its ordinal; optional head-N."""
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "ordinal int, " + schema)
    return df.orderBy("ordinal").limit(head) if head is not None else df


# --- S9: result-page links -----------------------------------------------------

# Fixed value: a link of a result page.
RESULT_LINK_RE = r'<a rel="noopener noreferrer" class="result__a" href="([^"]+)"[^>]*>([^<]+)</a>'


def result_links(pages: DataFrame, html: str, keep: Sequence[str], cap: int | None = None,
                 pattern: str = RESULT_LINK_RE) -> DataFrame:
    """(href, title) pairs in page order, the first ``cap`` only if
    given, both stripped; empty hrefs dropped after the cap (as the reference)."""
    hrefs = F.regexp_extract_all(_c(html), F.lit(pattern), 1)
    titles = F.regexp_extract_all(_c(html), F.lit(pattern), 2)
    z = pages.select(*keep, F.posexplode(F.arrays_zip(hrefs.alias("href"), titles.alias("title"))).alias("pos", "l"))
    if cap is not None:
        z = z.where(F.col("pos") < cap)
    return z.select(*keep, "pos", strip("l.href").alias("href"),
                                              strip("l.title").alias("title")).where(F.col("href") != "")


# --- S10: directory cards ------------------------------------------------------

CARD_SCHEMA = "page_no int, card_no int, company string, address string, city_line string, tel_href string, phone_text string"


def _cards(batches):
    from leadsmith.sources.cards import parse_cards
    for pdf in batches:
        rows = []
        for page_no, html in zip(pdf["page_no"], pdf["html"]):
            for i, c in enumerate(parse_cards(html or "")):
                rows.append((page_no, i, *c))
        yield pd.DataFrame(rows, columns=["page_no", "card_no", "company", "address", "city_line", "tel_href",
                                          "phone_text"])


def directory_cards(pages: DataFrame) -> DataFrame:
    """Listing-card HTML -> one row per card (stdlib parser per batch)."""
    return pages.select(F.col("page_no").cast("int"), "html").mapInPandas(_cards, CARD_SCHEMA)


# --- S13 / S14: schema guards ---------------------------------------------------

def backfill(df: DataFrame, columns: Sequence[str], value: str = "") -> DataFrame:
    """Add missing columns as ''."""
    missing = {c: F.lit(value) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail at plan time when required columns are absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def select_existing(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """R2/K1: existing columns in a fixed order."""
    return df.select(*[c for c in order if c in df.columns])


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return df.select(*[strip(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])
