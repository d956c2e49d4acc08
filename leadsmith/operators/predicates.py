"""Row predicates and reason columns.

Predicates are Column expressions, so Catalyst can push the parts that
touch scan columns into the Parquet reader and keep the rest in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.functions.text import (_c, before_separator, contains_any, endswith_any, nonblank,
                                      startswith_any, strip, to_int_truncated)

# Mailbox prefixes that mark a role address, and personal
# mail providers (the carrier pitch-list defaults).
ROLE_PREFIXES = ["info@", "dispatch@", "office@", "admin@", "sales@", "contact@", "safety@", "billing@"]
PERSONAL_DOMAINS = ["@gmail.com", "@yahoo.com", "@hotmail.com", "@aol.com", "@outlook.com", "@icloud.com",
                    "@msn.com", "@live.com"]

# Restricted domain suffixes for the clinic bridge.
RESTRICTED_SUFFIXES = [".gov", ".edu", ".uk", ".ca", ".au", ".nz"]

# A listing that looks like a person's name, and the words
# that mark it as a business anyway.
PERSON_NAME_RE = r"^(?:[A-Z][a-z]+\.?\s+){1,2}[A-Z][a-z]+$"
BUSINESS_WORDS_RE = (r"(?i)\b(equipment|sales|supply|service|machinery|tractor|rental|"
                     r"parts|inc|llc|corp|co\b|bros|brothers|sons|enterprises|group|"
                     r"solutions|systems|industries|international|midwest|national)\b")


def in_range(x, lo: float, hi: float) -> Column:
    """F2 + F3: coerce, truncate, then closed range (50.9 -> 50 is kept, C6).

    ``lo <= v <= hi`` is written as one comparison on the distance from the
    midpoint, so the coercion chain is referenced once: a filter pushed into
    the scan gets no common-subexpression elimination, and ``between``
    would evaluate it twice."""
    v = to_int_truncated(x).cast("double")
    return F.coalesce(F.abs(v * 2.0 - float(lo + hi)) <= float(hi - lo), F.lit(False))


def role_address(email) -> Column:
    """F8 (on stripped text, C21)."""
    return startswith_any(strip(_c(email)), ROLE_PREFIXES)


def personal_address(email) -> Column:
    """F9 (on stripped text, C21)."""
    return endswith_any(strip(_c(email)), PERSONAL_DOMAINS)


def excluded_company(name, excluded: Sequence[str], sep: str = " - ") -> Column:
    """F10 + F11: excluded substring in the name before the separator, or a
    bare person's name without a business word."""
    base = strip(before_separator(name, sep))
    return contains_any(base, excluded) | looks_like_person(base)


def looks_like_person(name) -> Column:
    """F11."""
    n = F.coalesce(_c(name), F.lit(""))
    return n.rlike(PERSON_NAME_RE) & ~n.rlike(BUSINESS_WORDS_RE)


def bad_address(addr, min_len: int = 6) -> Column:
    """blank, digits only, or shorter than ``min_len`` (C7: parameter)."""
    s = strip(F.coalesce(_c(addr), F.lit("")))
    return (s == "") | s.rlike("^[0-9]+$") | (F.length(s) < min_len)


def eligibility(domain, blocked: Column, no_domain: str = "no_domain", blocked_label: str = "blocked") -> Column:
    """one reason column: no domain, blocked, or ok."""
    return (F.when(~nonblank(domain), F.lit(no_domain))
            .when(blocked, F.lit(blocked_label))
            .otherwise(F.lit("ok")))


def needs_work(domain, name, email) -> Column:
    """F16: has a domain but neither a contact name nor an e-mail yet."""
    return nonblank(domain) & ~nonblank(name) & ~nonblank(email)


def filter_counted(df: DataFrame, keep: Column, label: str = "kept", counters=None) -> tuple[DataFrame, DataFrame]:
    """F13 with counts: (kept rows, one-row kept/removed counts).

    The counts are a second pass over ``df``. With ``counters`` (a
    ``StageCounters``) there is one: the rows, each with its verdict, are
    written once to the shared folder and counted by that job. Rows whose
    test is NULL are removed and counted in neither, as ``where`` drops them.
    """
    if counters is not None:
        settled = counters.settle(df.withColumn("_keep", keep), "filter", **{f"n_{label}": F.col("_keep"), "n_removed": ~F.col("_keep")})
        found = counters.counts()["filter"]
        one = df.sparkSession.createDataFrame([(found[f"n_{label}"], found["n_removed"])], f"n_{label} bigint, n_removed bigint")
        return settled.where("_keep").drop("_keep"), one
    counts = df.agg(F.count_if(keep).alias(f"n_{label}"), F.count_if(~keep).alias("n_removed"))
    return df.where(keep), counts
