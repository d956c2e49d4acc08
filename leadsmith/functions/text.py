"""Column -> Column text helpers.

Every function returns a native Spark expression so it stays inside
whole-stage codegen. Patterns are kept to the subset Java regex and RE2
(the DuckDB oracle) agree on.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.strip()`` removes that matter
# for registry text (ASCII whitespace, NEL, NBSP, the Unicode spaces and the
# line/paragraph separators, and the four information separators).
WS_CLASS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same characters as a plain set, for the native (linear-time) trims.
WS_CHARS = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Unicode-aware strip (plain ``trim`` only removes spaces).

    ``btrim`` with an explicit character set is native and linear; an
    anchored ``\\s+$`` regex backtracks quadratically on long space runs."""
    return F.btrim(_c(x), F.lit(WS_CHARS))


def rstrip(x) -> Column:
    """Trailing whitespace only (``str.rstrip()``)."""
    return F.rtrim(_c(x), F.lit(WS_CHARS))


def collapse_ws(x) -> Column:
    """Runs of whitespace -> one space, then strip."""
    return strip(F.regexp_replace(_c(x), f"{WS_CLASS}+", " "))


def blank_to_null(x) -> Column:
    """'' or whitespace-only -> NULL (the reference's missing marker)."""
    c = _c(x)
    return F.when(strip(c) != "", c)


def nonblank(x) -> Column:
    """non-blank after strip; NULL counts as blank."""
    return F.coalesce(strip(_c(x)) != "", F.lit(False))


# Fixed value: what the numeric coercion accepts (pandas ``to_numeric``
# style decimal or exponent notation, optional sign).
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(x) -> Column:
    """Text -> double, NULL when not a finite number.

    Spark would accept '5d' or 'Infinity'; the regex guard rejects them.
    """
    # one reference to the input: the match itself is cast (no second
    # evaluation of a possibly costly argument such as a JSON extraction)
    matched = F.regexp_extract(strip(_c(x).cast("string")), "(" + NUMERIC_RE + ")", 1)
    return matched.try_cast("double")  # no match -> '' -> NULL


def to_int_truncated(x) -> Column:
    """F2: coerce, then truncate toward zero (50.9 -> 50)."""
    return to_number(x).try_cast("bigint")  # beyond bigint: NULL


def to_long_opt(x) -> Column:
    """Optional integer string -> bigint, NULL when absent or bad."""
    return strip(_c(x).cast("string")).try_cast("bigint")


def round_half_up(x, digits: int) -> Column:
    """Spark ``round`` is half away from zero, like DuckDB.

    Python's ``round`` is half-to-even on the binary value; recorded as a
    deviation in the README.
    """
    return F.round(_c(x), digits)


def keyword_rank(x, keywords: Sequence[str], default: int = 99) -> Column:
    """Index of the first keyword (list order) contained in lower(x)."""
    low = F.lower(F.coalesce(_c(x), F.lit("")))
    expr = F.lit(default)
    for i in reversed(range(len(keywords))):
        expr = F.when(low.contains(keywords[i].lower()), F.lit(i)).otherwise(expr)
    return expr


def _literal(s: str) -> str:
    """A Java-regex literal for ``s``."""
    if "\\E" not in s:
        return "\\Q" + s + "\\E"
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def _any_of(needles: Sequence[str], lower: bool) -> str:
    return "(?:" + "|".join(_literal(n.lower() if lower else n) for n in needles) + ")"


# Lists are matched with one regex of quoted literals rather than an OR of
# ``contains``: the input expression is then evaluated once per row even in
# a filter pushed into the scan, where Spark applies no common-subexpression
# elimination (an OR of k tests would re-derive e.g. a URL's domain k times).

def contains_any(x, needles: Sequence[str], lower: bool = True) -> Column:
    """any needle is a substring."""
    c = F.coalesce(_c(x), F.lit(""))
    if lower:
        c = F.lower(c)
    if not needles:
        return F.lit(False)
    if len(needles) == 1:
        return c.contains(needles[0].lower() if lower else needles[0])
    return c.rlike(_any_of(needles, lower))


def startswith_any(x, prefixes: Sequence[str]) -> Column:
    """F8: lower(x) starts with any prefix."""
    c = F.lower(F.coalesce(_c(x), F.lit("")))
    if not prefixes:
        return F.lit(False)
    return c.rlike("^" + _any_of(prefixes, True))


def endswith_any(x, suffixes: Sequence[str]) -> Column:
    """lower(x) ends with any suffix (``\\z``: the very end, unlike ``$``)."""
    c = F.lower(F.coalesce(_c(x), F.lit("")))
    if not suffixes:
        return F.lit(False)
    return c.rlike(_any_of(suffixes, True) + "\\z")


def full_name(first, last) -> Column:
    """First + ' ' + last, stripped; NULL parts count as ''."""
    return strip(F.concat_ws(" ", F.coalesce(_c(first), F.lit("")), F.coalesce(_c(last), F.lit(""))))


def before_separator(x, sep: str = " - ") -> Column:
    """Text before the first separator (whole text when absent)."""
    return F.split_part(_c(x), F.lit(sep), F.lit(1))


def company_key(x) -> Column:
    """Lower, drop legal/industry words, keep [a-z0-9 ], collapse."""
    low = F.lower(F.coalesce(_c(x), F.lit("")))
    no_words = F.regexp_replace(low, r"\b(" + "|".join(COMPANY_NOISE_WORDS) + r")\b\.?", "")
    only = F.regexp_replace(no_words, r"[^a-z0-9\s]", "")
    return strip(F.regexp_replace(only, r"\s+", " "))


# Words removed from a company name before de-duplication.
COMPANY_NOISE_WORDS = ["inc", "llc", "ltd", "co", "corp", "company", "equipment"]


# Fixed value: the path of a filing in the archive, in any case.
ACCESSION_RE = r"edgar/data/\d+/([^/]+)\.(?:txt|htm|html)$"


def accession(path) -> Column:
    """Accession id from an archive path, else the stripped input."""
    got = F.regexp_extract(_c(path), "(?i)" + ACCESSION_RE, 1)
    return F.coalesce(F.nullif(got, F.lit("")), strip(_c(path)))


def strip_leading_zeros(x) -> Column:
    """N11: '000123' -> '123', '000' -> '0'."""
    return F.coalesce(F.nullif(F.regexp_replace(_c(x), "^0+", ""), F.lit("")), F.lit("0"))


def yyyymmdd_to_iso(x) -> Column:
    """Slice 'YYYYMMDD' into 'YYYY-MM-DD' without validation."""
    c = _c(x)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def quarter_label(d) -> Column:
    """N13: 'QTR1'..'QTR4'."""
    return F.concat(F.lit("QTR"), F.quarter(_c(d)).cast("string"))


def handle(x) -> Column:
    """Strip and put one '@' before a handle without one; blank is NULL."""
    s = strip(_c(x))
    return F.when(s.startswith("@"), s).when(s != "", F.concat(F.lit("@"), s))


def truncate(x, n: int) -> Column:
    """First n characters (code points)."""
    return F.left(_c(x), F.lit(n))


def clamp(x, lo: int, hi: int) -> Column:
    """N17."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def extract_emails(x) -> Column:
    """All e-mail addresses in a text, in order. Texts without an '@'
    (most of them) skip the regex scan entirely."""
    c = _c(x)
    return F.when(c.contains("@"), F.regexp_extract_all(c, F.lit(EMAIL_RE), 0)) \
            .otherwise(F.array().cast("array<string>"))


def ensure_scheme(x, scheme: str = "https://") -> Column:
    """Prefix a scheme when the URL has none."""
    c = _c(x)
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit(scheme), c))


def provenance(value, label: str) -> Column:
    """Label when the value is present, else ''."""
    return F.when(nonblank(value), F.lit(label)).otherwise(F.lit(""))


def city_state_zip(x, default_state: str = "") -> tuple[Column, Column, Column]:
    """R8: 'City, ST 12345' -> (city, state, zip); state defaults.
    A line without a comma has no city."""
    parts = F.split(_c(x), ",", 2)
    city = F.when(F.size(parts) > 1, strip(F.get(parts, 0))).when(F.size(parts) == 1, F.lit(""))
    rest = F.split(strip(F.coalesce(F.get(parts, 1), F.lit(""))), r"\s+")
    state = F.coalesce(F.nullif(F.get(rest, 0), F.lit("")), F.lit(default_state))
    zipc = F.coalesce(F.get(rest, 1), F.lit(""))
    return city, state, zipc


def phone(tel_href, text) -> Column:
    """Number from a tel: link, else the visible text."""
    from_link = F.nullif(F.regexp_replace(F.coalesce(_c(tel_href), F.lit("")), "^tel:", ""), F.lit(""))
    return strip(F.coalesce(from_link, _c(text), F.lit("")))


# Professional-title patterns removed from a clinic name, in
# the order they are applied (case-insensitive).
TITLE_PATTERNS = [
    r',?\s+D\.?D\.?S\.?(?:\s|,|$)',
    r',?\s+D\.?M\.?D\.?(?:\s|,|$)',
    r',?\s+D\.?D\.?S\.?,?\s+.*?(?:P\.?C\.?|PLLC|LLC|P\.?A\.?)',
    r',?\s+D\.?D\.?S\.?,?\s+.*?(?:M\.?A\.?|B\.?A\.?|B\.?S\.?)',
    r',?\s+P\.?C\.?(?:\s|$)',
    r',?\s+P\.?L\.?L\.?C\.?(?:\s|$)',
    r',?\s+P\.?A\.?(?:\s|$)',
    r',?\s+LLC\.?(?:\s|$)',
    r'"?\s*"?\s*D\.?D\.?S\.?.*',
    r'"?\s*[A-Z][A-Z\s\.]+DDS',
    r'"?\s*[A-Z][A-Z\s\.]+DMD',
]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element
    ``transform``): CASE branches get no common-subexpression elimination,
    so a costly value read in several branches would be recomputed."""
    return F.get(F.transform(F.array(value), body), 0)


# Fixed value: the quoted part of a clinic name.
QUOTED_RE = r'^"?([^"]+?)(?:"\s+|"$)'


def _quoted_part(s: Column) -> Column:
    quoted = F.regexp_extract(s, QUOTED_RE, 1)
    unquoted = F.regexp_replace(F.regexp_replace(s, '^"', ""), '"$', "")
    return F.when(~s.contains('"'), s).when(quoted != "", strip(quoted)).otherwise(unquoted)


def clean_title_name(x) -> Column:
    """Strip, drop a leading quote and leading dots, remove the title
    patterns in order, keep the quoted part when there is a quote, drop a
    trailing quote, collapse whitespace."""
    s = strip(_c(x))
    s = F.regexp_replace(s, r"""^["']""", "")
    s = F.regexp_replace(s, r"^\s*\.\s*", "")
    for p in TITLE_PATTERNS:
        s = F.regexp_replace(s, "(?i)" + p, "")
    s = let(s, _quoted_part)
    s = F.regexp_replace(s, r"""["']$""", "")
    return strip(F.regexp_replace(s, r"\s+", " "))


def title_case(x) -> Column:
    """N14, native: Spark ``initcap`` (capitalises after spaces only)."""
    return F.initcap(_c(x))


def _title_batch(s: pd.Series) -> pd.Series:
    return s.str.title()


def title_case_exact(x) -> Column:
    """N14, exact ``str.title`` (capitalises after any non-letter, so
    "o'brien" -> "O'Brien", "smith-jones" -> "Smith-Jones"), as an
    Arrow-batched pandas UDF for callers who need the reference's spelling."""
    udf = F.pandas_udf(_title_batch, "string")
    return udf(_c(x))
