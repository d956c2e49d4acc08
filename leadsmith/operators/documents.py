"""Filing, page and scorer-response handling.

HTML with tag removal needs a real parser, so that is an Arrow-batched
pandas UDF over the stdlib ``html.parser``: Spark still partitions the
pages, each task parses its own batch. Everything else is native, filings
(``from_xml``) included.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsmith.functions.text import _c, clamp, let, nonblank, strip, truncate

# --- X1 / X2: location from a filing ---------------------------------------

# The filing's elements and header labels.
_SUBMISSION = "edgarSubmission"
_ISSUER_SCHEMA = ("primaryIssuer array<struct<issuerAddress: array<struct<"
                  "stateOrCountry: array<string>, stateOrCountryDescription: array<string>>>>>, _bad string")
_HEADER_STATE = r"(?m)^\s*STATE:\s*(\S+)"
_INCORPORATION = r"STATE OF INCORPORATION:\s*(\S+)"


def filing_location(text) -> Column:
    """X1/X2, native: the first issuer address with a non-blank state, or a
    non-blank description of it, from the XML part; else the header's
    business-address state; else the state of incorporation; else ''. XML
    that does not parse falls through to the header."""
    content = F.coalesce(_c(text), F.lit(""))
    tail = f"</{_SUBMISSION}>"
    begin = F.instr(content, f"<{_SUBMISSION}")
    # up to the last closing tag: what follows it is cut off
    until = F.length(content) - F.length(F.substring_index(content, tail, -1))
    part = F.when((begin > 0) & (until >= begin), F.substr(content, begin, until - begin + 1))

    none = F.array().cast("array<string>")

    def stated(xml):
        addresses = F.flatten(F.filter(F.transform(xml["primaryIssuer"], lambda i: i["issuerAddress"]), lambda a: a.isNotNull()))
        values = F.flatten(F.transform(addresses, lambda a: F.concat(F.coalesce(a["stateOrCountry"], none),
                                                                     F.coalesce(a["stateOrCountryDescription"], none))))
        return F.when(xml["_bad"].isNull(), strip(F.get(F.filter(values, nonblank), 0)))

    xml = F.from_xml(part, _ISSUER_SCHEMA, {"rowTag": _SUBMISSION, "ignoreNamespace": "true", "mode": "PERMISSIVE",
                                            "columnNameOfCorruptRecord": "_bad"})
    address = F.instr(content, "BUSINESS ADDRESS:")
    header = F.regexp_extract(F.when(address > 0, F.substr(content, address)), _HEADER_STATE, 1)
    return F.coalesce(let(xml, stated), F.nullif(header, F.lit("")), F.regexp_extract(content, _INCORPORATION, 1), F.lit(""))


# --- X3 / X4: visible text of a page ----------------------------------------

# Fixed value: elements whose text is not visible page content.
HIDDEN_TAGS = ("script", "style", "header", "nav", "footer")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
         "track", "wbr"}


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.stack: list[str] = []
        self.tel = 0

    def _hidden(self) -> bool:
        return any(t in HIDDEN_TAGS for t in self.stack)

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        if tag == "a" and not self._hidden():
            href = dict(attrs).get("href") or ""
            if href.startswith("tel:"):
                self.tel += 1
        self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        if tag == "a" and not self._hidden():
            if (dict(attrs).get("href") or "").startswith("tel:"):
                self.tel += 1

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack:
                if self.stack.pop() == tag:
                    break

    def handle_data(self, data):
        if not self._hidden():
            self.parts.append(data)


def visible_text_of(html: str | None) -> tuple[str, int]:
    """Text outside script/style/header/nav/footer, white space as one space;
    plus the count of ``tel:`` links outside those elements."""
    if not html:
        return "", 0
    p = _Visible()
    try:
        p.feed(html)
        p.close()
    except AssertionError:  # a broken declaration: keep what was parsed
        pass
    return " ".join("".join(p.parts).split()), p.tel


VISIBLE_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("tel_count", T.IntegerType())])


def _visible_batch(html: pd.Series) -> pd.DataFrame:
    out = [visible_text_of(h) for h in html]
    return pd.DataFrame({"text": [t for t, _ in out], "tel_count": [n for _, n in out]})


# X3/X4 as one Arrow-batched UDF returning struct<text, tel_count>. Marked
# non-deterministic so a filter on its output does not evaluate it twice
# (SURVEY §4.3); native filters therefore belong in an earlier select.
visible_text = F.pandas_udf(_visible_batch, VISIBLE_SCHEMA).asNondeterministic()


def tel_note(count) -> Column:
    """X4 as a separate projection, never folded into the text."""
    return F.when(_c(count) > 0, F.format_string("%d click-to-call (tel:) links", _c(count)))


# --- X5 / X7: rubric score ---------------------------------------------------
# The scoring logic is a chain of CASE branches. Spark does not share
# subexpressions across CASE branches (they are conditionally evaluated), so
# the costly inputs -- keyword counts over whole texts, JSON extractions --
# are projected as columns first and the branches read those columns.

def occurrences(text, needle: str) -> Column:
    """Non-overlapping occurrences of a literal in lower(text), one pass."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    return F.regexp_count(low, F.lit("\\Q" + needle.lower() + "\\E")).cast("int")


def with_rubric(df: DataFrame, text: str, phone: Sequence[str], forms: Sequence[str], portals: Sequence[str],
                out: str = "score", tel: str | None = None) -> DataFrame:
    """X5 + X7: deterministic tiers, portals checked first.

    tier 3 (portal named) 10-30, tier 1 (phone-first) 90-100, tier 2 (forms)
    70-89, else 1; blank text scores 0 with a reason (X7). ``tel`` is the
    column of click-to-call links (X4): each is phone-first evidence, and a
    page with one is not blank. Adds
    ``out``: struct<icp_score int, booking_system string, reasoning string>.
    """
    def hits(words):
        total = F.lit(0)
        for w in words:
            total = total + occurrences(text, w)
        return total

    calls = F.coalesce(F.col(tel), F.lit(0)) if tel else F.lit(0)
    staged = df.withColumns({"_hp": hits(phone) + calls, "_hf": hits(forms), "_hb": hits(portals),
                             "_blank": ~nonblank(text) & (calls == 0)})
    hp, hf, hb, blank = F.col("_hp"), F.col("_hf"), F.col("_hb"), F.col("_blank")
    score = (F.when(blank, 0).when(hb > 0, 10 + F.least(F.lit(20), hb))
             .when(hp > 0, 90 + F.least(F.lit(10), hp)).when(hf > 0, 70 + F.least(F.lit(19), hf))
             .otherwise(1))
    system = (F.when(blank, "Unknown").when(hb > 0, "Portal").when(hp > 0, "Phone Only")
              .when(hf > 0, "Email/Form").otherwise("None"))
    reason = (F.when(blank, "No homepage text available for analysis.")
              .when(hb > 0, "tier 3: booking portal named").when(hp > 0, "tier 1: phone-first wording")
              .when(hf > 0, "tier 2: forms or e-mail").otherwise("no tier matched"))
    scored = F.struct(score.cast("int").alias("icp_score"), system.alias("booking_system"),
                      reason.alias("reasoning"))
    return staged.withColumn(out, scored).drop("_hp", "_hf", "_hb", "_blank")


# --- X6: scorer response validation -----------------------------------------

REQUIRED_KEYS = ("icp_score", "booking_system", "agentic_reasoning")


def with_validated_response(df: DataFrame, resp: str, out: str = "scored") -> DataFrame:
    """JSON with the three keys -> clamp score to 1..100 (after int()),
    booking system stripped and cut to 100 chars; anything else -> the
    default struct with a reason. ``"85"`` and ``85.7`` are accepted like
    ``int()`` would (C17); non-numeric text is a scoring error. Adds ``out``."""
    r = F.col(resp)
    parsed = F.from_json(r, "map<string,string>")
    has_all = F.lit(True)
    for k in REQUIRED_KEYS:
        has_all = has_all & F.coalesce(F.map_contains_key(parsed, F.lit(k)), F.lit(False))
    raw_score = F.get_json_object(r, "$.icp_score")
    # a quoted score must be an integer literal (int("85.7") fails), a bare
    # JSON number is truncated (int(85.7) == 85)
    bare = F.nanvl(F.from_json(r, "icp_score double")["icp_score"], F.lit(None).cast("double"))
    num = F.coalesce(bare, F.when(raw_score.rlike(r"^\s*[+-]?[0-9]+\s*$"), strip(raw_score).try_cast("double")))
    staged = df.withColumns({
        "_valid_json": parsed.isNotNull(), "_has_all": has_all, "_num": num,
        "_system": truncate(strip(F.get_json_object(r, "$.booking_system")), 100),
        "_reasoning": F.get_json_object(r, "$.agentic_reasoning")})
    ok = F.col("_valid_json") & F.col("_has_all") & F.col("_num").isNotNull()
    reason = (F.when(~F.col("_valid_json"), F.lit("response parsing failed."))
              .when(~F.col("_has_all"), F.lit("Failed to parse response."))
              .when(F.col("_num").isNull(), F.lit("Scoring error: ValueError")))
    result = F.struct(
        F.when(ok, clamp(F.col("_num"), 1, 100).cast("int")).otherwise(F.lit(0)).alias("icp_score"),
        F.when(ok, F.col("_system")).otherwise(F.lit("Unknown")).alias("booking_system"),
        F.when(ok, F.col("_reasoning")).otherwise(reason).alias("reasoning"))
    return staged.withColumn(out, result).drop("_valid_json", "_has_all", "_num", "_system", "_reasoning")


# --- E5: pluggable batch scorer ----------------------------------------------

SCORE_SCHEMA = "icp_score int, booking_system string, reasoning string"


def score_with(scorer, text, schema: str = SCORE_SCHEMA) -> Column:
    """E5: apply a user scorer ``pd.Series[str] -> pd.DataFrame`` in Arrow
    batches. Marked non-deterministic so it runs once per row even when its
    output is filtered; filter on native columns in an earlier select."""
    def run(texts: pd.Series) -> pd.DataFrame:  # hints resolved here, whatever the caller's are
        return scorer(texts)

    udf = F.pandas_udf(run, schema).asNondeterministic()
    return udf(_c(text))
