"""DuckDB spellings of the library's scalar helpers, for oracle SQL only."""

from __future__ import annotations

from leadsmith.functions.text import WS_CLASS


def spark_expr(sql: str):
    """A SQL snippet shared with the DuckDB twin, as a Spark Column
    (Spark spells an unbounded text cast STRING and integer division div)."""
    from pyspark.sql import functions as F
    return F.expr(sql.replace("AS VARCHAR", "AS STRING").replace(" // ", " div "))


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS_CLASS}+', ' ', 'g')")


def nonblank(x: str) -> str:
    return f"coalesce({strip(x)} <> '', false)"


NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def netloc(x: str) -> str:
    return f"regexp_extract(coalesce({strip(x)}, ''), '{NETLOC_RE}', 1)"


def domain_netloc(x: str) -> str:
    return f"regexp_replace(lower({netloc(x)}), '^www\\.', '')"


def host(x: str) -> str:
    return f"lower(regexp_replace(regexp_replace({netloc(x)}, '^.*@', ''), ':[0-9]*$', ''))"


def contains_any(x: str, needles) -> str:
    if not needles:
        return "false"
    low = f"lower(coalesce({x}, ''))"
    return "(" + " OR ".join(f"contains({low}, '{n.lower()}')" for n in needles) + ")"


def startswith_any(x: str, prefixes) -> str:
    low = f"lower(coalesce({x}, ''))"
    return "(false" + "".join(f" OR starts_with({low}, '{p.lower()}')" for p in prefixes) + ")"


def endswith_any(x: str, suffixes) -> str:
    low = f"lower(coalesce({x}, ''))"
    return "(false" + "".join(f" OR ends_with({low}, '{s.lower()}')" for s in suffixes) + ")"


def keyword_rank(x: str, keywords, default: int = 99) -> str:
    low = f"lower(coalesce({x}, ''))"
    whens = " ".join(f"WHEN contains({low}, '{k.lower()}') THEN {i}" for i, k in enumerate(keywords))
    return f"(CASE {whens} ELSE {default} END)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# Pages with click-to-call links: in the menu, in the article, or nothing but
# links (one page in twelve is then blank). Read by Spark and by DuckDB.
TEL_HTML = """CASE page_id % 3
 WHEN 0 THEN replace(html, '<nav>', '<nav><a href="tel:+15550100">Call</a>')
 WHEN 1 THEN replace(html, '<article>', concat('<article>', repeat('<a class="call" href="tel:+15550100">Call</a> ', CAST(1 + page_id % 4 AS INTEGER))))
 ELSE concat('<html><body><nav>Menu</nav>', repeat('<a href="tel:+15550100"><img src="call.png"></a>', CAST(page_id % 4 AS INTEGER)), '</body></html>') END"""


def shown_html(x: str) -> str:
    """HTML without comments and without the elements that are never shown,
    each up to its end tag or, where that is missing, to the end of the page."""
    out = f"regexp_replace(coalesce({x}, ''), '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "header", "nav", "footer"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b.*?(</{tag}\\s*>|\\z)', '', 'g')"
    return out


def page_text(shown: str) -> str:
    """Text of ``shown_html`` with the character references that the pages use."""
    out = f"regexp_replace({shown}, '(?s)</?[a-zA-Z!][^>]*(>|\\z)', '', 'g')"
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{name};?', '{char}', 'g')"
    return collapse(out)


def tel_count(shown: str) -> str:
    """Click-to-call links of ``shown_html``."""
    return f"CAST(len(regexp_extract_all({shown}, '<a\\s[^>]*href=\"tel:')) AS INTEGER)"


def occurrences(text: str, needle: str) -> str:
    low = f"lower(coalesce({text}, ''))"
    return f"CAST((length({low}) - length(replace({low}, '{needle}', ''))) / {len(needle)} AS INTEGER)"


def rubric(text: str, calls: str, phone, forms, portals) -> tuple[str, str, str]:
    """X5 + X7 with X4 evidence: (score, booking system, reasoning)."""
    hp, hf, hb = ("(0" + "".join(f" + {occurrences(text, w)}" for w in words) + ")" for words in (phone, forms, portals))
    tiers = [(f"NOT {nonblank(text)} AND {calls} = 0", "0", "Unknown", "No homepage text available for analysis."),
             (f"{hb} > 0", f"10 + least(20, {hb})", "Portal", "tier 3: booking portal named"),
             (f"{hp} + {calls} > 0", f"90 + least(10, {hp} + {calls})", "Phone Only", "tier 1: phone-first wording"),
             (f"{hf} > 0", f"70 + least(19, {hf})", "Email/Form", "tier 2: forms or e-mail"),
             ("true", "1", "None", "no tier matched")]
    score = "CAST(CASE " + " ".join(f"WHEN {c} THEN {n}" for c, n, _, _ in tiers) + " END AS INTEGER)"
    system, reason = ("CASE " + " ".join(f"WHEN {t[0]} THEN '{t[k]}'" for t in tiers) + " END" for k in (2, 3))
    return score, system, reason
