"""URL -> domain helpers and domain block tests.

All are native expressions; the public-suffix lookup uses higher-order
array functions over a small fixed literal list, so it needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadsmith.functions.text import _c, contains_any, endswith_any, strip

# RFC 3986 scheme, then '//' and the authority up to '/', '?' or '#'.
_NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def netloc(url) -> Column:
    """Authority part of a URL ('' when there is no '//')."""
    return F.regexp_extract(F.coalesce(strip(_c(url)), F.lit("")), _NETLOC_RE, 1)


def domain_netloc(url) -> Column:
    """Lower-case authority with a leading 'www.' removed.

    Port and user-info stay, like ``urlparse(...).netloc``; a URL without a
    scheme gives ''.
    """
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def domain_loose(url) -> Column:
    """Authority, or the path when there is none; every 'www.' removed."""
    u = F.coalesce(strip(_c(url)), F.lit(""))
    has_auth = u.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")
    no_scheme = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?!//)", "")
    path_only = F.regexp_extract(no_scheme, r"^([^?#]*)", 1)
    raw = F.when(has_auth & (netloc(u) != ""), netloc(u)).otherwise(path_only)
    return strip(F.lower(F.replace(raw, F.lit("www."), F.lit(""))))


def host(url) -> Column:
    """Host only: authority without user-info and port, lower-case."""
    auth = netloc(url)
    no_user = F.regexp_replace(auth, r"^.*@", "")
    return F.lower(F.regexp_replace(no_user, r":[0-9]*$", ""))


def domain_cut(url) -> Column:
    """N4 variant D: drop the scheme and 'www.', cut at the first '/'."""
    u = F.regexp_replace(F.coalesce(strip(_c(url)), F.lit("")), r"^https?://", "")
    u = F.regexp_replace(u, r"^www\.", "")
    return F.lower(F.split_part(u, F.lit("/"), F.lit(1)))


# The public suffixes the registered-domain rule knows about.
# Anything not listed is an unknown suffix and gives ''.
PUBLIC_SUFFIXES = [
    "com", "net", "org", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "us",
    "ai", "app", "dev", "me", "tv", "ly", "shop", "store", "online", "site", "xyz",
    "uk", "co.uk", "org.uk", "ac.uk", "gov.uk", "ltd.uk", "plc.uk", "me.uk",
    "ca", "au", "com.au", "net.au", "org.au", "edu.au", "gov.au",
    "nz", "co.nz", "org.nz", "govt.nz", "de", "fr", "es", "it", "nl", "be", "ch",
    "at", "se", "no", "dk", "fi", "ie", "pl", "pt", "mx", "com.mx", "br", "com.br",
    "in", "co.in", "jp", "co.jp", "cn", "com.cn", "kr", "co.kr", "za", "co.za",
]


def registered_domain(url, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> Column:
    """N4: 'label.suffix' using the longest known public suffix, else ''."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    suf = F.array(*[F.lit(s) for s in suffixes])
    # tails from longest (whole host) to shortest (last label)
    tails = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                        lambda i: F.struct(i.alias("i"),
                                           F.array_join(F.slice(labels, i, n - i + 1), ".").alias("t")))
    known = F.filter(tails, lambda s: F.array_contains(suf, s["t"]))
    best = F.get(known, 0)  # longest known suffix
    out = F.concat(F.get(labels, best["i"] - 2), F.lit("."), best["t"])
    # the host itself is a public suffix (or none is known): no registered domain
    return F.coalesce(F.when((F.size(known) > 0) & (best["i"] > 1), out), F.lit(""))


def with_registered_domain(df, url: str, rules, rule: str = "rule", out: str = "domain", known: str = "suffix_known"):
    """N4 with a whole public-suffix table: ``df`` plus ``out`` and ``known``.

    ``rules`` holds one rule a row: ``co.uk``, ``*.ck`` (any label before it)
    or ``!www.ck`` (an exception, which wins). The longest matching rule
    decides; a host that none matches takes its last label as the suffix and
    ``known`` is false. URLs without a scheme are read too. NULL, blank and
    numeric hosts, and hosts that are themselves a suffix, give ''.

    The table is matched by hash joins against the suffixes of *distinct*
    hosts; a hot host is split by the salted join back.
    """
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    u = strip(_c(url))
    at = F.coalesce(F.nullif(host(u), F.lit("")), host(F.concat(F.lit("//"), u)), F.lit(""))
    keyed = df.withColumn("_h", at)
    hosts = keyed.select("_h").distinct().where((F.col("_h") != "") & ~F.col("_h").rlike(r"^[0-9.]+$"))
    tails = hosts.select("_h", host_suffixes("_h").alias("_t"))
    # rules that would match the suffix at place i, with the place their public suffix starts at
    i = F.col("i")
    tail = F.col("_t")[i]
    places = tails.select("_h", "_t", F.explode(F.sequence(F.lit(0), F.size("_t") - 1)).alias("i"))
    asked = places.select("_h", F.explode(F.array(
        F.struct(tail.alias("_r"), i.alias("start"), F.lit(False).alias("exception")),
        F.struct(F.concat(F.lit("*."), F.get(F.col("_t"), i + 1)).alias("_r"), i.alias("start"), F.lit(False).alias("exception")),
        F.struct(F.concat(F.lit("!"), tail).alias("_r"), (i + 1).alias("start"), F.lit(True).alias("exception")))).alias("q")).select("_h", "q.*")
    table = rules.select(F.lower(strip(F.col(rule))).alias("_r")).distinct()
    hit = asked.join(table, "_r").groupBy("_h").agg(
        F.coalesce(F.min(F.when(F.col("exception"), F.col("start"))), F.min("start")).alias("start"))
    found = tails.join(hit, "_h", "left")
    start = F.coalesce("start", F.size("_t") - 1)
    found = found.select("_h", F.when(start > 0, F.get(F.col("_t"), start - 1)).otherwise("").alias(out), F.col("start").isNotNull().alias(known))
    j = salted_join(keyed, found, "_h", "left", DEFAULT_SALT)
    return j.select(*df.columns, F.coalesce(out, F.lit("")).alias(out), F.coalesce(known, F.lit(False)).alias(known))


def blocked_substring(domain, blocklist: Sequence[str]) -> Column:
    """domain contains any listed text (case-insensitive)."""
    return contains_any(domain, blocklist)


def blocked_suffix(domain, suffixes: Sequence[str]) -> Column:
    """domain ends with any listed suffix."""
    return endswith_any(domain, suffixes)


def blocked_exact(domain, names: Sequence[str]) -> Column:
    """domain equals one of a small literal set."""
    return F.coalesce(F.lower(_c(domain)).isin([n.lower() for n in names]), F.lit(False))


def host_suffixes(domain) -> Column:
    """Every dot-suffix of a host, longest first ('a.b.com' -> a.b.com, b.com, com)."""
    labels = F.split(F.lower(_c(domain)), r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                       lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def drop_blocked(df, domain: str, blocklist, mode: str = "suffix", entry: str = "domain"):
    """Remove rows whose domain is on a (possibly large) blocklist table.

    ``exact``: hash anti-join on the domain. ``suffix``: the domain or any of
    its parent domains is listed. Distinct domains are exploded into their
    suffixes and hash-joined to the list (never a nested-loop join on
    ``contains``), and the blocked domains are anti-joined back, so the
    explode grows with distinct domains, not rows. A hot domain is split by
    the salted anti-join. Rows without a domain stay. ``substring``: the
    domain contains a listed text, see ``drop_containing``.
    """
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    if mode == "substring":
        return drop_containing(df, domain, blocklist, entry)
    bl = blocklist.select(F.lower(F.col(entry)).alias("_b")).distinct()
    if mode == "exact":
        keyed = df.withColumn("_b", F.lower(F.col(domain)))
        return salted_join(keyed, bl, "_b", "left_anti", DEFAULT_SALT, salt_from=df.columns).select(*df.columns)
    doms = df.select(F.col(domain).alias("_d")).distinct()
    ex = doms.select("_d", F.explode(host_suffixes("_d")).alias("_b"))
    blocked = ex.join(bl, "_b").select(F.col("_d").alias(domain)).distinct()
    return salted_join(df, blocked, domain, "left_anti", DEFAULT_SALT).select(*df.columns)


FLAGS = 1 << 16  # hash values of grams, the most rows that ``containing`` broadcasts


def _grams(text: Column, n: int) -> Column:
    """Substrings of ``n`` characters with the place each starts at (none if the text is shorter)."""
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(F.substring(text, i, F.lit(n)).alias("gram"), i.alias("at")))


def containing(domains, entries, q: int = 4):
    """(domain, entry): which distinct domains contain which entries.

    ``domains`` (domain) and ``entries`` (entry) are distinct, lower-case and
    not blank. Entries are reduced to one row per first q-gram (a shorter
    entry is its own gram) with the lengths they occur in. Where a domain
    holds such a gram, its substrings of these lengths are the texts it can
    contain from there on; a join on whole texts decides. So rows grow with
    domains and with entries, never with pairs of them that share a gram: a
    domain has at most one text a place and length. Places whose gram begins
    no entry stay where they are, by a broadcast of at most FLAGS hash values.

    All other joins are merge joins: size estimates do not see ``explode``, so
    one of these sides would be sent to the driver to be broadcast. Hot grams
    and texts (``.com``) are salted.
    """
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    size = F.least(F.lit(q), F.length("entry"))
    short = sorted(r[0] for r in entries.where(F.length("entry") < q).select(F.length("entry")).distinct().collect())  # q - 1 numbers at most
    shapes = (entries.select(F.substring(F.col("entry"), F.lit(1), size).alias("gram"), F.length("entry").alias("n")).distinct()
              .groupBy("gram").agg(F.sort_array(F.collect_list("n")).alias("lengths")))
    flag = F.pmod(F.xxhash64("gram"), F.lit(FLAGS)).alias("flag")
    # few short domains are one task to Spark; by a hash of them, as a repartition by the key of ``distinct`` is left out
    spread = domains.repartition(int(domains.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("domain"))
    held = (spread.select("domain", F.inline(F.concat(*[_grams(F.col("domain"), k) for k in (*short, q)]))).withColumn("flag", flag)
            .join(F.broadcast(shapes.select(flag).distinct()), "flag", "left_semi").drop("flag"))
    room = F.length("domain") - F.col("at") + 1
    texts = F.transform(F.filter("lengths", lambda n: n <= room), lambda n: F.substring(F.col("domain"), F.col("at"), n))
    asked = (salted_join(held, shapes.hint("merge"), "gram", "inner", DEFAULT_SALT, force=True)
             .select("domain", F.explode(texts).alias("entry")))
    found = asked.select("entry").distinct().join(entries.hint("merge"), "entry", "left_semi")
    return salted_join(asked, found.hint("merge"), "entry", "inner", DEFAULT_SALT, force=True).select("domain", "entry").distinct()


def drop_containing(df, domain: str, blocklist, entry: str = "domain", q: int = 4):
    """Remove rows whose domain contains any text of a (large) list,
    whatever the case. The list is a table: no literal of it is in the plan,
    and no nested-loop join. Blank entries block nothing; rows without a
    domain stay."""
    from leadsmith.operators.lookup import DEFAULT_SALT, salted_join
    listed = blocklist.select(F.lower(F.col(entry)).alias("entry")).where(F.length("entry") > 0).distinct()
    keyed = df.withColumn("_d", F.lower(F.col(domain)))
    doms = keyed.select(F.col("_d").alias("domain")).where(F.length("domain") > 0).distinct()
    blocked = containing(doms, listed, q).select(F.col("domain").alias("_d")).distinct()
    return salted_join(keyed, blocked.hint("merge"), "_d", "left_anti", DEFAULT_SALT, salt_from=df.columns, force=True).select(*df.columns)
