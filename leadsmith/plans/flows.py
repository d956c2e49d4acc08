"""The twelve end-to-end flows of the reference,
composed from the library operators.

Every input is a landed table (registry pages, search hits, contact and
people responses, filings, pages, video statistics); every flow is one
lazy plan that the caller writes with a sink. Configuration lives in frozen
dataclasses; list defaults marked "fixed values" are the reference's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsmith.functions import domains as D
from leadsmith.functions import text as X
from leadsmith.operators import budget as B
from leadsmith.operators import candidates as C
from leadsmith.operators import dedupe as DD
from leadsmith.operators import documents as DOC
from leadsmith.operators import lookup as L
from leadsmith.operators import metrics as M
from leadsmith.operators import predicates as P
from leadsmith.operators import ranking as RK
from leadsmith.operators import sorting as SO
from leadsmith.sources import landed as S

# --- P1 / P2: carriers -------------------------------------------------------

# The registry fields a carrier page carries, and the output
# columns of the carrier table in their order.
CARRIER_FIELDS = ["dot_number", "legal_name", "dba_name", "nbr_power_unit", "telephone", "email_address",
                  "phy_street", "phy_city", "phy_state", "phy_zip"]
CARRIER_OUTPUT = ["company", "usdot_number", "dba_name", "power_units", "phone", "email", "owner_name",
                  "owner_title", "owner_email", "email_source", "address", "city", "state", "zip_code",
                  "apollo_org_id"]


@dataclass(frozen=True)
class CarrierConfig:
    min_units: int = 5
    max_units: int = 50
    # Title priority for the people lookup.
    title_priority: tuple = ("owner", "president", "principal", "general manager", "gm", "ceo", "founder",
                             "partner", "director of operations")
    # Title priority for the e-mail lookup fallback.
    contact_priority: tuple = ("owner", "president", "general manager", "director", "principal")


def carrier_leads(pages: DataFrame, cfg: CarrierConfig = CarrierConfig(), orgs: DataFrame | None = None,
                  people: DataFrame | None = None, contacts: DataFrame | None = None,
                  counters: M.StageCounters | None = None) -> DataFrame:
    """Registry pages (``state, page, pos`` + registry fields) ->
    back-fill -> non-blank id/name -> numeric range -> keep-first per id ->
    records -> optional enrichment for rows without an e-mail -> sorted.

    ``orgs``: (company, rank, org_id, and domain for the fallback);
    ``people``: (org_id, pos, first_name, last_name, title, email);
    ``contacts``: (domain, pos, first_name, last_name, position, value) for
    the fallback by the organisation's domain. ``counters`` counts the rows
    read, named and in range on the way, and the records by e-mail.
    """
    df = S.backfill(pages, CARRIER_FIELDS).fillna("", subset=CARRIER_FIELDS)
    named = X.nonblank("dot_number") & X.nonblank("legal_name")
    if counters is not None:
        in_range = named & P.in_range("nbr_power_unit", cfg.min_units, cfg.max_units)
        df = counters.watch(df, "registry", n_named=named, n_in_range=in_range)
    df = df.where(named)
    df = df.where(P.in_range("nbr_power_unit", cfg.min_units, cfg.max_units))
    # The reference de-duplicated on the unstripped id; strip first
    df = DD.keep_first(df.withColumn("_id", X.strip("dot_number")), "_id", ["state", "page", "pos"])
    rec = df.select(
        X.strip("legal_name").alias("company"), F.col("_id").alias("usdot_number"),
        X.strip("dba_name").alias("dba_name"), X.to_int_truncated("nbr_power_unit").cast("int").alias("power_units"),
        X.strip("telephone").alias("phone"), X.strip("email_address").alias("email"),
        X.strip("phy_street").alias("address"), X.strip("phy_city").alias("city"),
        X.strip("phy_state").alias("state"), X.strip("phy_zip").alias("zip_code"))
    rec = rec.withColumn("email_source", X.provenance("email", "registry"))
    if counters is not None:
        rec = counters.settle(rec, "records", n_email=X.nonblank("email"), n_to_enrich=~X.nonblank("email"))
    if orgs is not None and people is not None:
        rec = _carrier_enrich(rec, cfg, orgs, people, contacts)
    rec = S.backfill(rec, CARRIER_OUTPUT)
    return SO.sorted_output(S.select_existing(rec, CARRIER_OUTPUT), ["state", "power_units", "company"])


def _carrier_enrich(rec, cfg, orgs, people, contacts):
    """J2 (+ J4): company -> first org -> best-titled person; a contact
    lookup by domain fills what stays blank. Rows that already have an
    e-mail pass through unchanged (U3 as one pass)."""
    by_domain = contacts is not None and "domain" in orgs.columns
    first_org = RK.best_per_group(orgs, "company", ["rank"], ["org_id", *(["domain"] if by_domain else [])])
    best = RK.priority_pick(people.withColumn("owner_name", X.full_name("first_name", "last_name")), "org_id",
                            "title", cfg.title_priority, "pos", ["owner_name", "title", "email"])
    best = best.select("org_id", F.col("owner_name").alias("p_name"), F.col("title").alias("p_title"),
                       F.col("email").alias("p_email"), F.lit(True).alias("p_found"))
    j = L.salted_join(rec, first_org, "company", "left", L.DEFAULT_SALT, salt_from=["usdot_number"])
    j = L.salted_join(j, best, "org_id", "left", L.DEFAULT_SALT, salt_from=["usdot_number"])
    if by_domain:
        fb = RK.priority_pick(contacts.withColumn("c_name", X.full_name("first_name", "last_name")), "domain",
                              "position", cfg.contact_priority, "pos", ["c_name", "position", "value"])
        j = L.salted_join(j, fb, "domain", "left", L.DEFAULT_SALT, salt_from=["usdot_number"])
    else:
        # The reference called the fallback without a domain; with no
        # domain there is nothing to look up
        j = j.withColumns({c: F.lit(None).cast("string") for c in ("c_name", "position", "value")})
    todo = ~X.nonblank("email")
    name = F.coalesce(X.blank_to_null("p_name"), X.blank_to_null("c_name"))
    title = F.coalesce(X.blank_to_null("p_title"), X.blank_to_null("position"))
    mail = F.coalesce(X.blank_to_null("p_email"), X.blank_to_null("value"))
    # the label names the lookup that gave the e-mail
    label = (F.when(X.nonblank("p_email"), "people:found").when(X.nonblank("value"), "contacts:found")
             .when(F.col("p_found"), "people:no_email").otherwise("not_found"))
    return j.select(
        *[c for c in rec.columns if c != "email_source"],
        F.when(todo, name).alias("owner_name"), F.when(todo, title).alias("owner_title"),
        F.when(todo, mail).alias("owner_email"),
        F.when(todo, label).otherwise(F.col("email_source")).alias("email_source"),
        F.when(todo, F.col("org_id")).alias("apollo_org_id"))


@dataclass(frozen=True)
class PitchConfig:
    sample: int = 30
    seed: int = 42
    role_prefixes: tuple = tuple(P.ROLE_PREFIXES)
    personal_domains: tuple = tuple(P.PERSONAL_DOMAINS)
    drop: tuple = ("owner_name", "owner_title", "owner_email", "apollo_org_id")


def pitch_list(leads: DataFrame, cfg: PitchConfig = PitchConfig()) -> DataFrame:
    """E-mail present, not a role mailbox, not a personal provider
    (tests on stripped text, C21), exact seeded sample, drop enrichment
    columns."""
    e = F.col("email")
    keep = X.nonblank(e) & ~X.startswith_any(X.strip(e), cfg.role_prefixes) & \
        ~X.endswith_any(X.strip(e), cfg.personal_domains)
    sample = SO.seeded_sample(leads.where(keep), "usdot_number", cfg.sample, cfg.seed)
    return sample.drop(*cfg.drop)


# --- P3 / P4: clinics -----------------------------------------------------------

@dataclass(frozen=True)
class ClinicConfig:
    cap: int | None = None         # registry rows taken (None: all)
    threshold: int = 70
    blocklist: tuple = ()
    # Keywords that mark a directory or reference site.
    forbidden_keywords: tuple = ("npi", "wiki", "dictionary", "bible", "directory", "review", "vitals", "grades",
                                 "lookup", "finda", "yellow", "whitepages")
    restricted_suffixes: tuple = tuple(P.RESTRICTED_SUFFIXES)
    # Contact positions that are called, and the rubric's words.
    manager_keywords: tuple = ("office manager", "practice manager")
    phone_words: tuple = ("call us", "call to schedule")
    form_words: tuple = ("request an appointment", "fill out the form", "email us")
    portal_words: tuple = ("zocdoc", "nexhealth", "localmed", "patientreach", "calendly", "schedule online now",
                           "online portal")
    text_limit: int | None = None  # characters of a page that are scored (None: all)
    max_calls: int | None = None   # contact lookups allowed, in registry order (W7)


def clinic_leads(registry: DataFrame, hits: DataFrame, pages: DataFrame, contacts: DataFrame,
                 cfg: ClinicConfig = ClinicConfig(), counters: M.StageCounters | None = None) -> tuple[DataFrame, DataFrame]:
    """Registry JSON pages -> clinics (N9 names) -> first valid search
    hit (F6 -> F7 -> F4, J5) -> homepage text (S11, X3) -> rubric (X5/X7) ->
    score >= threshold -> contact by keyword (W3) -> output and A7 counts.

    registry: (page, body json); hits: (clinic_id, rank, href);
    pages: (domain, html); contacts: (domain, pos, first_name, last_name,
    position, value). With ``counters``, hits and scored clinics are written
    once to the shared folder: both outputs read the tested hits from there.
    """
    clinics = S.registry_results(registry, "body", ["page"])
    if cfg.cap is not None:  # O4: the cap counts valid rows, a bounded top-k
        clinics = clinics.orderBy("page", "pos").limit(cfg.cap)
    clinics = clinics.select(F.concat_ws(":", "page", "pos").alias("clinic_id"), "page", "pos",
                             X.clean_title_name("name").alias("clinic_name"), "city", "state")
    h = hits.withColumn("domain", D.domain_netloc("href"))
    reason = C.rejection_reason([("forbidden_keyword", D.blocked_substring("domain", cfg.forbidden_keywords)),
                                 ("restricted_suffix", D.blocked_suffix("domain", cfg.restricted_suffixes)),
                                 ("blocklist", D.blocked_substring("domain", cfg.blocklist)),
                                 ("empty", ~X.nonblank("domain"))])
    h = h.withColumn("_r", reason)
    if counters is not None:
        h = counters.settle(h, "hits", n_ok=F.col("_r") == "ok", n_rejected=F.col("_r") != "ok")
    rejections = C.rejection_counts(h, "clinic_id", ["rank"], F.col("_r"))
    site = C.first_valid(h, "clinic_id", ["rank"], F.col("_r") == "ok", ["domain"])
    c = clinics.join(site.select("clinic_id", F.col("domain").alias("website")), "clinic_id", "left")
    # parse only the homepages some clinic chose, each once (a site shared
    # by many clinics is still parsed once)
    needed = c.select(F.col("website").alias("domain")).where(F.col("domain").isNotNull()).distinct()
    home = pages.join(needed, "domain", "left_semi").select("domain", DOC.visible_text("html").alias("v"))
    home = home.select(F.col("domain").alias("website"), F.col("v.tel_count").alias("tel_count"),
                       (F.col("v.text") if cfg.text_limit is None else X.truncate("v.text", cfg.text_limit)).alias("text"))
    home = DOC.with_rubric(home, "text", cfg.phone_words, cfg.form_words, cfg.portal_words, out="s", tel="tel_count")
    # scored once per homepage: the scores are joined to the clinics, not the texts
    c = L.salted_join(c, home.select("website", "s"), "website", "left", L.DEFAULT_SALT, salt_from=["clinic_id"])
    c = c.select("*", F.coalesce("s.icp_score", F.lit(0)).alias("icp_score"),
                 F.coalesce("s.booking_system", F.lit("Unknown")).alias("booking_system"),
                 F.coalesce("s.reasoning", F.lit("No homepage text available for analysis.")).alias("agentic_reasoning")).drop("s")
    if counters is not None:
        c = counters.settle(c, "scored", n_site=F.col("website").isNotNull(), n_kept=F.col("icp_score") >= cfg.threshold)
    # Clinics without a site keep score 0 and are dropped here
    c = c.where(F.col("icp_score") >= cfg.threshold)
    c = c.withColumn("reason", P.eligibility("website", D.blocked_substring("website", cfg.blocklist)))
    m = RK.first_match(contacts.withColumn("contact_name", X.full_name("first_name", "last_name")), "domain", "pos",
                       X.contains_any("position", cfg.manager_keywords), ["contact_name", "position", "value"])
    m = m.select(F.col("domain").alias("website"), "contact_name", F.col("position").alias("contact_title"),
                 F.col("value").alias("contact_email"))
    was_called = F.col("reason") == "ok"
    if cfg.max_calls is not None:  # one lookup per eligible clinic, in registry order; the others cost nothing
        c = B.call_budget(c, ["page", "pos"], was_called.cast("bigint"), cfg.max_calls)
        was_called = was_called & F.col("within_budget")
    j = L.salted_join(c, m, "website", "left", L.DEFAULT_SALT, salt_from=["clinic_id"])
    out = j.select(
        *[F.col(x) for x in ("clinic_name", "city", "state", "website", "icp_score", "booking_system",
                             "agentic_reasoning")],
        *[F.when(was_called, F.col(x)).alias(x) for x in ("contact_name", "contact_title", "contact_email")],
        F.when(~was_called, F.lit("")).when(X.nonblank("contact_email"), F.lit("contacts:found"))
        .otherwise(F.lit("contacts:no_match")).alias("email_source"))
    cols = ["clinic_name", "city", "state", "website", "contact_name", "contact_title", "contact_email",
            "email_source", "icp_score", "booking_system", "agentic_reasoning"]
    return SO.sorted_output(out.select(*cols), ["clinic_name"]), rejections


def clinic_contacts(seed: DataFrame, contacts: DataFrame, keywords=("office manager", "practice manager"),
                    default_title: str = "General/Unknown") -> DataFrame:
    """Seed rows with name and site (S7) -> first keyword contact, else
    the first contact with a default title (W4 + R10)."""
    s = seed.select(X.strip("clinic_name").alias("clinic_name"), X.strip("website").alias("website"),
                    *[c for c in seed.columns if c not in ("clinic_name", "website")])
    s = s.withColumn("domain", D.domain_netloc(X.ensure_scheme("website")))
    cand = contacts.withColumn("contact_name", X.full_name("first_name", "last_name"))
    best = RK.match_else_first(cand, "domain", "pos", X.contains_any("position", keywords),
                               ["contact_name", "position", "value"])
    out = L.salted_join(s, best, "domain", "left", L.DEFAULT_SALT, salt_from=["clinic_name", "website"])
    title = F.when(F.col("outcome") == "fallback", F.coalesce(X.blank_to_null("position"), F.lit(default_title))) \
             .otherwise(F.col("position"))
    return SO.sorted_output(out.select("clinic_name", "website", "contact_name", title.alias("contact_title"),
                                       F.col("value").alias("contact_email"),
                                       F.when(F.col("outcome").isNotNull(), F.concat(F.lit("contacts:"),
                                                                                    F.col("outcome")))
                                       .otherwise(F.lit("contacts:none")).alias("email_source")), ["clinic_name"])


# --- P5 / P6 / P7: equipment dealers ---------------------------------------------

@dataclass(frozen=True)
class DealerConfig:
    excluded: tuple = ()
    default_state: str = "MI"
    min_address: int = 6
    min_city: int = 6              # the reference tests the city like an address, so "Troy" fails (C7)
    # Registered domains that are never a dealer's own site.
    skip_domains: tuple = ("machinerytrader.com", "ironplanet.com", "equipmenttrader.com", "yellowpages.com",
                           "yelp.com", "facebook.com", "linkedin.com", "instagram.com", "twitter.com", "x.com",
                           "bbb.org", "manta.com", "bizapedia.com", "dnb.com", "zoominfo.com", "indeed.com",
                           "glassdoor.com", "bloomberg.com", "mapquest.com", "google.com", "bing.com",
                           "duckduckgo.com", "wikipedia.org", "wikidata.org", "apple.com", "maps.apple.com")
    # Owner-title priority for the contact lookup.
    owner_titles: tuple = ("owner", "president", "ceo", "founder", "co-owner", "general manager", "principal")


def dealer_cards(pages: DataFrame, cfg: DealerConfig = DealerConfig()) -> DataFrame:
    """P5: card HTML (S10) -> company without its " - City, ST" branch (R7),
    blank ones dropped -> exclusions on the whole name (F10/F11) -> City, ST
    ZIP (R8) -> bad address or city (F12) -> phone (R9) -> keep-first per
    normalised name (A2), so branches of a company collapse."""
    cards = S.directory_cards(pages)
    cards = cards.where(~P.excluded_company("company", cfg.excluded))
    city, state, zipc = X.city_state_zip("city_line", cfg.default_state)
    rec = cards.select("page_no", "card_no", X.strip(X.before_separator("company")).alias("company"),
                       X.strip("address").alias("address"), city.alias("city"), state.alias("state"), zipc.alias("zip"),
                       X.phone("tel_href", "phone_text").alias("phone"))
    rec = rec.where(X.nonblank("company") & ~P.bad_address("address", cfg.min_address) & ~P.bad_address("city", cfg.min_city))
    return DD.keep_first(rec, X.company_key("company"), ["page_no", "card_no"], key_name="company_key")


def dealer_domains(dealers: DataFrame, hits: DataFrame, cfg: DealerConfig = DealerConfig(),
                   done: DataFrame | None = None, suffixes: DataFrame | None = None) -> DataFrame:
    """Hits (company_key, tier, rank, href) from the tiered queries
    -> registered domain (N4) -> skip set (F5) -> first valid over (tier,
    rank) (J6). ``done`` (company_key) resumes a partial run (K5).
    ``suffixes`` (rule) is a public-suffix table; without it the fixed list decides."""
    todo = dealers if done is None else dealers.join(done.select("company_key"), "company_key", "left_anti")
    h = (hits.withColumn("domain", D.registered_domain("href")) if suffixes is None
         else D.with_registered_domain(hits, "href", suffixes))
    ok = (F.col("domain") != "") & ~D.blocked_exact("domain", cfg.skip_domains)
    best = C.first_valid(h, "company_key", ["tier", "rank"], ok, ["domain", "tier"])
    return todo.join(best.select("company_key", F.col("domain").alias("website"),
                                 F.col("tier").alias("found_tier")), "company_key", "left")


def dealer_owners(dealers: DataFrame, contacts: DataFrame, cfg: DealerConfig = DealerConfig()) -> tuple[DataFrame, DataFrame]:
    """Rows that need work (F16) -> best owner by (title rank,
    -confidence, position) (W2) -> merge; plus the preview (K6) and
    coverage (A6). The best contact is chosen first: if it has no e-mail,
    the lookup gives nothing."""
    d = S.backfill(dealers, ["owner_name", "owner_email"])
    need = P.needs_work("website", "owner_name", "owner_email")
    cand = contacts.withColumn("name", X.full_name("first_name", "last_name"))
    best = RK.priority_pick(cand, "domain", "position", cfg.owner_titles, "pos",
                            ["name", "position", "value", "confidence"], default_rank=len(cfg.owner_titles),
                            confidence="confidence")
    best = best.where(X.nonblank("value"))
    j = L.salted_join(d, best.select(F.col("domain").alias("website"), "name", "value"), "website", "left",
                      L.DEFAULT_SALT)
    out = j.select(*[c for c in d.columns if c not in ("owner_name", "owner_email")],
                   F.when(need, F.col("name")).otherwise(F.col("owner_name")).alias("owner_name"),
                   F.when(need, F.col("value")).otherwise(F.col("owner_email")).alias("owner_email"))
    cov = M.coverage(out, ["website", "owner_email"])
    return out, cov


# --- P8 / P9: brand and distributor bridges ------------------------------------------

@dataclass(frozen=True)
class BridgeConfig:
    blocklist: tuple = ()
    max_calls: int | None = None   # service calls allowed, in order (None: no budget)
    # Operations and executive keywords of the contact cascade.
    ops_keywords: tuple = ("operations", "supply chain", "logistics", "coo", "chief operating", "vp operations",
                           "head of operations")
    exec_keywords: tuple = ("ceo", "founder", "president", "owner", "chief executive", "managing director",
                            "co-founder")


def brand_bridge(brands: DataFrame, suggest: DataFrame, contacts: DataFrame,
                 cfg: BridgeConfig = BridgeConfig(), counters: M.StageCounters | None = None) -> tuple[DataFrame, DataFrame]:
    """First suggest hit only (J8, C13) -> eligibility (F15) -> call
    budget in seed order (W7) -> four-level contact cascade (W5) -> merge
    back (J9). brands: (ordinal, brand_name); suggest: (ordinal, rank,
    domain); contacts: (domain, pos, first_name, last_name, position, value).
    With ``counters``, the brands with their first hits are written once to
    the shared folder; both outputs read them from there."""
    first = C.first_hit(suggest, "ordinal", ["rank"], "domain", D.blocked_substring("domain", cfg.blocklist))
    b = brands.join(first.select("ordinal", F.col("domain").alias("website"), "outcome"), "ordinal", "left") \
              .withColumn("outcome", F.coalesce("outcome", F.lit("not_found")))
    if counters is not None:
        b = counters.settle(b, "first_hits", **{f"n_{o}": F.col("outcome") == o for o in ("found", "blocked", "not_found")})
    counts = C.outcome_counts(b)
    elig = b.withColumn("reason", P.eligibility("website", D.blocked_substring("website", cfg.blocklist)))
    called = elig.where(F.col("reason") == "ok")
    if cfg.max_calls is not None:
        called = B.call_budget(called, ["ordinal"], F.lit(1), cfg.max_calls, min_cost=1).where("within_budget")
    called = called.select("ordinal", "website")
    cand = contacts.withColumn("contact_name", X.full_name("first_name", "last_name"))
    levels = [("ops", X.contains_any("position", cfg.ops_keywords)),
              ("exec", X.contains_any("position", cfg.exec_keywords)),
              ("generic", X.nonblank("position"))]
    best = RK.cascade(cand, "domain", "pos", levels, ["contact_name", "position", "value"], "no_title")
    enriched = L.salted_join(called, best.withColumnRenamed("domain", "website"), "website", "left", L.DEFAULT_SALT,
                             salt_from=["ordinal"]).select(
        "ordinal", "contact_name", F.col("position").alias("contact_title"), F.col("value").alias("contact_email"),
        F.when(F.col("outcome").isNull(), "contacts:none").otherwise(F.concat(F.lit("contacts:"), "outcome"))
        .alias("email_source"))
    merged = b.join(enriched, "ordinal", "left")
    return SO.sorted_output(merged.drop("outcome"), ["brand_name", "ordinal"]), counts


def distributor_bridge(firms: DataFrame, suggest: DataFrame, people: DataFrame, matches: DataFrame,
                       cfg: BridgeConfig = BridgeConfig()) -> DataFrame:
    """As P8, but the contact is two calls: first person of the domain,
    then the e-mail by person id (J3); a row costs 1 or 2 calls and the
    budget is checked before the row (W7, C11). people: (domain, pos, id,
    first_name, last_name, title); matches: (id, email)."""
    first = C.first_hit(suggest, "ordinal", ["rank"], "domain", D.blocked_substring("domain", cfg.blocklist))
    b = firms.join(first.select("ordinal", F.col("domain").alias("website")), "ordinal", "left")
    p1 = RK.best_per_group(people, "domain", ["pos"], ["id", "first_name", "last_name", "title"]) \
           .withColumn("_person", F.lit(True))
    elig = b.where(X.nonblank("website") & ~D.blocked_substring("website", cfg.blocklist))
    j = L.salted_join(elig, p1.withColumnRenamed("domain", "website"), "website", "left", L.DEFAULT_SALT,
                      salt_from=["ordinal"])
    # the e-mail match is requested (and counted) whenever a first person
    # exists, with or without an id
    cost = F.when(F.col("_person").isNotNull(), 2).otherwise(1)
    within = j.withColumn("cost", cost.cast("bigint"))
    if cfg.max_calls is not None:
        within = B.call_budget(j, ["ordinal"], cost, cfg.max_calls, min_cost=1).where("within_budget")
    m = within.join(matches.select("id", F.col("email").alias("m_email")), "id", "left")
    label = (F.when(F.col("_person").isNull(), "people:none")
             .when(F.col("id").isNull(), "people:no_id")
             .when(~X.nonblank("m_email"), "match:no_email").otherwise("match:ok"))
    enriched = m.select("ordinal", X.full_name("first_name", "last_name").alias("contact_name"),
                        F.col("title").alias("contact_title"), F.col("m_email").alias("contact_email"),
                        label.alias("email_source"))
    return SO.sorted_output(b.join(enriched, "ordinal", "left"), ["company_name", "ordinal"])


# --- P10: machine shops -------------------------------------------------------------

@dataclass(frozen=True)
class ShopConfig:
    cap: int | None = None         # result links taken of a page (None: all)
    # Result-page blocklist and contact position keywords.
    blocklist: tuple = ("thomasnet", "iqsdirectory", "yelp", "yellowpages", "linkedin", "facebook", "youtube",
                        "mfg", "zoominfo")
    positions: tuple = ("plant manager", "general manager", "manufacturing", "owner", "president", "operations",
                        "production")


def machine_shops(result_pages: DataFrame, contacts: DataFrame, cfg: ShopConfig = ShopConfig()) -> DataFrame:
    """P10: result links (S9, cap first) -> loose domain (N3) -> blank and
    blocked dropped, keep-first per domain (A4) -> contact by position
    keyword, else first (W4) -> sorted by name (K2). Provenance is kept (C12)."""
    links = S.result_links(result_pages, "html", ["page_no"], cfg.cap)   # cap applied per page first
    links = links.select("page_no", "pos", D.domain_loose("href").alias("domain"),
                         X.before_separator("title").alias("company_name"))
    kept = links.where((F.col("domain") != "") & ~D.blocked_substring("domain", cfg.blocklist))
    # first sighting of each domain over (page, position); the name rides along
    shops = DD.keep_first(kept, "domain", ["page_no", "pos"], cols=["domain", "company_name", "page_no", "pos"])
    s = shops.select("company_name", F.col("domain").alias("website"))
    cand = contacts.withColumn("contact_name", X.full_name("first_name", "last_name"))
    best = RK.match_else_first(cand, "domain", "pos", X.contains_any("position", cfg.positions),
                               ["contact_name", "position", "value"], labels=("contacts:matched", "contacts:fallback"))
    out = s.join(best.withColumnRenamed("domain", "website"), "website", "left").select(
        "company_name", "website", "contact_name", F.col("position").alias("contact_title"),
        F.col("value").alias("contact_email"), F.coalesce("outcome", F.lit("not_found")).alias("email_source"))
    return SO.sorted_output(out, ["company_name", "website"])


# --- P11: filings -----------------------------------------------------------------

@dataclass(frozen=True)
class FilingConfig:
    forms: tuple = ("D", "D/A")
    # Name parts that mark an institutional filer.
    institutional: tuple = ("fund ii", " lp", "trust", "portfolio")
    cap: int | None = None


def funded_startups(index_lines: DataFrame, filings: DataFrame, cfg: FilingConfig = FilingConfig(),
                    counters: M.StageCounters | None = None) -> tuple[DataFrame, DataFrame]:
    """Index lines (day, value) of several days (U2) -> parsed (S4,
    F18) -> one row per accession, first day wins (A3) -> institutional
    names dropped with counts (F13) -> optional cap (K4) -> filing text
    attached by path (J13) -> location (X1/X2) -> ISO date (N12).
    filings: (rel_path, text). With ``counters``, F13 counts in the job that
    writes the filtered rows to the shared folder."""
    rows = S.index_rows(index_lines, "value", forms=cfg.forms, keep=["day"])
    rows = DD.keep_first(rows, X.accession("rel_path"), ["day", "rel_path"], key_name="accession")
    kept, counts = P.filter_counted(rows, ~X.contains_any("company_name", cfg.institutional), counters=counters)
    if cfg.cap:
        kept = kept.orderBy("day", "accession").limit(cfg.cap)
    # located where the text is read: only (rel_path, state) is shuffled
    located = filings.select("rel_path", DOC.filing_location("text").alias("state"))
    j = kept.join(located, "rel_path", "left")
    out = j.select("accession", "form_type", "company_name", "cik", X.yyyymmdd_to_iso("date_filed").alias("date_filed"),
                   F.coalesce("state", F.lit("")).alias("state"), "rel_path")
    return out, counts


# --- P12: creator engagement ----------------------------------------------------------

@dataclass(frozen=True)
class CreatorConfig:
    recent: int = 15


def creator_profiles(handles: DataFrame, channels: DataFrame, playlist: DataFrame, stats: DataFrame,
                     cfg: CreatorConfig = CreatorConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Handle -> channel id (J11, unknown handles to the dead-letter
    table E2) -> uploads playlist -> newest N videos (W6) -> statistics
    (J12) -> totals, mean views, engagement rate (A10-A13) -> nested JSON
    rows (X9) and a manifest (A14, C18).

    handles: (handle); channels: (handle, channel_id, subscriberCount,
    viewCount, uploads); playlist: (playlist_id, published_at, video_id);
    stats: (video_id, viewCount, likeCount, commentCount) as strings."""
    h = handles.select(X.handle("handle").alias("handle")).distinct()
    ch = channels.select(X.handle("handle").alias("handle"), "channel_id", "uploads",
                         X.to_long_opt("subscriberCount").alias("subscribers"),
                         X.to_long_opt("viewCount").alias("channel_views"))
    resolved = h.join(ch, "handle", "left")
    good, bad = L.split_errors(resolved, F.when(F.col("handle").isNull(), F.lit("blank handle"))
                               .when(F.col("channel_id").isNull(), F.lit("unknown handle")))
    recent = RK.recent_n(playlist, "playlist_id", [F.col("published_at").desc(), F.col("video_id").desc()], cfg.recent)
    # videos the statistics service did not return are not sampled
    vids = recent.join(stats.withColumn("_returned", F.lit(True)), "video_id", "left") \
                 .withColumnRenamed("playlist_id", "uploads")
    per = M.engagement(vids, "uploads", X.to_long_opt("viewCount"), X.to_long_opt("likeCount"),
                       X.to_long_opt("commentCount"), present=F.col("_returned"))
    prof = M.empty_sample(good, "uploads", per,
                          ["n_sampled", "total_views", "total_likes", "total_comments"])
    payload = prof.select("handle", "channel_id", F.to_json(F.struct(
        "handle", "channel_id", "subscribers", "channel_views",
        F.struct("n_sampled", "total_views", "total_likes", "total_comments").alias("recent_totals"),
        "mean_views", "engagement_rate")).alias("profile"))
    manifest = M.manifest(resolved, F.col("channel_id").isNull())
    return payload, bad.select("handle", "error"), manifest
