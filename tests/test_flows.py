"""The twelve flows on invented landed fixtures."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from leadsmith.plans import flows as FL
from tests.conftest import rows
from tests.test_sources import CARDS, INDEX

REG_COLS = "state string, page int, pos int, dot_number string, legal_name string, nbr_power_unit string, " \
           "email_address string, phy_state string"


def registry(spark):
    data = [
        ("MI", 0, 0, "100", "Acme Freight", "4.99", "", "MI"),
        ("MI", 0, 1, "101", "Bolt Haul", "5", "ops@bolt.example.com", "MI"),
        ("MI", 0, 2, "102", "Cog Lines", "50.9", None, "MI"),       # C6: 50.9 -> 50 kept
        ("MI", 0, 3, "103", "Dray Co", "abc", "", "MI"),
        ("MI", 1, 0, "104", "Echo", "5d", "", "MI"),                # '5d' is not a number
        ("OH", 0, 0, " 101 ", "Bolt Haul Dup", "7", "", "OH"),       # C5: same id after strip
        ("OH", 0, 1, "", "No Id", "9", "", "OH"),
        ("OH", 0, 2, "105", "Fleet One", "12", " info@fleet.example.com", "OH"),
    ]
    return spark.createDataFrame(data, REG_COLS)


def test_p1_carrier_leads(spark):
    out = FL.carrier_leads(registry(spark))
    got = [(r["company"], r["usdot_number"], r["power_units"], r["email"], r["email_source"]) for r in out.collect()]
    # missing columns are back-filled, the sort is (state, power_units, company)
    assert got == [("Bolt Haul", "101", 5, "ops@bolt.example.com", "registry"), ("Cog Lines", "102", 50, "", ""),
                   ("Fleet One", "105", 12, "info@fleet.example.com", "registry")]
    assert out.columns == ["company", "usdot_number", "dba_name", "power_units", "phone", "email", "owner_name",
                           "owner_title", "owner_email", "email_source", "address", "city", "state", "zip_code",
                           "apollo_org_id"]


def test_p1_enrichment(spark):
    orgs = spark.createDataFrame([("Cog Lines", 1, "o2"), ("Cog Lines", 0, "o1")], "company string, rank int, org_id string")
    people = spark.createDataFrame([("o1", 0, "Vi", "Ce", "Vice President", "vp@cog.example.com"),
                                    ("o1", 1, "Ow", "Ner", "Owner", None)],
                                   "org_id string, pos int, first_name string, last_name string, title string, email string")
    out = FL.carrier_leads(registry(spark), orgs=orgs, people=people)
    cog = out.where(F.col("company") == "Cog Lines").first()
    assert (cog["owner_name"], cog["owner_title"], cog["owner_email"], cog["email_source"], cog["apollo_org_id"]) == \
        ("Ow Ner", "Owner", None, "people:no_email", "o1")
    bolt = out.where(F.col("company") == "Bolt Haul").first()
    assert bolt["email_source"] == "registry" and bolt["owner_name"] is None
    # the organisation's domain feeds the fallback; a person without a title is still found
    sited = orgs.withColumn("domain", F.lit("cog.example.com"))
    contacts = spark.createDataFrame([("cog.example.com", 0, "Di", "R", "Director", "di@cog.example.com")],
                                     "domain string, pos int, first_name string, last_name string, position string, value string")
    cog = FL.carrier_leads(registry(spark), orgs=sited, people=people, contacts=contacts).where(F.col("company") == "Cog Lines").first()
    assert (cog["owner_name"], cog["owner_email"], cog["email_source"]) == ("Ow Ner", "di@cog.example.com", "contacts:found")
    untitled = people.withColumn("title", F.lit(None).cast("string"))
    cog = FL.carrier_leads(registry(spark), orgs=orgs, people=untitled.where("pos = 1")).where(F.col("company") == "Cog Lines").first()
    assert (cog["owner_name"], cog["email_source"]) == ("Ow Ner", "people:no_email")


def test_p2_pitch_list(spark):
    leads = spark.createDataFrame([
        (str(i), e) for i, e in enumerate(["", "info@a.example.com", "joe@gmail.com", " Ann@b.example.com ",
                                           "Sales@c.example.com", "kim@d.example.com"])], "usdot_number string, email string")
    leads = leads.withColumn("owner_name", F.lit(""))
    out = FL.pitch_list(leads)
    assert sorted(r["email"] for r in out.collect()) == [" Ann@b.example.com ", "kim@d.example.com"]
    assert "owner_name" not in out.columns


def test_p3_clinic_leads(spark):
    res = [{"basic": {"organization_name": "SMILE DENTAL, D.D.S."}, "addresses": [{"city": "Troy", "state": "MI"}]},
           {"basic": {"organization_name": "Bright Teeth"}, "addresses": [{"city": "Flint", "state": "MI"}]},
           {"basic": {"organization_name": " "}, "addresses": [{"city": "X", "state": "Y"}]}]
    registry_df = spark.createDataFrame([(0, json.dumps({"results": res}))], "page int, body string")
    hits = spark.createDataFrame([
        ("0:0", 0, "https://www.npiprofile.example.com/x"), ("0:0", 1, "https://state.example.gov/"),
        ("0:0", 2, "https://smile.example.com/"), ("0:1", 0, "https://bright.example.com/")],
        "clinic_id string, rank int, href string")
    pages = spark.createDataFrame([("smile.example.com", "<p>Please call us to schedule</p>"),
                                   ("bright.example.com", "<p>Book with ZocDoc</p>")], "domain string, html string")
    contacts = spark.createDataFrame([("smile.example.com", 0, "Al", "B", "Dentist", "al@smile.example.com"),
                                      ("smile.example.com", 1, "Cy", "D", "Office Manager", "cy@smile.example.com")],
                                     "domain string, pos int, first_name string, last_name string, position string, value string")
    out, rej = FL.clinic_leads(registry_df, hits, pages, contacts)
    got = [(r["clinic_name"], r["website"], r["contact_email"], r["icp_score"]) for r in out.collect()]
    assert got == [("SMILE DENTAL", "smile.example.com", "cy@smile.example.com", 91)]  # Bright scored 11 (portal)
    assert rows(rej) == [("forbidden_keyword", 1), ("ok", 2), ("restricted_suffix", 1)]


def test_p4_clinic_contacts(spark):
    seed = spark.createDataFrame([("Acme Dental", "acme.example.com"), ("Bee Dental", "https://bee.example.com")],
                                 "clinic_name string, website string")
    contacts = spark.createDataFrame([("acme.example.com", 0, "A", "B", None, "a@acme.example.com"),
                                      ("bee.example.com", 0, "C", "D", "Practice Manager", "c@bee.example.com")],
                                     "domain string, pos int, first_name string, last_name string, position string, value string")
    got = rows(FL.clinic_contacts(seed, contacts), "clinic_name", "contact_title", "email_source")
    assert got == [("Acme Dental", "General/Unknown", "contacts:fallback"),
                   ("Bee Dental", "Practice Manager", "contacts:matched")]


def test_p5_p6_p7_dealers(spark):
    branch = CARDS.replace("Acme Tractor - Lansing", "ACME tractor - Saginaw").replace("Lansing, MI 48910", "Saginaw, MI 48601")
    unnamed = CARDS.replace("Acme Tractor - Lansing, MI", " ")
    no_city = CARDS.replace("Acme", "Bolt").replace("Lansing, MI 48910", "MI 48910")
    pages = spark.createDataFrame([(1, CARDS), (2, branch), (3, unnamed), (4, no_city)], "page_no int, html string")
    dealers = FL.dealer_cards(pages)
    # John Smith (bare person name, short address) is excluded; the page-2
    # branch of Acme collapses onto the first by normalised name; cards
    # without a name or a city are dropped
    assert rows(dealers, "company_key", "company", "city", "state", "zip", "phone") == [
        ("acme tractor", "Acme Tractor", "Lansing", "MI", "48910", "5551234")]
    hits = spark.createDataFrame([
        ("acme tractor", 1, 0, "https://www.yelp.com/biz/acme"),
        ("acme tractor", 2, 0, "https://shop.acmetractor.com/"),
        ("acme tractor", 1, 1, "https://maps.apple.com/x")], "company_key string, tier int, rank int, href string")
    withsite = FL.dealer_domains(dealers, hits)
    assert rows(withsite, "website", "found_tier") == [("acmetractor.com", 2)]
    contacts = spark.createDataFrame([
        ("acmetractor.com", 0, "Gm", "One", "General Manager", "gm@acmetractor.com", 99),
        ("acmetractor.com", 1, "Co", "Own", "Co-Owner", "co@acmetractor.com", None),
        ("acmetractor.com", 2, "Ow", "Two", "Owner", "own@acmetractor.com", 50)],
        "domain string, pos int, first_name string, last_name string, position string, value string, confidence int")
    out, cov = FL.dealer_owners(withsite, contacts)
    assert rows(out, "owner_email") == [("own@acmetractor.com",)]  # owner (rank 0), then higher confidence
    assert cov.first()["pct_owner_email"] == 100.0
    # the best contact has no e-mail: nothing, not the second best
    out, _ = FL.dealer_owners(withsite, contacts.withColumn("value", F.when(F.col("position") != "Owner", F.col("value"))))
    assert rows(out, "owner_name", "owner_email") == [(None, None)]


def test_p8_brand_bridge(spark):
    brands = spark.createDataFrame([(0, "Zeta"), (1, "Alpha"), (2, "Mu"), (3, "Nu")], "ordinal int, brand_name string")
    suggest = spark.createDataFrame([(0, 0, "zeta.example.com"), (1, 0, "amazon.example.com"), (1, 1, "alpha.example.com"),
                                     (3, 0, "nu.example.com")], "ordinal int, rank int, domain string")
    contacts = spark.createDataFrame([
        ("zeta.example.com", 0, "A", "A", "CEO", "ceo@zeta"), ("zeta.example.com", 1, "B", "B", "VP Operations", "ops@zeta"),
        ("nu.example.com", 0, "C", "C", None, "x@nu")],
        "domain string, pos int, first_name string, last_name string, position string, value string")
    cfg = FL.BridgeConfig(blocklist=("amazon",), max_calls=1)
    out, counts = FL.brand_bridge(brands, suggest, contacts, cfg)
    got = {r["brand_name"]: (r["website"], r["contact_email"], r["email_source"]) for r in out.collect()}
    assert got["Zeta"] == ("zeta.example.com", "ops@zeta", "contacts:ops")
    assert got["Alpha"] == (None, None, None)       # C13: blocked first hit, second not used
    assert got["Nu"] == ("nu.example.com", None, None)  # budget of 1 call spent on Zeta
    assert rows(counts) == [("blocked", 1), ("found", 2), ("not_found", 1)]


def test_p9_distributor_bridge(spark):
    firms = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C")], "ordinal int, company_name string")
    suggest = spark.createDataFrame([(0, 0, "a.example.com"), (1, 0, "b.example.com"), (2, 0, "c.example.com")],
                                    "ordinal int, rank int, domain string")
    people = spark.createDataFrame([("a.example.com", 0, "p1", "Al", "X", "Sales"),
                                    ("b.example.com", 0, None, "Bo", "Y", "Ops")],
                                   "domain string, pos int, id string, first_name string, last_name string, title string")
    matches = spark.createDataFrame([("p1", "al@a.example.com")], "id string, email string")
    out = FL.distributor_bridge(firms, suggest, people, matches, FL.BridgeConfig(max_calls=3))
    got = {r["company_name"]: r["email_source"] for r in out.collect()}
    # A costs 2 calls; B has a person without an id, still 2 calls (the
    # match is requested anyway), starting at 2 < 3; C starts at 4: not called
    assert got == {"A": "match:ok", "B": "people:no_id", "C": None}


def test_p10_machine_shops(spark):
    link = '<a rel="noopener noreferrer" class="result__a" href="{h}">{t}</a>'
    html = "".join(link.format(h=h, t=t) for h, t in [
        ("https://www.thomasnet.com/x", "Directory"), ("https://www.precision.example.com/", "Precision CNC - Home"),
        ("https://precision.example.com/about", "Precision again"), ("https://ace.example.com/", "Ace Machining")])
    pages = spark.createDataFrame([(0, html)], "page_no int, html string")
    contacts = spark.createDataFrame([("precision.example.com", 0, "A", "B", "Plant Manager", "pm@precision")],
                                     "domain string, pos int, first_name string, last_name string, position string, value string")
    got = rows(FL.machine_shops(pages, contacts), "company_name", "website", "email_source")
    assert got == [("Ace Machining", "ace.example.com", "not_found"),
                   ("Precision CNC", "precision.example.com", "contacts:matched")]


def test_p11_funded_startups(spark):
    day1 = [("2025-01-05", ln) for ln in INDEX.splitlines()]
    day2 = [("2025-01-06", "D           Acme Robotics Inc (again)                                     0001234567  20250106"
                           "    edgar/data/1234567/0001234567-25-000001.txt"),
            ("2025-01-06", "D           Growth Fund II LP                                             0009999999  20250106"
                           "    edgar/data/9999999/0009999999-25-000009.txt")]
    lines = spark.createDataFrame(day1 + day2, "day string, value string")
    filings = spark.createDataFrame([("edgar/data/1234567/0001234567-25-000001.txt",
                                      "<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry>CA"
                                      "</stateOrCountry></issuerAddress></primaryIssuer></edgarSubmission>")],
                                    "rel_path string, text string")
    out, counts = FL.funded_startups(lines, filings)
    got = rows(out, "accession", "company_name", "cik", "date_filed", "state")
    assert got == [("0000000000-25-000002", "Zero Co", "0", "2025-01-05", ""),
                   ("0001234567-25-000001", "Acme Robotics Inc", "1234567", "2025-01-05", "CA")]
    assert counts.first().asDict() == {"n_kept": 2, "n_removed": 1}


def test_p12_creator_profiles(spark):
    handles = spark.createDataFrame([("alpha",), ("@beta",), ("ghost",), ("gamma",), (" ",)], "handle string")
    channels = spark.createDataFrame([("@alpha", "c1", "100", "1000", "u1"), ("beta", "c2", None, "5", "u2"),
                                      ("gamma", "c3", "7", "7", "u3")],
                                     "handle string, channel_id string, subscriberCount string, viewCount string, uploads string")
    playlist = spark.createDataFrame([("u1", i, f"v{i}") for i in range(20)] + [("u3", 1, "g1"), ("u3", 2, "g2"),
                                                                                 ("u3", 3, "g3")],
                                     "playlist_id string, published_at int, video_id string")
    # g1: view count hidden (counts as 0, still sampled); g3: not returned
    stats = spark.createDataFrame([(f"v{i}", str(10 * i), str(i), None) for i in range(20)] +
                                  [("g1", None, "4", "1"), ("g2", "30", "2", None)],
                                  "video_id string, viewCount string, likeCount string, commentCount string")
    prof, dead, manifest = FL.creator_profiles(handles, channels, playlist, stats)
    p = {r["handle"]: json.loads(r["profile"]) for r in prof.collect()}
    a = p["@alpha"]
    assert a["recent_totals"] == {"n_sampled": 15, "total_views": sum(10 * i for i in range(5, 20)),
                                  "total_likes": sum(range(5, 20)), "total_comments": 0}
    assert a["mean_views"] == 120.0 and a["engagement_rate"] == 10.0
    assert p["@beta"]["recent_totals"]["n_sampled"] == 0 and "mean_views" not in p["@beta"]   # A13
    g = p["@gamma"]
    assert g["recent_totals"] == {"n_sampled": 2, "total_views": 30, "total_likes": 6, "total_comments": 1}
    assert g["mean_views"] == 15.0 and g["engagement_rate"] == round(7 / 30 * 100, 4)
    assert {tuple(r) for r in dead.collect()} == {(None, "blank handle"), ("@ghost", "unknown handle")}
    assert manifest.first().asDict() == {"status": "PARTIAL", "n_processed": 5, "n_failed": 2}


def test_p10_two_result_pages(spark):
    link = '<a rel="noopener noreferrer" class="result__a" href="{h}">{t}</a>'
    page0 = "".join(link.format(h=h, t=t) for h, t in [("https://a.example.com/", "Alpha - Home"),
                                                       ("https://b.example.com/", "Beta")])
    page1 = "".join(link.format(h=h, t=t) for h, t in [("https://b.example.com/x", "Beta again"),
                                                       ("https://c.example.com/", "Gamma")])
    pages = spark.createDataFrame([(0, page0), (1, page1)], "page_no int, html string")
    empty = spark.createDataFrame([], "domain string, pos int, first_name string, last_name string, "
                                      "position string, value string")
    got = rows(FL.machine_shops(pages, empty), "company_name", "website")
    assert got == [("Alpha", "a.example.com"), ("Beta", "b.example.com"), ("Gamma", "c.example.com")]


def test_p3_call_budget(spark):
    res = [{"basic": {"organization_name": n}, "addresses": [{"city": "Troy", "state": "MI"}]} for n in ("A", "B", "C")]
    registry_df = spark.createDataFrame([(0, json.dumps({"results": res}))], "page int, body string")
    hits = spark.createDataFrame([(f"0:{i}", 0, f"https://c{i}.example.com/") for i in range(3)],
                                 "clinic_id string, rank int, href string")
    pages = spark.createDataFrame([(f"c{i}.example.com", "<p>call us</p>") for i in range(3)], "domain string, html string")
    contacts = spark.createDataFrame([(f"c{i}.example.com", 0, "N", str(i), "Office Manager", f"m@c{i}") for i in range(3)],
                                     "domain string, pos int, first_name string, last_name string, position string, value string")
    out, _ = FL.clinic_leads(registry_df, hits, pages, contacts, FL.ClinicConfig(max_calls=2))
    got = rows(out, "clinic_name", "contact_email", "email_source")
    assert got == [("A", "m@c0", "contacts:found"), ("B", "m@c1", "contacts:found"), ("C", None, "")]
