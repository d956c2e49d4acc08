"""Filings, pages and scorer responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadsmith.operators import documents as DOC

NS_XML = ('<SEC-DOCUMENT><edgarSubmission xmlns="http://example.org/x"><primaryIssuer><issuerAddress>'
          '<stateOrCountry>MI</stateOrCountry></issuerAddress></primaryIssuer></edgarSubmission>')
DESC_XML = ('<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry>  </stateOrCountry>'
            '<stateOrCountryDescription>ONTARIO, CANADA</stateOrCountryDescription></issuerAddress>'
            '</primaryIssuer></edgarSubmission>')
BAD_XML = ('<edgarSubmission><primaryIssuer><issuerAddress><stateOrCountry>OH</issuerAddress>'
           '</edgarSubmission>\nBUSINESS ADDRESS:\n  STREET 1: 1 MAIN\n  STATE: TX\n')
INCORP = "HEADER\nSTATE OF INCORPORATION: DE\n"


def located(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    return [r["s"] for r in df.select("id", DOC.filing_location("doc").alias("s")).orderBy("id").collect()]


def test_location_order_of_sources(spark):
    # Malformed XML -> header; a blank state -> its description
    assert located(spark, NS_XML, DESC_XML, BAD_XML, INCORP, "nothing", None, "") == \
        ["MI", "ONTARIO, CANADA", "TX", "DE", "", "", ""]
    prefixed = NS_XML.replace("<", "<e:").replace("<e:/", "</e:").replace("<e:SEC", "<SEC").replace("<e:edgarSub", "<edgarSub") \
        .replace("</e:edgarSub", "</edgarSub").replace("xmlns=", 'xmlns:e="http://example.org/e" xmlns=')
    two = DESC_XML.replace("<primaryIssuer>", "<primaryIssuer><issuerAddress/></primaryIssuer><primaryIssuer>")
    open_tag = "<edgarSubmission> never closed\nSTATE OF INCORPORATION: NV"
    assert located(spark, prefixed, two, open_tag, DESC_XML.replace("ONTARIO, CANADA", " ") + INCORP) == ["MI", "ONTARIO, CANADA", "NV", "DE"]


def test_location_on_a_large_document(spark):
    # A long document between the header and STATE must not overflow
    big = "BUSINESS ADDRESS:\n" + ("x" * 80 + "\n") * 3000 + "  STATE: CA\n"
    assert located(spark, big) == ["CA"]


PAGE = """<html><head><title>Smile &amp; Co</title><style>p{x:1}</style><script>var a="<p>";</script></head>
<body><header>Top bar</header><nav><a href="tel:+1999">Nav call</a></nav>
<p>Call us to schedule</p>
<p>  <a href="tel:+15551234">Book now</a> </p><!-- hidden comment -->
<div>Open <b>Mon</div><footer>Footer text <a href="tel:1">x</a></footer></body></html>"""


def test_visible_text_and_tel_links():
    text, tel = DOC.visible_text_of(PAGE)
    assert text == "Smile & Co Call us to schedule Book now Open Mon"
    assert tel == 1  # nav/footer links are removed before counting
    assert DOC.visible_text_of("") == ("", 0)


def test_visible_text_udf_runs_once_per_row(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>hi</p>")], "id int, html string")
    out = df.select("id", DOC.visible_text("html").alias("v")).where(F.col("v.tel_count") >= 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    got = {r["id"]: (r["v"]["text"], r["v"]["tel_count"]) for r in out.collect()}
    assert got[2] == ("hi", 0)


def test_rubric_tiers(spark):
    df = spark.createDataFrame([(1, "Please call us to schedule"), (2, "Request an appointment form"),
                                (3, "Book on ZocDoc or call us"), (4, "  "), (5, "hello")], "id int, t string")
    s = DOC.with_rubric(df, "t", ["call us"], ["request an appointment", "form"], ["zocdoc"], out="s")
    got = {r["id"]: (r["s"]["icp_score"], r["s"]["booking_system"]) for r in s.collect()}
    assert got[1] == (91, "Phone Only")
    assert got[2] == (72, "Email/Form")
    assert got[3] == (11, "Portal")      # portals are checked first
    assert got[4] == (0, "Unknown")      # X7
    assert got[5] == (1, "None")


def test_rubric_counts_call_links(spark):
    df = spark.createDataFrame([(1, "hello", 2), (2, "", 1), (3, "on zocdoc", 5), (4, "hello", None), (5, "", 0)], "id int, t string, n int")
    s = DOC.with_rubric(df, "t", ["call us"], ["form"], ["zocdoc"], out="s", tel="n")
    assert {r["id"]: r["s"]["icp_score"] for r in s.collect()} == {1: 92, 2: 91, 3: 11, 4: 1, 5: 0}


def test_response_validation(spark):
    cases = [
        (1, '{"icp_score": 85, "booking_system": " Phone ", "agentic_reasoning": "r"}', 85, "Phone"),
        (2, '{"icp_score": "85", "booking_system": "x", "agentic_reasoning": "r"}', 85, "x"),
        (3, '{"icp_score": 85.7, "booking_system": "x", "agentic_reasoning": "r"}', 85, "x"),
        (4, '{"icp_score": "85.7", "booking_system": "x", "agentic_reasoning": "r"}', 0, "Unknown"),
        (5, '{"icp_score": 150, "booking_system": "x", "agentic_reasoning": "r"}', 100, "x"),
        (6, '{"icp_score": 0, "booking_system": "x", "agentic_reasoning": "r"}', 1, "x"),
        (7, '{"icp_score": "high", "booking_system": "x", "agentic_reasoning": "r"}', 0, "Unknown"),
        (8, '{"icp_score": 50}', 0, "Unknown"),
        (9, "not json", 0, "Unknown"),
        (10, '{"icp_score": 50, "booking_system": "' + "b" * 150 + '", "agentic_reasoning": "r"}', 50, "b" * 100),
    ]
    df = spark.createDataFrame([(i, r) for i, r, _, _ in cases], "id int, r string")
    got = {row["id"]: row["v"] for row in DOC.with_validated_response(df, "r", out="v").collect()}
    for i, _, score, system in cases:
        assert (got[i]["icp_score"], got[i]["booking_system"]) == (score, system), i
    assert got[7]["reasoning"].startswith("Scoring error")


def test_pluggable_scorer_and_counters(spark):
    import pandas as pd

    from leadsmith.operators import metrics as M

    def scorer(texts: pd.Series) -> pd.DataFrame:
        n = texts.fillna("").str.len()
        return pd.DataFrame({"icp_score": (n % 100).astype("int32"), "booking_system": "stub",
                             "reasoning": "length"})

    df = spark.createDataFrame([(1, "abc"), (2, "hello world")], "id int, t string")
    scored = df.select("id", DOC.score_with(scorer, "t").alias("s")).where(F.col("s.icp_score") > 0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    got = {r["id"]: r["s"]["icp_score"] for r in scored.collect()}
    assert got == {1: 3, 2: 11}
    counted, obs = M.with_counters(df, "stage", {"long_text": F.length("t") > 5})
    counted.write.format("noop").mode("overwrite").save()
    assert obs.get == {"n_rows": 2, "long_text": 1}
