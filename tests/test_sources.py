"""Scans and sinks on micro-fixtures."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from leadsmith import sinks as K
from leadsmith.functions import calendar as CAL
from leadsmith.sources import landed as S
from tests.conftest import rows

INDEX = """Description:           Daily Index of EDGAR Dissemination Feed
Last Data Received:    Jan 5, 2025

Form Type   Company Name                                                  CIK         Date Filed  File Name
---------------------------------------------------------------------------------------------------------
D           Acme Robotics Inc                                             0001234567  20250105    edgar/data/1234567/0001234567-25-000001.txt
D/A         Zero Co                                                       0000000000  20250105    edgar/data/0/0000000000-25-000002.txt
10-K        Big Corp                                                      0007654321  20250105    edgar/data/7654321/x.txt
D           No Path Inc                                                   0001111111  20250105
"""


def test_index_rows(spark):
    lines = spark.createDataFrame([(ln,) for ln in INDEX.splitlines()], "value string")
    got = rows(S.index_rows(lines), "form_type", "company_name", "cik", "date_filed", "rel_path")
    assert got == [("D", "Acme Robotics Inc", "1234567", "20250105", "edgar/data/1234567/0001234567-25-000001.txt"),
                   ("D/A", "Zero Co", "0", "20250105", "edgar/data/0/0000000000-25-000002.txt")]


def test_page_prefix_stops_at_short_page(spark):
    df = spark.createDataFrame([("MI", 0)] * 3 + [("MI", 1)] * 2 + [("MI", 2)] * 3 + [("OH", 0)] * 3,
                               "state string, page int")
    kept = S.page_prefix(df, "state", "page", 3)
    got = rows(kept.groupBy("state", "page", "truncated").count())
    assert got == [("MI", 0, True, 3), ("MI", 1, True, 2), ("OH", 0, False, 3)]
    # a missing page (failed fetch) ends the key; a key whose first page is
    # missing yields nothing
    gap = spark.createDataFrame([("TX", 0)] * 3 + [("TX", 2)] * 3 + [("WA", 1)] * 3, "state string, page int")
    kept = S.page_prefix(gap, "state", "page", 3)
    assert rows(kept.groupBy("state", "page", "truncated").count()) == [("TX", 0, True, 3)]


def test_page_prefix_keeps_all_rows_with_flags(spark):
    df = spark.createDataFrame([("MI", 0)] * 3 + [("MI", 1)] * 2 + [("MI", 2)] * 3 + [("OH", 0)] * 3 + [("TX", 0)] * 3 + [("TX", 2)] * 3,
                               "state string, page int")
    kept = S.page_prefix(df, "state", "page", 3, cut=False)
    assert rows(kept.groupBy("state", "page", "truncated", "after_gap").count()) == [
        ("MI", 0, True, False, 3), ("MI", 1, True, False, 2), ("MI", 2, True, True, 3), ("OH", 0, False, False, 3),
        ("TX", 0, True, False, 3), ("TX", 2, True, True, 3)]


def test_registry_results(spark):
    body = ('{"results": [{"basic": {"organization_name": " Smile Dental "}, "addresses": [{"city": "Troy", '
            '"state": "MI"}, {"city": "X", "state": "Y"}]}, {"basic": {"organization_name": ""}, "addresses": '
            '[{"city": "A", "state": "B"}]}, {"basic": {"organization_name": "No Addr"}, "addresses": []}]}')
    df = spark.createDataFrame([(0, body)], "page int, body string")
    assert rows(S.registry_results(df, "body", ["page"])) == [(0, 0, "Smile Dental", "Troy", "MI")]


def test_csv_roundtrip_keeps_blank(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([("b", "", None), ("a", "x", "y")], "name string, email string, site string")
    K.ordered_csv(df, f"{d}/out", ["name", "missing", "email", "site"], ["name"], single_file=True)
    back = S.read_csv_strings(spark, f"{d}/out", ["name", "email", "site"])
    assert rows(back) == [("a", "x", "y"), ("b", "", "")]
    files = sorted(f for f in os.listdir(f"{d}/out") if f.endswith(".csv"))
    with open(f"{d}/out/{files[0]}", encoding="utf-8") as fh:
        assert fh.read().splitlines()[:2] == ["name,email,site", "a,x,y"]


def test_inferred_csv_drops_blank_required(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    with open(f"{d}/seed.csv", "w") as fh:
        fh.write("clinic_name,website,n\nA,a.example.com,1\nB,,2\n,c.example.com,3\n")
    got = S.read_csv_inferred(spark, f"{d}/seed.csv", ["clinic_name", "website"])
    assert rows(got, "clinic_name") == [("A",)]  # C4: a missing site is not the text 'nan'


def test_backfill_require_select(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    out = S.backfill(df, ["name", "owner_email"])
    assert out.columns == ["id", "name", "owner_email"] and out.first()["owner_email"] == ""
    with pytest.raises(ValueError):
        S.require(df, ["id", "website"])
    assert S.select_existing(out, ["owner_email", "zzz", "id"]).columns == ["owner_email", "id"]


def test_result_links_cap_and_blank(spark):
    link = '<a rel="noopener noreferrer" class="result__a" href="{h}">{t}</a>'
    html = "".join(link.format(h=h, t=t) for h, t in [(" https://a.example.com ", "A"), ("https://b.example.com", "B"),
                                                       ("https://c.example.com", "C")])
    df = spark.createDataFrame([(0, html)], "page int, html string")
    got = rows(S.result_links(df, "html", ["page"], 2))
    assert got == [(0, 0, "https://a.example.com", "A"), (0, 1, "https://b.example.com", "B")]


CARDS = """<div class="dealer-directory-listing"><a class="dealer-title-text">Acme Tractor - Lansing, MI</a>
<div class="dealer-data-text">123 Main Street</div><div class="dealer-data-text">Lansing, MI 48910</div>
<a href="tel:5551234">Call</a></div>
<div class="dealer-directory-listing"><a class="dealer-title-text">John Smith</a>
<div class="dealer-data-text">42</div></div>"""


def test_directory_cards(spark):
    pages = spark.createDataFrame([(1, CARDS)], "page_no int, html string")
    got = rows(S.directory_cards(pages))
    assert got == [(1, 0, "Acme Tractor - Lansing, MI", "123 Main Street", "Lansing, MI 48910", "tel:5551234", "Call"),
                   (1, 1, "John Smith", "42", "", None, "")]


def test_seed_list_head(spark):
    got = S.seed_list(spark, [("Acme",), ("Bolt",), ("Cog",)], "name string", head=2)
    assert rows(got) == [(0, "Acme"), (1, "Bolt")]


def test_dates(spark):
    today = dt.date(2024, 1, 10)
    days = CAL.last_days(spark, today, 7)
    assert sorted(r["day"] for r in days.collect()) == [dt.date(2024, 1, d) for d in range(3, 10)]
    avail = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 8),), (dt.date(2024, 1, 10),)], "day date")
    assert CAL.latest_available(avail, "day", today, 4).first()["day"] == dt.date(2024, 1, 8)
    missing = sorted(r["day"] for r in CAL.missing_days(days, avail).collect())
    assert dt.date(2024, 1, 8) not in missing and len(missing) == 5
    ny = CAL.local_today("America/New_York", dt.datetime(2024, 1, 10, 3, 0, tzinfo=dt.timezone.utc))
    assert ny == dt.date(2024, 1, 9)


def test_pending_and_preview(spark):
    todo = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, company string")
    done = spark.createDataFrame([(1, "x@a")], "id int, owner_email string")
    assert rows(K.pending(todo, done, "id"), "id") == [(2,), (3,)]
    out = todo.join(done, "id", "left")
    assert rows(K.preview(out, ["company", "owner_email"], "owner_email")) == [("a", "x@a")]
    assert F is not None


def test_run_mode_caps_rows(spark):
    df = spark.range(20).withColumnRenamed("id", "ordinal")
    test_mode = K.RunMode(name="test", row_cap=5, call_cap=5, output="out_test.csv")
    assert [r["ordinal"] for r in test_mode.apply(df, ["ordinal"]).collect()] == [0, 1, 2, 3, 4]
    assert K.RunMode().apply(df, ["ordinal"]).count() == 20


def test_whole_documents_and_append(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    for name, body in [("a.txt", "line 1\\nline 2\\n"), ("b.txt", "<edgarSubmission/>")]:
        with open(f"{d}/{name}", "w") as fh:
            fh.write(body)
    docs = S.whole_documents(spark, d)
    got = {os.path.basename(r["path"]): r["text"] for r in docs.collect()}
    assert got == {"a.txt": "line 1\\nline 2\\n", "b.txt": "<edgarSubmission/>"}
    out = f"{d}/done"
    K.append(spark.createDataFrame([(1, "x")], "id int, v string"), out)
    K.append(spark.createDataFrame([(2, "y")], "id int, v string"), out)
    assert rows(spark.read.parquet(out)) == [(1, "x"), (2, "y")]
