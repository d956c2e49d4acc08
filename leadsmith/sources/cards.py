"""Listing-card parser used inside ``mapInPandas``.

A card is ``<div class="dealer-directory-listing">`` holding the company
link, address lines and an optional ``tel:`` link. Parsed with the stdlib
``html.parser``; returns one tuple per card.
"""

from __future__ import annotations

from html.parser import HTMLParser

# CSS classes of a listing card and its fields.
CARD_CLASS = "dealer-directory-listing"
NAME_CLASS = "dealer-title-text"
DATA_CLASS = "dealer-data-text"


class _Cards(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cards: list[dict] = []
        self.depth = 0          # div depth inside the current card
        self.field = None       # 'name' | 'data' | 'tel'
        self.cur = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        if tag == "div" and CARD_CLASS in classes and self.cur is None:
            self.cur = {"name": "", "data": [], "tel_href": None, "tel_text": ""}
            self.depth = 1
            return
        if self.cur is None:
            return
        if tag == "div":
            self.depth += 1
            if DATA_CLASS in classes:
                self.cur["data"].append("")
                self.field = "data"
        elif tag == "a" and NAME_CLASS in classes:
            self.field = "name"
        elif tag == "a" and (a.get("href") or "").startswith("tel:"):
            self.cur["tel_href"] = a.get("href")
            self.field = "tel"

    def handle_endtag(self, tag):
        if self.cur is None:
            return
        if tag == "a" and self.field in ("name", "tel"):
            self.field = None
        elif tag == "div":
            if self.field == "data":
                self.field = None
            self.depth -= 1
            if self.depth == 0:
                self.cards.append(self.cur)
                self.cur = None

    def handle_data(self, data):
        if self.cur is None or self.field is None:
            return
        if self.field == "name":
            self.cur["name"] += data
        elif self.field == "tel":
            self.cur["tel_text"] += data
        else:
            self.cur["data"][-1] += data


def parse_cards(html: str) -> list[tuple]:
    """(company, address, city_line, tel_href, phone_text) per card."""
    p = _Cards()
    p.feed(html)
    p.close()
    out = []
    for c in p.cards:
        data = [d.strip() for d in c["data"]]
        out.append((c["name"].strip(), data[0] if data else "", data[1] if len(data) > 1 else "",
                    c["tel_href"], c["tel_text"].strip()))
    return out
