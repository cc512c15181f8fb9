"""Facts of collected pages: text, metadata, links, labelled values, listings.

Only reading the markup needs Python: one Arrow-batched function turns ``html``
into a struct of arrays. Everything decided about those arrays is Spark SQL.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.classify import classify_method, extract_bank, extract_crypto, extract_upi
from paystrata.functions.parse import NOT_COLLECTED, _col
from paystrata.operators.validate import GENERIC_NAMES

# Tags, attributes, labels and selectors.
HIDDEN_TAGS = {"script", "style", "head", "meta", "link", "noscript"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
TEXT_ATTRIBUTES = {"value", "alt", "title", "aria-label", "placeholder"}
LISTING_SELECTORS = [
    ".payment-method", ".payment-system", ".payment-item", ".deposit-method", "[class*='payment']",
    "[class*='deposit']", ".method-name", "img[alt]",
]
NAME_ATTRIBUTES = ["data-name", "data-method", "data-payment", "aria-label", "title"]
UPI_LABEL = re.compile(r"UPI ID|VPA|Payee Name|Name", re.IGNORECASE)
HOLDER_LABEL = re.compile(r"Beneficiary|Holder|Account Name", re.IGNORECASE)
BANK_LABEL = re.compile(r"Bank Name", re.IGNORECASE)
CRYPTO_LABEL = re.compile(r"Address|Network|Crypto Address", re.IGNORECASE)
FIRST_HOLDER_LABEL = re.compile(r"(holder|beneficiary|payee|name)\b", re.IGNORECASE)
ANY_LABEL = re.compile(r"UPI ID|VPA|Name|Beneficiary|Holder|Address|Network|Payee", re.IGNORECASE)
FIELD_TAGS = {"span", "div", "td", "label"}
FORM_WORDS = ["BANK", "ACCOUNT", "PAYEE", "HOLDER", "AMOUNT", "DEPOSIT", "SUBMIT"]
COIN_WORDS = ["BTC", "ETH", "LTC", "USDT"]

PAGE_SCHEMA = (
    "title string, description string, headings array<struct<tag:string,text:string>>, lines array<string>, "
    "hrefs array<string>, upi_label string, upi_name string, bank_holder_name string, bank_name string, "
    "crypto_value string, first_holder string, has_form boolean, "
    "listing array<struct<selector_rank:int,pos:int,text:string,alt:string,name:string,named:string>>"
)


class _Document(HTMLParser):
    """Tags and visible texts of a page as flat lists in document order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags: list[dict] = []
        self.texts: list[tuple[int, int, str]] = []  # position, parent tag, text
        self.title_parts: list[str] = []
        self._open: list[int] = []
        self._hidden = 0
        self._clock = 0
        self.feed(html)
        self.close()
        while self._open:
            self._end()
        self._positions = [t[0] for t in self.texts]
        self._starts = [t["start"] for t in self.tags]

    def _end(self) -> None:
        tag = self.tags[self._open.pop()]
        tag["end"] = self._clock
        self._hidden -= tag["tag"] in HIDDEN_TAGS

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._clock += 1
        parent = self._open[-1] if self._open else -1
        hidden = self._hidden > 0 or tag in HIDDEN_TAGS
        self.tags.append({"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "parent": parent,
                          "start": self._clock, "end": self._clock, "hidden": hidden})
        if tag not in VOID_TAGS:
            self._open.append(len(self.tags) - 1)
            self._hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._end()

    def handle_endtag(self, tag: str) -> None:
        self._clock += 1
        if any(self.tags[i]["tag"] == tag for i in self._open):
            while self.tags[self._open[-1]]["tag"] != tag:
                self._end()
            self._end()

    def handle_data(self, data: str) -> None:
        self._clock += 1
        if self._open and self.tags[self._open[-1]]["tag"] == "title":
            self.title_parts.append(data)
        if not self._hidden:
            self.texts.append((self._clock, self._open[-1] if self._open else -1, data))

    def text(self, tag: dict) -> str:
        a, b = bisect_left(self._positions, tag["start"]), bisect_left(self._positions, tag["end"])
        return "".join(t[2] for t in self.texts[a:b])

    def next_sibling(self, index: int) -> dict | None:
        tag = self.tags[index]
        for other in self.tags[index + 1:]:
            if other["parent"] == tag["parent"]:
                return other
            if other["start"] > tag["end"] and tag["parent"] >= 0 and other["start"] > self.tags[tag["parent"]]["end"]:
                return None
        return None

    def next_tag(self, position: int) -> dict | None:
        at = bisect_left(self._starts, position)
        return self.tags[at] if at < len(self.tags) else None


def _compile(selector: str) -> tuple[str | None, list[str], list[tuple[str, str]]]:
    """One compound selector as (tag, classes, attributes with contained text)."""
    name = re.match(r"[a-z][a-z0-9]*", selector)
    attributes = [(a, part) for a, _, part in re.findall(r"\[([\w-]+)(\*='([^']*)')?\]", selector)]
    return (name.group(0) if name else None, re.findall(r"\.([\w-]+)", re.sub(r"\[.*?\]", "", selector)), attributes)


def _matches(tag: dict, rule: tuple) -> bool:
    name, classes, attributes = rule
    if name and tag["tag"] != name:
        return False
    attrs = tag["attrs"]
    if classes:
        own = attrs.get("class", "").split()
        if any(c not in own for c in classes):
            return False
    return all(a in attrs and part in attrs[a] for a, part in attributes)


def _spaced(text: str) -> str:
    return " ".join(text.split())


def _labels(doc: _Document) -> dict[str, str]:
    out = dict.fromkeys(
        ["upi_label", "upi_name", "bank_holder_name", "bank_name", "crypto_value", "first_holder"], "")
    # One look at the whole text spares most pages the walk.
    if not ANY_LABEL.search("\n".join(t[2] for t in doc.texts)):
        return out
    for position, parent, label in doc.texts:
        if UPI_LABEL.search(label):
            around = doc.text(doc.tags[parent]) if parent >= 0 else ""
            value = around.replace(label, "").strip(": \n").strip()
            if "ID" in label.upper():
                out["upi_label"] = out["upi_label"] or value
            elif "NAME" in label.upper():
                out["upi_name"] = value
        if CRYPTO_LABEL.search(label):
            following = doc.next_tag(position)
            if following:
                out["crypto_value"] = doc.text(following).strip()
    for i, tag in enumerate(doc.tags):
        if tag["hidden"] or tag["tag"] not in FIELD_TAGS | {"p"}:
            continue
        text = doc.text(tag).strip()
        if tag["tag"] in FIELD_TAGS:
            kind = ("bank_holder_name" if HOLDER_LABEL.search(text)
                    else "bank_name" if BANK_LABEL.search(text) else None)
            sibling = doc.next_sibling(i) if kind else None
            if sibling:
                out[kind] = doc.text(sibling).strip()
        if not out["first_holder"] and FIRST_HOLDER_LABEL.search(text) and i + 1 < len(doc.tags):
            out["first_holder"] = doc.text(doc.tags[i + 1]).strip()
    return out


def _has_form(doc: _Document) -> bool:
    for tag in doc.tags:
        name, attrs = tag["tag"], tag["attrs"]
        if name in ("select", "form", "canvas", "svg") or (name == "input" and attrs.get("type") != "hidden"):
            return True
        if name == "img" and (attrs.get("src", "").startswith("data:image") or "qr" in attrs.get("src", "").lower()):
            return True
    return False


def _facts(html: str | None, rules: list[tuple]) -> dict:
    doc = _Document(html or "")
    visible = [t for t in doc.tags if not t["hidden"]]
    values = [v for t in visible for a, v in t["attrs"].items()
              if v and (a in TEXT_ATTRIBUTES or a.startswith("data-"))]
    pieces = [t[2] for t in doc.texts] + values
    lines = [line.strip() for piece in pieces for line in piece.strip().splitlines() if line.strip()]
    headings = [{"tag": f"H{n}", "text": _spaced(doc.text(t))} for n in range(1, 7)
                for t in visible if t["tag"] == f"h{n}" and _spaced(doc.text(t))]
    listing = [
        {"selector_rank": rank, "pos": pos, "text": _spaced(doc.text(t)), "alt": t["attrs"].get("alt", ""),
         "name": t["attrs"].get("data-name") or t["attrs"].get("title") or "",
         "named": next((t["attrs"][a].strip() for a in NAME_ATTRIBUTES if t["attrs"].get(a)),
                       (doc.text(t).strip().splitlines() or [""])[0].strip())}
        for rank, rule in enumerate(rules)
        for pos, t in enumerate(t for t in visible if _matches(t, rule))]
    return {
        "title": _spaced("".join(doc.title_parts)),
        "description": next((t["attrs"].get("content", "") for t in doc.tags
                             if t["tag"] == "meta" and t["attrs"].get("name") == "description"), ""),
        "headings": headings, "lines": lines,
        "hrefs": [t["attrs"]["href"] for t in doc.tags if t["tag"] == "a" and "href" in t["attrs"]],
        **_labels(doc), "has_form": _has_form(doc), "listing": listing}


def page_facts(pages: DataFrame, html: str = "html", selectors: list[str] | None = None) -> DataFrame:
    """Adds the struct ``page`` and drops the markup from what follows."""
    rules = [_compile(s) for s in (LISTING_SELECTORS if selectors is None else selectors)]

    def read(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_facts(h, rules) for h in batch])

    # Non-deterministic marks the function as costly: it runs once per row even
    # when several fields of the struct are used.
    return pages.withColumn("page", F.pandas_udf(read, PAGE_SCHEMA).asNondeterministic()(html))


def text_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_facts`` without the listing, for callers that need no method names."""
    return page_facts(pages, html, [])


def plain_text() -> Column:
    return F.array_join("page.lines", "\n")


def page_metadata(facts: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    return facts.select(
        *keep, F.col("page.title").alias("page_title"), F.col(url).alias("page_url"),
        F.col("page.description").alias("meta_description"), F.col("page.headings").alias("headings"))


def reference_urls(html: Column | str, relative: bool = False) -> Column:
    """Distinct link targets in order; absolute ones only unless ``relative``."""
    found = F.regexp_extract_all(_col(html), F.lit(r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    kept = found if relative else F.filter(found, lambda h: h.startswith("http") | h.startswith("//"))
    return F.array_distinct(kept)


def transaction_details(text: Column, page: str = "page") -> Column:
    """Identifiers of one page: from its text, then from its labels."""
    bank = extract_bank(text)
    crypto = extract_crypto(text)
    upi = extract_upi(text, "basic")
    return F.struct(
        F.when(upi != "", upi).otherwise(F.col(f"{page}.upi_label")).alias("upi_id"),
        F.col(f"{page}.upi_name").alias("upi_name"), F.col(f"{page}.bank_holder_name").alias("bank_holder_name"),
        bank["bank_account_number"].alias("bank_account_number"), bank["bank_ifsc_code"].alias("bank_ifsc_code"),
        F.col(f"{page}.bank_name").alias("bank_name"), crypto.alias("crypto_id"),
        F.col(f"{page}.crypto_value").alias("crypto_value"))


def has_payment_identifiers(details: Column | str, crypto_token: Column | None = None) -> Column:
    """A handle, a bank holder or code, a wallet id with its value, or a token."""
    d = _col(details)

    def given(c: Column) -> Column:
        return F.trim(F.coalesce(c, F.lit(""))) != ""

    keep = (given(d["upi_id"]) | given(d["bank_holder_name"]) | given(d["bank_ifsc_code"])
            | (given(d["crypto_id"]) & given(d["crypto_value"])))
    return keep | given(crypto_token) if crypto_token is not None else keep


def has_payment_form(text: Column, page: str = "page") -> Column:
    """Whether the page shows a loaded payment form, code image or payment words."""
    upper = F.upper(text)
    words = upper.rlike("|".join(FORM_WORDS)) | text.rlike("|".join(COIN_WORDS))
    return F.col(f"{page}.has_form") | (extract_upi(text, "not_com") != "") | words


def listing_methods(facts: DataFrame, keep: tuple[str, ...] = ("page_id",), attribute_first: bool = False) -> DataFrame:
    """Payment methods a page lists, one row each; a page without any gets a
    NOT_SCRAPED row. The first selector with a usable name decides."""
    def usable(e: Column) -> Column:
        name = F.trim(e["named"]) if attribute_first else F.trim(F.coalesce(
            F.nullif(e["text"], F.lit("")), F.nullif(e["alt"], F.lit("")), e["name"]))
        return F.struct(e["selector_rank"].alias("selector_rank"), e["pos"].alias("pos"), name.alias("name"))

    named = F.filter(F.transform("page.listing", usable), lambda e: (F.length(e["name"]) >= 2)
                     & ~F.lower(e["name"]).isin(GENERIC_NAMES))
    best = F.array_min(F.transform("__named", lambda e: e["selector_rank"]))
    chosen = F.array_distinct(F.transform(
        F.filter("__named", lambda e: e["selector_rank"] == F.col("__best")), lambda e: e["name"]))
    found = F.col("method_name") != NOT_COLLECTED
    return (
        facts.withColumn("__named", named).withColumn("__best", best).withColumn("__names", chosen)
        .select(*keep, F.posexplode(F.when(F.size("__names") > 0, F.col("__names"))
                                    .otherwise(F.array(F.lit(NOT_COLLECTED)))).alias("pos", "method_name"))
        .withColumns({
            "method_type": F.when(found, classify_method("method_name", "listing")).otherwise("UNKNOWN"),
            "deposit_supported": F.when(found, F.lit(True)),
            "data_quality": F.when(found, "REAL").otherwise("NOT_SCRAPED")}))
