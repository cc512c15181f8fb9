"""Classifiers, extraction and page facts on invented inputs."""

import pytest
from pyspark.sql import functions as F

from paystrata.functions import classify, pages, parse
from paystrata.operators import report
from paystrata.plans import views  # noqa: F401


def one(spark, text, *columns):
    return tuple(spark.createDataFrame([(text,)], "t string").select(*[c.alias(str(i)) for i, c in enumerate(columns)]).first())


@pytest.mark.parametrize("name, listing, sink, sync", [
    ("PhonePe", "UPI", "UPI", "UPI"), ("Bitcoin (BTC)", "CRYPTO", "CRYPTO", "CRYPTO"),
    ("NetBanking", "BANK", "BANK", "BANK"), ("Skrill", "WALLET", "WALLET", "WALLET"),
    ("Visa", "CARD", "CARD", "WALLET"), ("IMPS", "UPI", "UPI", "BANK"), ("Xyz", "UNKNOWN", "WALLET", "WALLET"),
])
def test_method_types(spark, name, listing, sink, sync):
    got = one(spark, name, *[classify.classify_method("t", v) for v in ("listing", "sink", "sync")])
    assert got == (listing, sink, sync)


def test_upi_variants(spark):
    text = "mail help@site.com or support@bank, pay first.payee-1@okbank or x@y"
    got = one(spark, text, *[classify.extract_upi("t", v) for v in ("basic", "strict", "not_com", "any")])
    assert got == ("help@site", "first.payee-1@okbank", "support@bank", "help@site.com")
    assert one(spark, "no handle", classify.extract_upi("t", "strict")) == ("",)
    assert one(spark, None, classify.extract_upi("t")) == ("",)


def test_bank_and_crypto(spark):
    text = "IFSC ABCD0123456 acc 123456789012 other 998877665544"
    assert one(spark, text, *classify.extract_bank("t").values()) == ("ABCD0123456", "123456789012")
    eth, btc, tron = "0x" + "aB" * 20, "1" + "a" * 30, "T" + "x" * 33
    for address, network in ((eth, "ERC20/USDT"), (btc, "BTC"), (tron, "TRC20/USDT")):
        found = classify.extract_crypto("t")
        assert one(spark, f"pay {address} now", found, classify.crypto_network(found)) == (address, network)
    first = classify.extract_crypto("t", "btc_first")
    assert one(spark, f"{eth} then {btc}", first, classify.crypto_network(first, "btc_first"))[1] == "BTC"


def test_payment_uri(spark):
    uri = "upi://pay?pa=shop%40bank&pn=My%20Shop&am=12.50&cu=INR"
    row = one(spark, uri, parse.parse_payment_uri("t"))[0]
    assert (row["upi_id"], row["upi_name"], row["amount"], row["note"], row["crypto_token"]) == (
        "shop@bank", "My Shop", "12.50", "", None)
    assert one(spark, "TOKEN", parse.parse_payment_uri("t"))[0]["crypto_token"] == "TOKEN"


def test_scalars(spark):
    assert one(spark, "A b/c.d-é", parse.safe_name("t"), parse.slug("t")) == ("A_b_c.d-é", "a_b_c_d__")
    assert one(spark, " 1xbet ", parse.canonical_platform("t"), parse.default_url(F.lit("My Site"))) == (
        "1xBet", "https://mysite.com")
    assert one(spark, "Min: 500 account 77", parse.extract_min_amount("t"), parse.extract_account("t")) == (500.0, "77")
    assert one(spark, "nothing", parse.extract_min_amount("t"), parse.extract_account("t")) == (None, None)
    assert one(spark, "{'upi_id': 'a@b'}", parse.parse_details("t", "upi_id string"))[0]["upi_id"] == "a@b"
    assert one(spark, "x", parse.first_truthy(F.lit(""), F.lit(None), F.lit("z"))) == ("z",)
    assert one(spark, "1e3", parse.to_amount("t")) == (1000.0,)
    assert one(spark, "2024-01-02 03:04:05", F.hour(parse.parse_ts("t"))) == (3,)
    assert one(spark, None, parse.text_length("t"), *parse.payment_flags("t", True).values()) == (0, 0, 0, 0)


def test_extended_flags(spark):
    got = one(spark, "Account bc1" + "q" * 30, *parse.payment_flags("t", True).values())
    assert got == (0, 1, 1)


def test_match_terms(spark):
    got = one(spark, "Pay by UPI or crypto to fiat", classify.match_terms("t", ["UPI", "Crypto to FIAT", "Visa"]),
              classify.match_terms("t", ["UPI", "Crypto to FIAT", "Visa"], ci=True))
    assert got == (["UPI"], ["UPI", "Crypto to FIAT"])


def test_money_and_titles(spark):
    values = [(12345678.0, "₹1.2Cr"), (250000.0, "₹2.5L"), (4500.0, "₹5K"), (999.0, "₹999")]
    df = spark.createDataFrame([(v,) for v, _ in values], "v double")
    assert [r[0] for r in df.select(report.fmt_inr("v")).collect()] == [s for _, s in values]
    assert one(spark, "promo_offers_2026_01.json", report.page_title("t")) == ("Promo Offers",)


def test_conform_fills_absent_columns_only(spark):
    row = parse.conform(spark.createDataFrame([("r", None)], "ref_number string, method string"),
                        ["ref_number", "method", "status", "amount", "text_length"]).first()
    assert tuple(row) == ("r", None, "UNKNOWN", 0.0, 0)


# ----------------------------------------------------------------------- pages

FORM = """<html><head><title>Pay  here</title><meta name="description" content="Deposit page"><script>x="bad@script"</script></head>
<body><h2>Second</h2><h1>First <b>one</b></h1><h1> </h1>
<p>Payee Name: <b>Ann Payee</b></p><div>Name: Bob</div>
<table><tr><td>Account Holder</td><td>Ann Holder</td></tr><tr><td>Bank Name</td><td>Test Bank</td></tr></table>
<div>IFSC: TEST0ABC123 acc 123456789012 / 999988887777</div>
<span>Network</span><b>TRC20</b><div>TAbcdefghijkmnopqrstuvwxyzABCDEFGH</div>
<input type="hidden" value="secret value"><input placeholder="Enter amount" data-id="field one">
<img class="payment-method" alt="PhonePe" src="x.png"><div class="payment-method">Deposit</div>
<div class="payment-method" data-name="Skrill"></div><div class="payment-method">PhonePe</div>
<a href="https://a.example/x">a</a><a href='/rel'>r</a><a class="k" href="//cdn.example">c</a><a href="https://a.example/x">a</a>
</body></html>"""
EMPTY = "<html><body><p>Nothing to see</p></body></html>"


@pytest.fixture(scope="module")
def facts(spark):
    df = spark.createDataFrame([(1, "u1", FORM), (2, "u2", EMPTY), (3, "u3", None)], "page_id int, url string, html string")
    return pages.page_facts(df).withColumn("plain_text", pages.plain_text()).cache()


def row(facts, n):
    return facts.filter(F.col("page_id") == n).first()


def test_plain_text(facts):
    lines = row(facts, 1)["plain_text"].split("\n")
    assert "Enter amount" in lines and "field one" in lines and "secret value" in lines and "PhonePe" in lines
    assert not any("bad@script" in x or x == "Pay  here" for x in lines)
    assert all(x == x.strip() and x for x in lines)
    assert row(facts, 2)["plain_text"] == "Nothing to see" and row(facts, 3)["plain_text"] == ""


def test_metadata(facts):
    m = pages.page_metadata(facts).filter("page_id = 1").first()
    assert (m["page_title"], m["meta_description"]) == ("Pay here", "Deposit page")
    assert [(h["tag"], h["text"]) for h in m["headings"]] == [("H1", "First one"), ("H2", "Second")]


def test_reference_urls(facts):
    got = facts.filter("page_id = 1").select(pages.reference_urls("html").alias("a"),
                                             pages.reference_urls("html", relative=True).alias("b")).first()
    assert got["a"] == ["https://a.example/x", "//cdn.example"] and "/rel" in got["b"]


def test_labels_and_filters(facts):
    out = facts.withColumn("d", pages.transaction_details(F.col("plain_text"))).select(
        "page_id", "d", pages.has_payment_identifiers("d").alias("keep"),
        pages.has_payment_form(F.col("plain_text")).alias("form")).orderBy("page_id").collect()
    d = out[0]["d"]
    assert d["bank_holder_name"] == "Ann Holder" and d["bank_name"] == "Test Bank"
    assert d["bank_ifsc_code"] == "TEST0ABC123" and d["bank_account_number"] == "123456789012"
    assert d["crypto_id"] == "TAbcdefghijkmnopqrstuvwxyzABCDEFGH" and d["crypto_value"] == "TRC20"
    assert d["upi_name"] == ""  # the last label wins, also one without a value of its own
    assert [(r["keep"], r["form"]) for r in out] == [(True, True), (False, False), (False, False)]


def test_payee_label(spark):
    html = "<p>Payee Name: <b>Ann Payee</b></p><div>UPI ID: <i>ann@bank</i></div><label>Beneficiary</label><i>Bea</i>"
    page = pages.page_facts(spark.createDataFrame([(html,)], "html string")).select("page.*").first()
    assert (page["upi_name"], page["upi_label"], page["bank_holder_name"]) == ("Ann Payee", "ann@bank", "Bea")
    assert page["first_holder"] == "Ann Payee"


def test_crypto_needs_value_or_token(spark):
    schema = "upi_id string, bank_holder_name string, bank_ifsc_code string, crypto_id string, crypto_value string"
    df = spark.createDataFrame([(" ", "", None, "0xabc", "")], schema).withColumn("d", F.struct("*"))
    assert not df.select(pages.has_payment_identifiers("d")).first()[0]
    assert df.select(pages.has_payment_identifiers("d", F.lit("tok"))).first()[0]


def test_listing(facts):
    out = pages.listing_methods(facts).orderBy("page_id", "pos").collect()
    assert [(r["page_id"], r["method_name"], r["method_type"], r["data_quality"]) for r in out] == [
        (1, "PhonePe", "UPI", "REAL"), (1, "Skrill", "WALLET", "REAL"),
        (2, parse.NOT_COLLECTED, "UNKNOWN", "NOT_SCRAPED"), (3, parse.NOT_COLLECTED, "UNKNOWN", "NOT_SCRAPED")]
    assert out[0]["deposit_supported"] is True and out[2]["deposit_supported"] is None


def test_listing_attribute_first(facts):
    names = [r["method_name"] for r in pages.listing_methods(facts, attribute_first=True).filter("page_id = 1").orderBy("pos").collect()]
    assert names == ["Skrill", "PhonePe"]


def test_broken_markup_does_not_fail(spark):
    bad = ["<div><p>a</div></p></b><", "<!-- x", "<" * 50, "<a href=x>" * 3000, "&#xZZ;&amp"]
    df = spark.createDataFrame([(b,) for b in bad], "html string")
    assert pages.page_facts(df).select("page").count() == len(bad)
    assert len(pages.page_facts(df).select("page.lines").collect()) == len(bad)


def test_zip_pad_golden(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y", "z"], ["q"])], "id int, a array<string>, b array<string>, c array<string>")
    out = [tuple(r) for r in report.zip_pad(df, ["a", "b", "c"], ["id"]).orderBy("pos").collect()]
    assert out == [(1, 0, "a", "x", "q"), (1, 1, "b", "y", ""), (1, 2, "", "z", "")]


def test_sheets(spark, tmp_path):
    report.write_sheets(spark.createDataFrame([("a", 2)], "scraper string, headings_count int"),
                        spark.createDataFrame([("P", 0)], "page string, pos int"), str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "summary"))
    assert back.columns == ["Scraper", "Headings Count"] and back.first()[1] == "2"


def test_provenance_keeps_given_values(spark):
    out = report.with_provenance(spark.createDataFrame([("1%", None)], "fee string, data_quality string"), "bot").first()
    assert (out["fee"], out["min_deposit"], out["data_quality"], out["collection_agent"]) == (
        "1%", parse.NOT_COLLECTED, "REAL", "bot")
