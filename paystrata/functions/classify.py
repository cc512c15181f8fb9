"""Keyword classifiers and identifier extraction from text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from paystrata.functions.parse import _col

# Keyword lists per source of the name, tested in this order.
METHOD_KEYWORDS: dict[str, dict[str, list[str]]] = {
    "listing": {
        "UPI": ["upi", "gpay", "google pay", "phonepe", "paytm", "bhim", "imps", "qr"],
        "CRYPTO": ["bitcoin", "btc", "eth", "ethereum", "crypto", "usdt", "tether", "solana", "dogecoin",
                   "litecoin", "bnb", "xrp", "ripple", "polygon", "shiba", "usdc", "tron"],
        "BANK": ["netbanking", "bank transfer", "neft", "rtgs", "swift", "wire"],
        "WALLET": ["skrill", "neteller", "paypal", "astropay", "mifinity", "ecopayz", "jeton",
                   "muchbetter", "wallet", "webmoney"],
        "CARD": ["visa", "mastercard", "maestro", "amex", "credit card", "debit card"],
    },
    "sink": {
        "UPI": ["upi", "gpay", "phonepe", "paytm", "bhim", "google pay", "qr", "imps"],
        "CRYPTO": ["crypto", "btc", "bitcoin", "eth", "ethereum", "usdt", "tether", "solana", "dogecoin",
                   "bnb", "xrp", "polygon", "usdc", "shiba"],
        "BANK": ["netbanking", "bank transfer", "neft", "rtgs", "swift", "wire", "bank"],
        "WALLET": ["skrill", "neteller", "paypal", "astropay", "mifinity", "wallet", "webmoney", "jeton"],
        "CARD": ["visa", "mastercard", "maestro", "amex", "credit card", "debit card"],
    },
    "sync": {
        "UPI": ["upi", "phonepe", "paytm", "gpay", "google pay", "bhim", "whatsapp"],
        "CRYPTO": ["bitcoin", "eth", "usdt", "crypto", "solana", "xrp", "binance", "trx", "doge", "litecoin"],
        "BANK": ["bank", "transfer", "imps", "netbanking"],
    },
}
METHOD_DEFAULT = {"listing": "UNKNOWN", "sink": "WALLET", "sync": "WALLET"}

# Patterns for payment identifiers.
UPI_PATTERNS = {
    "basic": r"[a-zA-Z0-9.\-_]+@[a-zA-Z0-9]+",
    "strict": r"[a-zA-Z0-9.\-_]{2,256}@[a-zA-Z]{2,64}",
    "not_com": r"[A-Za-z0-9._-]+@[A-Za-z0-9._-]+",
    "any": r"[a-zA-Z0-9._-]+@[a-zA-Z0-9._-]+",
}
UPI_NOISE = ["support@", "info@", "help@", "youremail@", "domain.com", "10cric"]
IFSC_PATTERN = r"[A-Z]{4}0[A-Z0-9]{6}"
ACCOUNT_PATTERN = r"\b\d{9,18}\b"
CRYPTO_PATTERNS = {
    "tron": r"\b(0x[a-fA-F0-9]{40}|[13][a-km-zA-HJ-NP-Z1-9]{26,33}|T[A-Za-z1-9]{33})\b",
    "bech32": r"\b(0x[a-fA-F0-9]{40}|[13][a-km-zA-HJ-NP-Z1-9]{26,33}|bc1[a-z0-9]{39,59})\b",
}
BTC_PATTERN = r"(?:bc1|[13])[a-zA-HJ-NP-Z0-9]{25,90}"
ETH_PATTERN = r"0x[a-fA-F0-9]{40}"


def classify_method(c: Column | str, variant: str = "listing") -> Column:
    """Payment type of a method name; the first keyword group that occurs wins."""
    name = F.lower(_col(c))
    chain = None
    for kind, words in METHOD_KEYWORDS[variant].items():
        # Plain substring tests: a byte scan each, much cheaper than a pattern.
        test = reduce(or_, [name.contains(w) for w in words])
        chain = F.when(test, kind) if chain is None else chain.when(test, kind)
    return chain.otherwise(METHOD_DEFAULT[variant])


def category(has_crypto: Column | str, has_bank: Column | str) -> Column:
    """Training label: crypto 2, bank 1, else 0."""
    return F.when(_col(has_crypto) == 1, 2).when(_col(has_bank) == 1, 1).otherwise(0)


def _first_match(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def extract_upi(c: Column | str, variant: str = "basic") -> Column:
    """First handle in the whole text, after the variant's noise filter; '' if none."""
    text = _col(c)
    if variant in ("basic", "any"):
        found = _first_match(text, UPI_PATTERNS[variant])
    else:
        every = F.regexp_extract_all(text, F.lit(f"({UPI_PATTERNS[variant]})"), F.lit(1))
        if variant == "strict":
            kept = F.filter(every, lambda u: ~F.lower(u).rlike("|".join(w.replace(".", r"\.") for w in UPI_NOISE)))
        else:
            kept = F.filter(every, lambda u: ~F.lower(u).endswith(".com"))
        found = F.try_element_at(kept, F.lit(1))
    # Texts without the sign skip the pattern engine altogether.
    return F.when(text.contains("@"), F.coalesce(found, F.lit(""))).otherwise("")


def extract_bank(c: Column | str, bounded: bool = False) -> dict[str, Column]:
    """First bank code and first 9 to 18 digit run.

    A bank code holds at most seven digits in a row, so a digit run can never be
    part of one and needs no exclusion.
    """
    text = _col(c)
    code = rf"\b{IFSC_PATTERN}\b" if bounded else IFSC_PATTERN
    return {
        "bank_ifsc_code": F.coalesce(F.regexp_extract(text, code, 0), F.lit("")),
        "bank_account_number": F.coalesce(F.regexp_extract(text, ACCOUNT_PATTERN, 0), F.lit("")),
    }


def extract_crypto(c: Column | str, variant: str = "tron") -> Column:
    """First wallet address; '' if none. ``btc_first`` prefers a BTC match anywhere."""
    text = _col(c)
    if variant == "btc_first":
        found = F.coalesce(_first_match(text, BTC_PATTERN), _first_match(text, ETH_PATTERN))
    else:
        found = _first_match(text, CRYPTO_PATTERNS[variant])
    return F.coalesce(found, F.lit(""))


def crypto_network(c: Column | str, variant: str = "prefix") -> Column:
    address = _col(c)
    is_btc = address.startswith("1") | address.startswith("3") | address.startswith("bc1")
    if variant == "btc_first":
        return F.when(is_btc, "BTC").when(address.startswith("0x"), "ERC20").otherwise("")
    return (F.when(address.startswith("0x"), "ERC20/USDT").when(address.startswith("T"), "TRC20/USDT")
            .when(is_btc, "BTC").otherwise(""))


def match_terms(c: Column | str, terms: list[str], ci: bool = False) -> Column:
    """Array of the dictionary terms that occur in a text.

    The dictionary is a short constant, so it travels inside the expression and
    each text is read once: no pairing of the two tables takes place.
    """
    def found(text: Column) -> Column:
        return F.array_compact(F.array(*[F.when(text.contains(t.lower() if ci else t), F.lit(t)) for t in terms]))

    if not ci:
        return found(_col(c))
    # Bound once through a one-element array: lowering the text per term would cost
    # more than all the scans.
    return F.transform(F.array(F.lower(_col(c))), found)[0]
