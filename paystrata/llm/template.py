"""Main text of pages by the template their host shares.

A page is a sequence of tokens: tags and runs of text, each under the path of the containers
that enclose it, so the same tag in another place is another token. Over the pages of one host
a token has an occurrence vector, its count in every page; it is carried as sums of the counts
times hashes of the pages, so vectors of any length are compared by two numbers. Tokens of
equal vectors form an equivalence class. A class is valid if it holds two tokens or more, is
found in a quarter of the pages, comes in one and the same order in each of them, and nests:
every round of it lies within one gap of the root class, the largest of those found once in
every page. The tokens of valid classes are the host's template; what stands between two of
them is a slot.

A host's main text is the ``article`` or ``main`` of its template. Where there is none, it is
the deepest container that holds most of the text that is not under a link, repeated on other
pages or named as something else (menus, footers, adverts and so on, by tag, role, class or
id). From its slots come the blocks; text that is itself part of the template goes, unless
that leaves less than goes. A host of fewer than three different pages is read with the
template of all such hosts together.

All pages are counted. What a task counts is bounded (it hands over what it has when full),
classes and verdicts are Spark aggregates by host, and a template holds at most four times the
tokens of a page, since each is found in a quarter of the pages. A host with any share of the
pages is spread over all tasks in every pass.

Defined cases: null or empty html gives the empty text, a null url a host without a name.
Repeated rows and equal ids are pages of their own; equal html counts once as a different
page. A page without any markup is one text. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, column
from paystrata.llm.registry import query

#: Different pages a host needs for a template of its own.
LEAST_PAGES = 3
#: One page in so many must hold a class.
SUPPORT = 4
#: Share of a host's own text that its main container holds, if no article or main does.
MOST = 0.6

# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
#: Containers whose names make up the path.
CONTAINERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 dt dd li td th tr tbody thead tfoot option optgroup".split())
#: An open one of these ends where another begins.
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = BLOCKS - frozenset("body head html option optgroup title td th tr tbody thead tfoot caption legend summary".split())
ASIDE_TAGS = frozenset("nav footer aside form script style noscript template iframe head title select button textarea menu dialog object svg canvas".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class or id that name what is not the main text.
ASIDE_WORDS = frozenset(
    "ad ads adsbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion "
    "recommended related replies reply respond search share sharebar sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_MASK = (1 << 63) - 1


def _hash(text: str, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed) & _MASK


class _Open:
    """An open element."""
    __slots__ = ("name", "path", "aside", "main", "link", "chain")

    def __init__(self, name, path, aside, main, link, chain):
        self.name, self.path, self.aside, self.main, self.link = name, path, aside, main, link
        #: Paths of the containers around it, its own last.
        self.chain = chain if chain and chain[-1] == path else (*chain, path)


_LABELS: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def _label(name: str, attributes: str) -> tuple[str, bool, bool]:
    """An element's name for the path, and whether it names something aside or the main text."""
    found = _LABELS.get((name, attributes))
    if found is None:
        got = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        named = f"{got.get('class', '')} {got.get('id', '')}"
        role, words = got.get("role", "").lower(), {w.lower() for w in _NAME.findall(named)}
        main = name in ("article", "main") or role in ("main", "article") or "articlebody" in got.get("itemprop", "").lower()
        aside = name in ASIDE_TAGS or role in ASIDE_ROLES or "hidden" in got or (name not in ("html", "body") and not main and bool(words & ASIDE_WORDS))
        if len(_LABELS) > 20_000:
            _LABELS.clear()
        found = _LABELS[name, attributes] = (f"{name}|{_DIGITS.sub('0', named.strip())}|{role}", aside, main)
    return found


def tokens(page: str) -> Iterator[tuple[int, int, str, str, _Open]]:
    """(token, path, kind, text, element) in page order.

    kind: ``<`` a tag, ``|`` a tag that ends a block, ``T`` a run of text, ``R`` text of a raw element.
    """
    top = _Open("", 0, False, False, False, ())
    stack = [top]
    at = 0
    while True:
        tag = _TAG.search(page, at)
        end = tag.start() if tag else len(page)
        if end > at:
            text = page[at:end]
            if not text.isspace():
                yield _hash(text, top.path + 1), top.path, "T", text, top
            elif text:
                yield 0, top.path, "T", " ", top
        if not tag:
            return
        at = tag.end()
        name = tag[3]
        if name is None:
            if tag[1]:
                yield _hash(tag[1], top.path + 1), top.path, "T", tag[1].replace("&", "&amp;"), top
            continue
        name = name.lower()
        if tag[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    path = stack[i].path
                    del stack[i:]
                    top = stack[-1]
                    yield _hash(f"/{name}", path), top.path, "|" if name in BLOCKS else "<", "", top
                    break
                if stack[i].name in ("article", "main", "body") and name not in BLOCKS:
                    break
            continue
        if name in ENDS_P or name in CLOSED_BY:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p" and name in ENDS_P or stack[i].name in CLOSED_BY.get(name, ()):
                    del stack[i:]
                    break
                if stack[i].name in CONTAINERS:
                    break
            top = stack[-1]
        label, aside, main = _label(name, tag[4])
        if name == "header" and not top.main:
            aside = True
        path = _hash(label, top.path) if name in CONTAINERS or aside or main else top.path
        yield _hash(label, top.path + 2), top.path, "|" if name in BLOCKS else "<", name, top
        if name in VOID or tag[4].endswith("/") and name in ("path", "svg"):
            continue
        opened = _Open(name, path, top.aside or aside, top.main or main and not (top.aside or aside), top.link or name == "a", top.chain)
        if name in RAW:
            close = _RAW_ENDS[name].search(page, at)
            stop = close.start() if close else len(page)
            if stop > at:
                yield _hash(page[at:stop], path + 1), path, "R", page[at:stop], opened
            at = close.end() if close else stop
            if close:
                yield _hash(f"/{name}", path), top.path, "|" if name in BLOCKS else "<", "", top
            continue
        stack.append(opened)
        top = opened


def host_of(url: Column | str) -> Column:
    """Lower-case host name of an address, empty if it has none."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


_COUNTS = ("host bigint, token bigint, path bigint, pages bigint, n bigint, s1 bigint, s2 bigint, size bigint, text boolean, main boolean, chain array<bigint>")
_HALF = (1 << 31) - 1
#: Counted tokens a task holds before it hands them over.
_HELD = 400_000


def counted(pages: DataFrame) -> DataFrame:
    """Tokens of all pages (host, html): how many pages and how often, and the sums that stand for the vector.

    ``size`` is the length of a text that is not under a link or aside, else 0; ``chain`` the
    containers around it. A task adds up what it has seen of a host.
    """
    names = [c.split()[0] for c in _COUNTS.split(", ")]

    def count(batches):
        held: dict[tuple[int, int], list] = {}

        def out():
            rows = [(host, token, *v) for (host, token), v in held.items()]
            held.clear()
            for at in range(0, len(rows), 50_000):
                columns = list(zip(*rows[at:at + 50_000]))
                kinds = [pa.int64()] * 8 + [pa.bool_()] * 2 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            hosts, texts = column(batch, "host").to_pylist(), column(batch, "html")
            for host, page in zip(hosts, texts):
                page = page.as_py()
                of = _hash(page, 7)
                a, b = of & _HALF, of >> 31 & _HALF
                seen: set[int] = set()
                for token, path, kind, text, element in tokens(page):
                    if not token:
                        continue
                    v = held.get((host, token))
                    if v is None:
                        size = len(text) if kind == "T" and not element.link and not element.aside else 0
                        v = held[host, token] = [path, 0, 0, 0, 0, size, kind in "TR", element.main and size > 0, element.chain if size else None]
                    v[1] += token not in seen
                    seen.add(token)
                    v[2] += 1
                    v[3] = v[3] + a & _HALF
                    v[4] = v[4] + b & _HALF
                if len(held) >= _HELD:
                    yield from out()
        yield from out()
    return pages.mapInArrow(count, _COUNTS)


def rounds(page: str, of: dict[int, int], root: int) -> dict[int, tuple[int, bool]]:
    """Each class's order on a page (a number that stands for it), and whether it comes in rounds of that
    order, each within one gap of the root class."""
    seen: dict[int, list[int]] = {}
    gaps: dict[int, list[int]] = {}
    gap = 0
    for token, *_ in tokens(page):
        known = of.get(token)
        if known is not None:
            gap += known == root
            seen.setdefault(known, []).append(token)
            gaps.setdefault(known, []).append(gap)
    out = {}
    for known, row in seen.items():
        size = len(set(row))
        fine = len(row) % size == 0 and row == row[:size] * (len(row) // size) and len(set(row[:size])) == size
        if known != root:
            fine = fine and all(len(set(gaps[known][at:at + size])) == 1 for at in range(0, len(row), size))
        out[known] = (_hash(" ".join(map(str, row[:size])), 3), fine)
    return out


def checked(pages: DataFrame) -> DataFrame:
    """(host, class, order, other, fine) as far as a task has seen it; ``pages`` has the candidates beside the html."""
    names = ["host", "class", "least", "most", "fine"]

    def check(batches):
        held: dict[tuple[int, int], list] = {}

        def out():
            if held:
                columns = zip(*[(*k, *v) for k, v in held.items()])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.bool_()])], names)
                held.clear()

        for batch in batches:
            groups, roots, given = (column(batch, c).to_pylist() for c in ("grp", "root", "given"))
            last, of = None, {}
            for i, page in enumerate(column(batch, "html")):
                if groups[i] != last:
                    last, of = groups[i], {g["token"]: g["class"] for g in given[i]}
                for known, (order, fine) in rounds(page.as_py(), of, roots[i]).items():
                    v = held.setdefault((groups[i], known), [order, order, True])
                    v[0], v[1], v[2] = min(v[0], order), max(v[1], order), v[2] and fine
            if len(held) >= _HELD:
                yield from out()
        yield from out()
    return pages.mapInArrow(check, "host bigint, class bigint, least bigint, most bigint, fine boolean")


def main_text(page: str, template: frozenset[int], inside: int | None) -> str:
    """Blocks of the page's main text; ``inside``: path of the main container, None for article and main."""
    def blocks(chosen):
        out: list[tuple[str, int, bool, bool]] = []
        run: list[str] = []
        slot, linked, own = 0, 0, True

        def end():
            nonlocal run, linked, own
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                out.append((text, slot, own, 2 * linked > len(text)))
            run, linked, own = [], 0, True

        for token, path, kind, text, element in tokens(page):
            if kind == "|":
                end()
            slot += kind in "<|" and token in template
            if kind == "<" and text == "br":
                run.append(" ")
            if kind == "T" and not element.aside and chosen(element):
                run.append(text)
                linked += len(text.strip()) if element.link else 0
                own = own and token in template
        end()
        return out

    if inside is None:
        found = blocks(lambda e: e.main)
    else:
        found = blocks(lambda e: inside in e.chain)
        by_slot: dict[int, list[int]] = {}
        for text, slot, _, linked in found:
            sizes = by_slot.setdefault(slot, [0, 0])
            sizes[linked] += len(text)
        found = [b for b in found if by_slot[b[1]][0] >= by_slot[b[1]][1]] or found
    if not found:
        found = blocks(lambda e: True)
    fixed = sum(len(text) for text, _, own, _ in found if own)
    if 2 * fixed <= sum(len(text) for text, *_ in found):
        found = [b for b in found if not b[2]]
    return "\n\n".join(text for text, *_ in found)


def extracted(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(host_of("url")).alias("host"))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("all"), F.count_distinct(F.xxhash64("html")).alias("different"))
    hosts = scratch.keep(hosts.select("host", F.when(F.col("different") >= LEAST_PAGES, F.col("host")).otherwise(0).alias("grp"), "all"), "hosts")
    sizes = hosts.groupBy("grp").agg(F.sum("all").alias("all"))

    # Vectors by group; a token found in a quarter of the pages may be part of the template.
    vector = counted(pages.select("host", "html")).join(hosts.select("host", "grp"), "host").groupBy("grp", "token").agg(
        *[F.sum(c).alias(c) for c in ("pages", "n")], *[(F.sum(c) % (_HALF + 1)).alias(c) for c in ("s1", "s2")],
        *[F.min(c).alias(c) for c in ("path", "chain")], F.max("size").alias("size"), F.max("main").alias("main"))
    often = F.col("pages") * SUPPORT >= F.col("all")
    leaves = scratch.keep(
        vector.join(sizes, "grp").groupBy("grp", "path", "all").agg(
            F.sum("size").alias("own"), F.sum(F.when(F.col("main"), F.col("size")).otherwise(0)).alias("main"), F.min("chain").alias("chain"),
            F.collect_list(F.when(often, F.struct("token", "pages", "n", "s1", "s2"))).alias("often")), "leaves")

    # Classes of equal vectors; the root has the most tokens among those found once in every page.
    each = leaves.select("grp", "all", F.explode("often").alias("t")).select("grp", "all", "t.*")
    shape = ["pages", "n", "s1", "s2"]
    classes = each.groupBy("grp", "all", *shape).agg(F.collect_list("token").alias("tokens")).filter(F.size("tokens") >= 2)
    classes = classes.withColumn("class", F.xxhash64(*shape))
    once = (F.col("pages") == F.col("all")) & (F.col("n") == F.col("all"))
    roots = classes.filter(once).groupBy("grp").agg(F.max_by("class", F.struct(F.size("tokens"), "class")).alias("root"))
    candidates = scratch.keep(
        classes.select("grp", "class", F.explode("tokens").alias("token")).groupBy("grp").agg(F.collect_list(F.struct("token", "class")).alias("given"))
        .join(roots, "grp", "left").withColumn("root", F.coalesce("root", F.lit(0).cast("bigint"))), "candidates")

    # Valid ones keep one order in all pages and nest in the root's gaps.
    by_host = scratch.keep(hosts.select("host", "grp").join(candidates, "grp"), "by_host")
    valid = checked(pages.select("host", "html").join(by_host, "host").select("grp", "root", "given", "html"))
    valid = valid.groupBy(F.col("host").alias("grp"), "class").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.every("fine").alias("fine"))
    valid = valid.filter(F.col("fine") & (F.col("least") == F.col("most"))).select("grp", "class")
    template = candidates.select("grp", F.explode("given").alias("g")).select("grp", "g.*").join(valid, ["grp", "class"])
    template = template.groupBy("grp").agg(F.collect_list("token").alias("template"))

    # Where the main text stands: article or main, else the deepest container with most of the own text.
    whole = leaves.groupBy("grp").agg(F.sum("own").alias("whole"), F.sum("main").alias("main"))
    inner = leaves.filter("own > 0").select("grp", "own", F.posexplode("chain").alias("depth", "inside")).groupBy("grp", "depth", "inside").agg(F.sum("own").alias("own"))
    inner = inner.join(whole, "grp").filter(F.col("own") >= F.col("whole") * MOST)
    inner = inner.groupBy("grp").agg(F.max_by("inside", F.struct("depth", "own")).alias("inside"))
    verdict = whole.join(inner, "grp", "left").select(
        "grp", F.when((F.col("main") > 0) | F.col("inside").isNull(), F.lit(None).cast("bigint")).otherwise(F.col("inside")).alias("inside"))
    rules = scratch.keep(hosts.select("host", "grp").join(verdict.join(template, "grp", "left"), "grp", "left").drop("grp"), "rules")

    def extract(batches):
        for batch in batches:
            templates, insides = column(batch, "template").to_pylist(), column(batch, "inside").to_pylist()
            texts, last, known = [], None, frozenset()
            for i, page in enumerate(column(batch, "html")):
                if templates[i] != last:
                    last, known = templates[i], frozenset(templates[i] or ())
                texts.append(main_text(page.as_py(), known, insides[i]))
            yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = pages.join(rules, "host", "left").select("page_id", "url", "html", "template", "inside")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return joined.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


@query("op12_page_text")
def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length."""
    texts = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"), Scratch(spark))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
