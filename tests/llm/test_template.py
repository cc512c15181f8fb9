"""Template extraction: tokens, classes, slots, hosts with and without names, edge rows."""

from __future__ import annotations

import html
import random
import re

import pytest

from paystrata.llm import template as T
from paystrata.llm.common import Scratch
from paystrata.llm.queries import QUERIES

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau".split()
SCHEMA = "page_id bigint, url string, html string, text string, host string, grp int, template string, n_chars int"


def extracted(spark, pages):
    frame = spark.createDataFrame([(*p, "x", "y", 1, "z", 2) for p in pages], SCHEMA)
    return {(r.page_id, r.url): r.text for r in T.extracted(frame, Scratch(spark)).collect()}


def prose(rng, n=25):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n)) + "."


def test_hosts(spark):
    urls = ["http://Ex.org/a", "https://u:p@www.ex.org:8080/x?y", "//ex.org", "ex.org/a", "", None, "mailto:x@y", "http://ex.org?q=//z.org"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(T.host_of("url")).collect()]
    assert got == ["ex.org", "www.ex.org", "ex.org", "", "", "", "", "ex.org"]


def test_paths_tell_tokens_apart():
    rows = [(t, k) for t, _, k, *_ in T.tokens("<div class=a><p>x</div><div class=b><p>x</div>") if k == "T"]
    assert len({t for t, _ in rows}) == 2
    # A script's markup is no markup, an unclosed element ends with its container.
    runs = [x for _, _, k, x, e in T.tokens("<script>var t='</p><b>';</script><nav><b>m</nav><p>t<p>u") if k == "T" and not e.aside]
    assert runs == ["t", "u"]


def test_rounds_and_nesting():
    of = {1: 10, 2: 10, 3: 20, 4: 20}
    page = ["<r1>", "<li>", "</li>", "<li>", "</li>", "<r2>"]
    names = {"<r1>": 1, "<r2>": 2, "<li>": 3, "</li>": 4}

    def run(row, monkeypatch=pytest.MonkeyPatch()):
        with monkeypatch.context() as m:
            m.setattr(T, "tokens", lambda _: [(names[t], 0, "<", "", None) for t in row])
            return T.rounds("", of, 10)
    good = run(page)
    assert good[10][1] and good[20][1]
    assert not run(["<li>", "<r1>", "</li>", "<r2>"])[20][1]      # crosses a gap of the root
    assert not run(["<li>", "</li>", "</li>", "<li>"])[20][1]     # no rounds of one order
    assert run(["</li>", "<li>"])[20][0] != good[20][0]           # another order


def test_named_containers_and_templates_text(spark):
    rng = random.Random(1)
    pages, want = [], {}
    for i in range(8):
        title, body = prose(rng, 5), [prose(rng) for _ in range(rng.randint(2, 5))]
        items = "".join(f"<li><a href=/{j}>{rng.choice(WORDS)}</a></li>" for j in range(rng.randint(2, 6)))
        pages.append((i, f"http://a.org/{i}", f"""<html><head><title>{title}</title></head><body><header><h1>A site</h1></header>
          <div class="cookie-notice">We use cookies.</div><ul class="menu">{items}</ul><main><h1>{title}</h1><p>Share this text</p>
          {"".join(f"<p>{b} &amp; <b>caf&eacute;</b>&nbsp;<br>x</p>" for b in body)}
          <div class="ad">{prose(rng)}</div><form><label>Mail</label></form><div id="comments"><p>{prose(rng)}</p></div></main>
          <aside>{prose(rng)}</aside><footer>(c) a.org {i}</footer></body></html>"""))
        want[i, f"http://a.org/{i}"] = "\n\n".join([title, *[f"{b} & café x" for b in body]])
    assert extracted(spark, pages) == want


def test_containers_without_names(spark):
    rng = random.Random(2)
    pages, want = [], {}
    ads = [prose(rng) for _ in range(2)]
    for i in range(12):
        body = [prose(rng, 40) for _ in range(rng.randint(2, 5))]
        items = "".join(f"<li><a href=/{j}>{rng.choice(WORDS)} {rng.choice(WORDS)}</a></li>" for j in range(rng.randint(2, 6)))
        pages.append((i, "http://b.org/", f"<html><body><div><ul>{items}</ul></div><div>{ads[i % 2]}</div>"
                      f"<section><div class=c1><h2>{body[0][:20]}</h2>{''.join(f'<p>{b}</p>' for b in body)}</div></section><div>Contact | Imprint</div></body></html>"))
        want[i, "http://b.org/"] = "\n\n".join([body[0][:20].strip(), *body])
    assert extracted(spark, pages) == want


def test_edge_rows_and_small_hosts(spark):
    page = "<html><body><nav>m</nav><article><h1>T</h1><p>one  two</article></body></html>"
    got = extracted(spark, [(1, None, None), (2, "http://c.org", ""), (3, "http://d.org", "plain &lt;text&gt;\n here"), (None, None, page), (None, None, page),
                            (5, "http://e.org", page), (5, "http://f.org", page), (6, "http://g.org", "<p>p>p>x<b" + " y" * 50_000)])
    assert got[1, None] == "" and got[2, "http://c.org"] == ""
    assert got[3, "http://d.org"] == "plain <text> here"
    assert got[None, None] == got[5, "http://e.org"] == got[5, "http://f.org"] == "T\n\none two"
    assert got[6, "http://g.org"] == "p>p>x<b" + " y" * 50_000
    assert extracted(spark, []) == {}


def test_copies_of_one_page_keep_their_text(spark):
    rng = random.Random(3)
    body = [prose(rng) for _ in range(4)]
    page = f"<html><body><nav>m</nav><article>{''.join(f'<p>{b}</p>' for b in body)}</article><footer>f</footer></body></html>"
    near = [page.replace("<footer>f", f"<footer>f{i}") for i in range(5)]
    got = extracted(spark, [(i, "http://h.org/", p) for i, p in enumerate([page] * 5 + near)])
    assert set(got.values()) == {"\n\n".join(body)}


def test_given_pages(spark, small):
    """The given pages hold their text in one article of headings and paragraphs."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in QUERIES["op12_page_text"](spark, small).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
