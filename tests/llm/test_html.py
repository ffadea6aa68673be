import random
from collections import defaultdict

import pytest

from atlasweave.llm.html import HOLDERS, Extraction, deduce, extract_pages, main_text, parse
from atlasweave.llm.scratch import Scratch

from . import cases

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a>menu</a></li></ul></nav>
<div class="ad">buy</div><div class="promo-box">x</div><article><h1>Head &amp;  line %d</h1><p><b>One<br><p>Two<i>three</i>&nbsp;four</p><aside>side</aside><form>in <input></form><p>Follow us</p>
<table><tr><td>cell</td><td>other</td></tr></table></article><section id="comments"><p>first!</p></section><footer>&copy; f</footer>"""


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % i) for i in range(8)] + [(80 + i, "http://copies.example/", PAGE % 7) for i in range(6)] + [(90, None, None), (91, "nonsense", ""), (92, "http://one.example/", "<p>just text <b>bold</b>tail<p>next&lt;b&gt; <!-- no --> end <span cl"), (None, "http://h.example/0", PAGE % 0)]
    pages = spark.createDataFrame([(*r, "t", 1, "u", "r", "k") for r in rows], "page_id long, url string, html string, text string, host int, uid string, row string, template string")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "Head & line 3"  # what every page of the host has at one place is the template's
    assert got[80].text == "Head & line 7 One Twothree four Follow us cell other"  # a host of copies keeps its text
    assert got[90].text == got[91].text == "" and got[92].text == "just text boldtail next<b> end"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract_pages(pages.where("false")).count() == 0


def test_one_page_by_tags_and_names():
    layout = '<body><div class="with-sidebar"><div class="sidebar">no</div><article><p>yes</p></article><div class="comments"><article>no</article></div></div>'
    assert main_text(layout) == "yes"
    assert main_text(PAGE % 1) == "Head & line 1 One Twothree four Follow us cell other"
    body = "<p>Body of the article.</p>"
    for holder in ('<div class="entry-content share-enabled">', '<div id="main-content" class="no-sidebar">', '<div class="post related-reading-on">'):
        assert main_text(f"<html><body><nav>menu</nav>{holder}{body}</div><footer>f</footer></body></html>") == "Body of the article."
    assert main_text('<article><p class="notice">Kept</p><p>Text</p></article>') == "Kept Text"
    assert main_text(f'<body><form id="aspnetForm"><div>{body}</div></form></body>') == "Body of the article."
    assert main_text("<head><title>t</title><body><p>head was left open</p>") == "head was left open"
    assert main_text("<body><nav>only a menu</nav></body>") == ""


def test_very_long_and_deep_pages():
    long = "<article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    assert len(main_text(long)) == 100_000 * 12 - 1
    deep = "<div>" * 20_000 + "<p>bottom" + "</div>" * 20_000
    assert main_text(deep) == "bottom"
    assert main_text("<b>" * 5000 + "x" + "</i>" * 5000 + "</b>" * 5000) == "x"


def soup(rng, i, n_pages, copies):
    """A page without telling tags or names: menu, notice on some pages, article, remarks, foot."""
    menu = "".join(f"<div>{w}</div>" for w in ("home", "news", "about"))
    seed = random.Random(copies if i % 10 < 3 else 1000 + i)  # three in ten pages hold the same article
    article = "".join(f"<p>{cases.prose(seed, 30, 100_000)}</p>" for _ in range(seed.randrange(3, 7))) + "<p>read more soon</p>"
    notice = "<div><p>this site is moving</p></div>" if i % 5 else ""
    return f"<html><body><div>{menu}</div><div><h1>{cases.prose(seed, 5, 100_000)}</h1>{article}</div><div>{cases.prose(rng, 3)}</div>{notice}<div>all rights of {i} kept</div></body></html>", article


def test_template_decides_where_tags_tell_nothing(spark):
    rng = random.Random(8)
    made = {i: soup(rng, i, 40, 1) for i in range(40)}
    rows = [(i, f"http://soup.example/{i}", html) for i, (html, _) in made.items()]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (html, _) in made.items():
        head = html[html.index("<h1>") + 4 : html.index("</h1>")]
        paragraphs = [x[: x.index("</p>")] for x in html.split("<p>")[1:]]
        assert got[i] == " ".join([head, *[x for x in paragraphs if x not in ("read more soon", "this site is moving")]])
    assert sum(main_text(html) == got[i] for i, (html, _) in made.items()) == 0


def plain_deduction(pages, p):
    """Tokens of the template and their parts, page lists and all pages held at once."""
    where = defaultdict(lambda: defaultdict(list))  # token -> page -> places
    for i, page in enumerate(pages):
        for place, x in enumerate(page.order):
            where[page.token[x] if x >= 0 else page.blocks[-1 - x][1]][i].append((place, x))
    least = max(p.pages, p.share * len(pages))
    often = {t: at for t, at in where.items() if len(at) >= least and all(len(x) == 1 for x in at.values())}
    classes = defaultdict(list)
    for t, at in often.items():
        classes[tuple(sorted(at))].append(t)

    def above(page, e):
        out = [e]
        while out[-1]:
            out.append(page.parent[out[-1]])
        return out

    out = {}
    for on, members in classes.items():
        turns = defaultdict(set)
        around, fixed, loose = set(), 0, 0
        for i in on:
            page = pages[i]
            seq = sorted(members, key=lambda t: often[t][i][0][0])
            for k, t in enumerate(seq):
                turns[t].add(k)
            ups = []
            for t in members:
                x = often[t][i][0][1]
                ups.append(above(page, max(0, page.parent[x]) if x >= 0 else page.blocks[-1 - x][0]))
                fixed += len(page.blocks[-1 - x][2]) if x < 0 else 0
            common = max(e for e in ups[0] if all(e in u for u in ups))
            common = next(e for e in above(page, common) if e == 0 or page.tag[e] in HOLDERS)
            around.add(page.token[common])
            loose += sum(len(text) for e, t, text, _ in page.blocks if common in above(page, e) and t not in often)
        members = [t for t in members if len(turns[t]) == 1]
        if len(members) < 2 or len(around) > 1 or loose < p.slots * fixed:
            continue
        (anchor,) = around
        usual = p.usual * (len(often[anchor]) if anchor in often else len(pages))
        for t in members:
            if often[t][on[0]][0][1] >= 0 or len(on) >= usual:
                out[t] = len(on)
    return out


@pytest.mark.parametrize("p", [Extraction(), Extraction(pages=3, broadcast=0)])
def test_deduction_is_the_plain_one(spark, p):
    rng = random.Random(4)
    hosts = {}
    for h in range(6):
        n = rng.choice([4, 7, 12, 20])
        hosts[f"h{h}"] = [soup(rng, i, n, h)[0] if h % 2 else PAGE % i + rng.choice(["", "<div>late <p>news</p></div>", "<p>menu</p><p>menu</p>"]) for i in range(n)]
    rows = [(k, h, x) for k, (h, x) in enumerate((h, x) for h, xs in hosts.items() for x in xs)]
    found = deduce(spark.createDataFrame(rows, "uid long, host string, html string"), Scratch(spark, "test"), p).collect()
    got = defaultdict(dict)
    for r in found:
        got[r.host][r.token] = r.pages
        assert 0 <= r.part <= 1 and 0 <= r.links <= 1
    want = {h: t for h, xs in hosts.items() if len(xs) >= p.pages and (t := plain_deduction([parse(x) for x in xs], p))}
    assert got == want and len(want) >= 3
