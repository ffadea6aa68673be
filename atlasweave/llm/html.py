"""HTML extraction by equivalence-class template deduction.

A page's tokens are its block elements, each named by its path with the place among
siblings of its name, and its text blocks, named by path and text.  Over the pages of
a host, tokens that occur on the same pages form a class: the XOR of hashes of
(page, count) stands for a token's occurrence vector, so classes need counts and no
page lists.  Tokens whose turn within their class differs between pages leave it.  A
class is valid if two tokens or more are left, all in one element, which also encloses
slots: text that no class holds.  (Copies of an article form a class that fills its
element, which is how they differ from a template.)  A text is fixed if most pages
that have that element have the text.  Valid classes nest by their elements and are
the host's template.

What is left lies in slots.  From the root, the element that over all its pages holds
the bulk of its parent's slots is entered, until none does: there the article begins.
Its slots are extracted, without what the template holds and what tags and names tell
to be something else.  Tags and names thus choose between slots; on hosts of few pages,
where no template can be deduced, they and the page's own text decide alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

# Elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
SKIPPED = frozenset("head script style noscript template svg math iframe object canvas button select option datalist audio video map".split())
ASIDE = frozenset("nav footer aside header dialog menu".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"})}
SCOPE = frozenset("html body article section div main aside nav footer header ul ol dl table form blockquote".split())
IN_HEAD = frozenset("base link meta title script style noscript template".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
HOLDERS = frozenset("html body div section article main center table tbody tr td form".split())
BOXES = HOLDERS | frozenset("ul ol dl aside span a fieldset details figure".split())
PROSE = frozenset("p h1 h2 h3 article main blockquote".split())

# Words of class names and ids that tell of something beside the article, and words that go with them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar comment comments discussion disqus reply replies respond "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login social share sharing "
    "related recommended breadcrumb breadcrumbs menu nav navbar navigation toc pagination pager footer masthead topbar toolbar widget widgets skip hidden".split()
)
WITH_MARKS = frozenset("area bar block body bottom box buttons container content form group inner item items left link links list main outer page panel post posts reader right row section site text thread top user wrap wrapper".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|title|textarea|noscript|iframe)(?=[\s/>])((?:"[^"]*"|'[^']*'|[^'">])*)>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
DIGITS = re.compile(r"\d+")
WORD = re.compile(r"[a-z]+|[A-Z]+[a-z]*")

PLAIN, MARKED, FORM, BESIDE = 0, 1, 2, 3
WEIGHT = {PLAIN: 1.0, MARKED: 0.2, FORM: 0.2, BESIDE: 0.0}  # of an element's text where the bulk is looked for


@dataclass(frozen=True)
class Extraction:
    pages: int = 5  # that a template's token has at least
    share: float = 0.01  # of the host's pages that it has at least, which bounds a template's size by its pages' sizes
    usual: float = 0.5  # of the pages with the element around its class that a fixed text is on at least
    slots: float = 0.1  # characters of slots for each of a class's fixed characters
    bulk: float = 0.9  # part of its parent's slots that an element holds where the search enters it
    links: float = 0.8  # part of a box's text that is links, in a menu
    broadcast: int = 1 << 20  # tokens of all templates, of 24 bytes, that are broadcast at most; more are joined by host


@dataclass
class Page:
    """A page's block elements in order, the first being its root, and its text blocks."""

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [-1])
    token: list[int] = field(default_factory=lambda: [0])
    kind: list[int] = field(default_factory=lambda: [PLAIN])
    blocks: list[tuple[int, int, str, int]] = field(default_factory=list)  # element, token, text, characters of links
    order: list[int] = field(default_factory=list)  # elements (number) and blocks (-1 less number) as they come

    def within(self, values: list[float]) -> list[float]:
        """Sums over each element's subtree."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out


def _names(attributes: str) -> tuple[str, int]:
    """An element's classes and id as part of its path, and what they make of it."""
    name, kind = "", PLAIN
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), unescape(value.strip("\"'"))
        if key in ("class", "id"):
            name += "." + DIGITS.sub("#", value)
            for part in value.split():
                words = [w.lower() for w in WORD.findall(part)]
                if any(w in MARKS for w in words) and all(w in MARKS or w in WITH_MARKS for w in words):
                    kind = max(kind, MARKED)
        elif key == "role":
            name += f"@{value}"
            if value.strip().lower() in ROLES:
                kind = BESIDE
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and UNSEEN.search(value)):
            kind = max(kind, MARKED)
    return name, kind


def _hash(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts))) - 2**63


def parse(html: str) -> Page:
    page = Page()
    tags, parents, tokens, kinds = page.tag, page.parent, page.token, page.kind
    plain = [0]  # token of the path without places
    places: dict[tuple[int, str], int] = {}
    opened: dict[str, int] = {}
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]  # tag, element, skipped, link, in an article
    text: list[str] = []
    owner, links, at = 0, 0, 0

    def end_block() -> None:
        nonlocal links
        got = " ".join("".join(text).split())
        if got:
            page.order.append(-1 - len(page.blocks))
            page.blocks.append((owner, _hash(plain[owner], "#", got), got, min(links, len(got))))
        text.clear()
        links = 0

    def close(down_to: int) -> None:
        for entry in stack[down_to:]:
            opened[entry[0]] -= 1
        del stack[down_to:]

    def add(raw: str) -> None:
        nonlocal owner, links
        _, e, skipped, link, _ = stack[-1]
        if skipped:
            return
        if text and e != owner:
            end_block()
        owner = e
        got = unescape(raw) if "&" in raw else raw
        text.append(got)
        if link:
            links += len(got.strip())

    for m in TOKEN.finditer(html):
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        tag = m[4]
        if tag is None:
            if text and m[1] and m[1].lower() == "textarea":
                end_block()
            continue
        tag = tag.lower()
        if text and tag not in INLINE:
            end_block()
        if m[3]:
            if opened.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if tag in ("p", "li", "td", "th", "tr", "dt", "dd") and stack[i][0] in SCOPE:
                        break
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            closed = CLOSED_BY.get(tag, frozenset({"p"}))
            if any(opened.get(c) for c in closed):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in closed:
                        close(i)
                        break
                    if stack[i][0] in SCOPE:
                        break
        if opened.get("head") and stack[-1][0] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in VOID or (m[5].endswith("/") and tag in ("svg", "path")):
            continue
        _, e, skipped, link, inside = stack[-1]
        opened[tag] = opened.get(tag, 0) + 1
        if skipped or tag in SKIPPED:
            stack.append((tag, e, True, link, inside))
            continue
        name, kind = _names(m[5]) if "=" in m[5] or "hidden" in m[5] else ("", PLAIN)
        if tag in ("html", "body", "main"):
            kind = PLAIN
        if tag in ASIDE and not (tag == "header" and inside):
            kind = BESIDE
        elif tag == "form" and kind != BESIDE:
            kind = FORM
        if tag not in INLINE or kind:
            name = tag + name
            place = places[e, name] = places.get((e, name), 0) + 1
            tags.append(tag)
            parents.append(e)
            kinds.append(kind)
            tokens.append(_hash(tokens[e], name, place))
            plain.append(_hash(plain[e], name))
            e = len(tags) - 1
            page.order.append(e)
        stack.append((tag, e, False, link or tag == "a", inside or tag in ("article", "main")))
    if at < len(html):
        add(html[at:])
    end_block()
    return page


def _weighed(page: Page, free: set[int] | None = None) -> list[float]:
    """Characters of text but not of links in each element, weighed by what it is; with ``free``, of those blocks only."""
    weight = [1.0]
    for e in range(1, len(page.tag)):
        weight.append(weight[page.parent[e]] * WEIGHT[page.kind[e]])
    own = [0.0] * len(page.tag)
    for b, (e, _, text, links) in enumerate(page.blocks):
        if free is None or b in free:
            own[e] += weight[e] * (len(text) - links)
    return page.within(own)


#: Of a template's token: part of its parent's slots that is in it, and part of its text that is links.
Entry = tuple[float, float]


def main_text(html: str, template: dict[int, Entry] | None = None, params: Extraction | None = None) -> str:
    """The article's text: its slots, or what tags, names and the page's own text tell of it where ``template`` is empty."""
    p, template = params or Extraction(), template or {}
    page = parse(html)
    if not page.blocks:
        return ""
    n = len(page.tag)
    sums = _weighed(page)
    children: list[list[int]] = [[] for _ in range(n)]
    for e in range(1, n):
        children[page.parent[e]].append(e)
    prose = page.within([float(t in PROSE) for t in page.tag])

    top, chain = 0, {0}
    while True:
        best, most = -1, p.bulk
        for e in children[top]:
            if page.tag[e] not in HOLDERS or page.kind[e] == BESIDE:
                continue
            known = template.get(page.token[e])
            if known is None and (page.kind[e] == MARKED or (page.kind[e] == FORM and not prose[e])):
                continue
            part = known[0] if known else (sums[e] / sums[top] if sums[top] else 0.0)
            if part >= most:
                best, most = e, part
        if best < 0:
            break
        top = best
        chain.add(top)

    # what is inside of the article's element, by its tags and names
    inside, out, article = [False] * n, [False] * n, [False] * n
    inside[top] = True
    for e in range(1, n):
        up = page.parent[e]
        if e in chain:
            article[e] = article[up] or page.tag[e] in ("article", "main")
            continue
        inside[e], kind = inside[up], page.kind[e]
        known = template.get(page.token[e])
        menu = known is not None and known[1] >= p.links and page.tag[e] in BOXES
        out[e] = out[up] or kind in (BESIDE, FORM) or menu or (kind == MARKED and (known is not None or page.tag[e] in BOXES))
        article[e] = article[up] or (page.tag[e] in ("article", "main") and not out[e])
    own = [b for b in page.blocks if inside[b[0]] and not out[b[0]]]
    if not article[top]:
        own = [b for b in own if article[b[0]]] or own
    free = [b for b in own if b[1] not in template] or own
    if not any(page.tag[b[0]] == "h1" for b in free):  # a headline may stand before the element that holds the rest
        heads = [b for b in page.blocks if page.tag[b[0]] == "h1" and page.parent[b[0]] in chain and not inside[b[0]] and not out[b[0]] and b[1] not in template]
        free = [b for b in heads if b[0] < top] + free
    return " ".join(b[2] for b in free)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token of each host: pages, occurrences, XOR of the hashes of (page, count)."""
    for batch in batches:
        held: dict[tuple[str, int], list[int]] = {}
        elements: set[int] = set()
        for uid, host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = parse(html)
            counts: dict[int, int] = {}
            for t in page.token[1:]:
                counts[t] = 1
            elements.update(counts)
            for _, t, _, _ in page.blocks:
                counts[t] = counts.get(t, 0) + 1
            for t, n in counts.items():
                row = held.setdefault((host, t), [0, 0, 0])
                row[0] += 1
                row[1] += n
                row[2] ^= _hash(uid, n)
        hosts, found = zip(*held, strict=True) if held else ((), ())
        columns = list(zip(*held.values(), strict=True)) if held else [()] * 3
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(found, pa.int64()), *[pa.array(c, pa.int64()) for c in columns], pa.array([t in elements for _, t in held], pa.bool_())], names=["host", "token", "pages", "total", "vector", "element"])


def _per_host(batch: pa.RecordBatch, known: dict[str, dict], make) -> Iterator[tuple[str, str, dict]]:
    """Host, html and what ``make`` makes of the further columns, once for each host in turn."""
    host, html, *more = batch.columns
    for i, (h, x) in enumerate(zip(host.to_pylist(), html.to_pylist(), strict=True)):
        if h not in known:
            if len(known) > 1000:
                known.clear()
            known[h] = make([c[i].as_py() or () for c in more])
        yield h, x, known[h]


def observe(page: Page, classes: dict[int, int]) -> tuple[dict[int, list[float]], dict[int, list[float]]]:
    """Of one page, by token: its turn in its class (twice), weighed slots in it and in its parent, the same of all text, links, text; by class: the element around it (twice), fixed characters, slots in that element."""
    free = {b for b, (_, t, _, _) in enumerate(page.blocks) if t not in classes}
    slots, everything = _weighed(page, free), _weighed(page)
    text, links, loose = [0.0] * len(page.tag), [0.0] * len(page.tag), [0.0] * len(page.tag)
    for b, (e, _, got, of_links) in enumerate(page.blocks):
        text[e] += len(got)
        links[e] += of_links
        loose[e] += len(got) * (b in free)
    text, links, loose = page.within(text), page.within(links), page.within(loose)
    turns: dict[int, int] = {}
    by_token: dict[int, list[float]] = {}
    ends: dict[int, list[int]] = {}
    fixed: dict[int, float] = {}
    for x in page.order:
        e, t = (x, page.token[x]) if x >= 0 else page.blocks[-1 - x][:2]
        c = classes.get(t)
        if c is None:
            continue
        turn = turns[c] = turns.get(c, 0) + 1
        up = max(0, page.parent[e]) if x >= 0 else e
        by_token[t] = [turn, turn, slots[e], slots[up], everything[e], everything[up], links[e], text[e]] if x >= 0 else [turn, turn] + [0.0] * 6
        ends.setdefault(c, [up, up])[1] = up
        fixed[c] = fixed.get(c, 0.0) + (len(page.blocks[-1 - x][2]) if x < 0 else 0)
    by_class = {}
    for c, (a, b) in ends.items():  # the nearest holder around the first and the last token is around all of them
        while a != b:
            a, b = (page.parent[a], b) if a > b else (a, page.parent[b])
        while a and page.tag[a] not in HOLDERS:
            a = page.parent[a]
        by_class[c] = [page.token[a], page.token[a], fixed[c], loose[a]]
    return by_token, by_class


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, dict[int, int]] = {}
    names = ["host", "is_class", "key", "first", "last", "a", "b", "c", "d", "e", "f"]
    for batch in batches:
        tokens: dict[tuple[str, int], list[float]] = {}
        classes: dict[tuple[str, int], list[float]] = {}
        for host, html, of in _per_host(batch, known, lambda more: dict(zip(*more, strict=True))):
            if not of:
                continue
            by_token, by_class = observe(parse(html), of)
            for t, v in by_token.items():
                row = tokens.setdefault((host, t), [v[0], v[1], 0.0, 0.0, 0.0, 0.0, 0.0, 0.0])
                row[0], row[1] = min(row[0], v[0]), max(row[1], v[1])
                for i in range(2, 8):
                    row[i] += v[i]
            for c, v in by_class.items():
                row = classes.setdefault((host, c), [v[0], v[1], 0.0, 0.0])
                row[0], row[1] = min(row[0], v[0]), max(row[1], v[1])
                row[2] += v[2]
                row[3] += v[3]
        rows = [(h, False, t, *v) for (h, t), v in tokens.items()]
        rows += [(h, True, c, *v, 0.0, 0.0, 0.0, 0.0) for (h, c), v in classes.items()]
        kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), *[pa.float64()] * 6]
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _extract(p: Extraction):
    def make(more: list) -> dict[int, Entry]:
        return {r["token"]: (r["part"], r["links"]) for r in more[0]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, Entry]] = {}
        for batch in batches:
            out = [main_text(html, of, p) for _, html, of in _per_host(batch.select(batch.schema.names[1:]), known, make)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    return run


def _with_host(rows: DataFrame, by_host: DataFrame, tokens: str, p: Extraction, how: str) -> DataFrame:
    """Pages with what is known of their host; a join by host, in which hot hosts are split, beyond the bound of a broadcast."""
    total = by_host.agg(F.sum(F.size(tokens))).first()[0] or 0
    return rows.join(F.broadcast(by_host) if total <= p.broadcast else by_host, "host", how)


def deduce(rows: DataFrame, scratch: Scratch, params: Extraction | None = None) -> DataFrame:
    """Templates of ``rows`` (``uid``, ``host``, ``html``): ``host``, ``token``, ``pages``, ``part``, ``links``; fixed texts have no parts."""
    p = params or Extraction()
    seen = rows.select("uid", "host", "html").mapInArrow(_tokens, "host string, token long, pages long, total long, vector long, element boolean")
    tokens = seen.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.bit_xor("vector").alias("vector"), F.max("element").alias("element"))
    sizes = rows.groupBy("host").agg(F.count("*").alias("of")).where(F.col("of") >= p.pages)
    enough = (F.col("pages") >= p.pages) & (F.col("pages") >= p.share * F.col("of")) & (F.col("total") == F.col("pages"))
    often = tokens.where((F.col("pages") >= p.pages) & (F.col("total") == F.col("pages"))).join(sizes, "host").where(enough)
    often = scratch.write(often.select("host", "token", "pages", "of", "element", F.xxhash64("vector", "pages").alias("class")), "tokens")

    by_host = scratch.write(often.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("t")).select("host", F.col("t.token").alias("token"), F.col("t.class").alias("class")), "classes")
    kinds = "host string, is_class boolean, key long, first long, last long, a double, b double, c double, d double, e double, f double"
    noted = _with_host(rows.select("host", "html"), by_host, "token", p, "inner").mapInArrow(_observed, kinds)
    noted = scratch.write(noted.groupBy("host", "is_class", "key").agg(F.min("first").alias("first"), F.max("last").alias("last"), *[F.sum(c).alias(c) for c in "abcdef"]), "noted")

    ordered = often.join(noted.where("not is_class and first = last").withColumnRenamed("key", "token"), ["host", "token"])
    slots = noted.where("is_class and first = last").where(F.col("b") >= p.slots * F.col("a")).select("host", F.col("key").alias("class"), F.col("first").alias("around"))
    around = often.select("host", F.col("token").alias("around"), F.col("pages").alias("most"))
    large = ordered.groupBy("host", "class").agg(F.count("*").alias("n")).where("n > 1").select("host", "class")
    valid = ordered.join(large, ["host", "class"], "left_semi").join(slots, ["host", "class"]).join(around, ["host", "around"], "left")
    valid = valid.where(F.col("element") | (F.col("pages") >= p.usual * F.coalesce("most", "of")))
    part = lambda x, y: F.when(F.col(y) > 0, F.col(x) / F.col(y)).otherwise(0.0)
    # where an element's parent has hardly any slots (a host of copies), all its text counts
    share = F.when(F.col("b") >= p.slots * F.col("d"), part("a", "b")).otherwise(part("c", "d"))
    return valid.select("host", "token", "pages", share.alias("part"), part("e", "f").alias("links"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", params: Extraction | None = None) -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` (its code points) of every page.

    Null or empty html gives an empty text.  Pages without a url, or with one that
    names no host, share the host ''.  On a host with fewer than ``pages`` pages, and
    in layouts that fewer than that or ``share`` of a host's pages have, the page's
    own text, tags and names decide.  Repeated rows count as pages of their own and
    get equal texts; cut-off markup at the end is dropped.  Other columns are
    ignored, whatever their names.
    """
    p = params or Extraction()
    scratch = Scratch(pages.sparkSession, "html")
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), F.struct(F.col(id_col).alias("id"), F.col(url_col).alias("url")).alias("row"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = deduce(rows, scratch, p)
    template = scratch.write(found.groupBy("host").agg(F.collect_list(F.struct("token", "part", "links")).alias("template")), "template")
    texts = _with_host(rows, template, "template", p, "left").select("row", "host", "html", "template").mapInArrow(_extract(p), rows.select("row", F.lit("").alias("text")).schema)
    return texts.select(F.col("row.id").alias(id_col), F.col("row.url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_template_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
