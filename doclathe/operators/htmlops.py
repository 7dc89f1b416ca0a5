"""HTML structure: clean text, blocks under headings, links, tables. One parse per page, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators import chunking as C
from doclathe.operators import jsonops as J
from doclathe.runtime import spread

# Element names of HTML, and marks of elements around the content.
DROPPED = frozenset("script style noscript header footer nav aside form svg meta link title".split())
BLOCKS = frozenset("p div section article main h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre br hr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("script style noscript header footer nav aside".split())
NOISE = ("nav", "menu", "footer", "header", "cookie", "banner")
JUMPS = ("Go to navigation", "Go to main content", "Go to footer", "Go to sidebar", "Go to search")
EMITTED = frozenset("h1 h2 h3 h4 p li div section blockquote".split())

_jumps = re.compile("|".join(JUMPS))
_tags = re.compile(r"<[^>]+>")
_rules = re.compile(r"(?m)^[\s\-–—_=~*#|─-▟]+$")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, between: str = "") -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in ("script", "style"):
                stack += reversed(x.children)
        return between.join(out)


class _Tree(HTMLParser):
    """A forgiving tree: unclosed paragraphs and list items end where the next begins, unknown end tags are ignored, comments and doctypes are no text."""

    _ends = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if self.open[-1].tag in self._ends.get(tag, ()):
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def is_noise(node: Node, tags: frozenset[str] = DROPPED, marks: tuple[str, ...] = NOISE) -> bool:
    named = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()
    return node.tag in tags or any(m in named for m in marks)


def clean(html: str) -> str:
    """The text of a page without the elements around its content, a blank line between blocks."""
    out: list[str] = []
    stack: list[Node | str] = [parse(html)]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(re.sub(r"[\r\n\t ]+", " ", x) if x != "\n\n" else x)
        elif not is_noise(x):
            edge = ["\n\n"] if x.tag in BLOCKS else []
            stack += [*edge, *reversed(x.children), *edge]
    text = _rules.sub("", _tags.sub("", _jumps.sub("", "".join(out))))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def blocks(html: str, least: int = 15) -> list[dict]:
    """Blocks in document order under their nearest heading: (heading, heading_level, text). What an emitted element holds isn't emitted again; short
    texts are dropped; an element that wraps headings is opened instead of swallowed."""
    out: list[dict] = []
    heading, level = None, 0
    stack: list[Node] = [parse(html)]
    while stack:
        node = stack.pop()
        if is_noise(node, CHROME):
            continue
        if node.tag in EMITTED:
            inner = [n for n in node.walk() if n is not node and n.tag in EMITTED]
            text = " ".join(node.text(" ").split())
            if node.tag[0] == "h" and node.tag[1:].isdigit():
                heading, level = text or heading, int(node.tag[1:])
                continue
            if not inner:
                if len(text) >= least:
                    out.append({"heading": heading, "heading_level": level, "text": text})
                continue
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def links(html: str, base: str) -> list[str]:
    """Targets of a[href], made absolute, in order, repeats kept."""
    return [urljoin(base, n.attrs["href"]) for n in parse(html).walk() if n.tag == "a" and "href" in n.attrs]


def table_text(node: Node) -> str:
    """A table as lines of cells between bars, a rule after leading header rows, rows padded to the widest."""
    rows = [[c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in node.walk() if r.tag == "tr"]
    rows = [r for r in rows if r]
    width = max(map(len, rows), default=0)
    out, head = [], True
    for r in rows:
        if head and out and not all(c.tag == "th" for c in r) and all(c.tag == "th" for c in rows[len(out) - 1]):
            out.append("| " + " | ".join(["---"] * width) + " |")
            head = False
        cells = [" ".join(c.text(" ").split()) for c in r] + [""] * (width - len(r))
        out.append("| " + " | ".join(cells) + " |")
    return "\n".join(out)


def tables(html: str) -> list[str]:
    return [table_text(n) for n in parse(html).walk() if n.tag == "table"]


def _matches(node: Node, selector: str) -> bool:
    """A simple selector: tag, #id, .class, or tag with one of these."""
    tag, mark, name = re.fullmatch(r"([a-z0-9]*)([#.]?)([\w-]*)", selector).groups()
    if tag and node.tag != tag:
        return False
    if mark == "#":
        return node.attrs.get("id") == name
    return not mark or name in node.attrs.get("class", "").split()


def content_node(root: Node, selectors: tuple[str, ...]) -> Node:
    """The first node of the first selector that any node matches, else the root."""
    for selector in selectors:
        found = next((n for n in root.walk() if _matches(n, selector)), None)
        if found is not None:
            return found
    return root


# Where the content of a page usually stands, in the order it is looked for.
CONTENT = ("main", "article", "#content", "#main-content", ".content", "div.field--name-body", "body")


def content_text(html: str, selectors: tuple[str, ...] = CONTENT) -> str:
    """The text of the content node, strings stripped, a blank line between blocks; noise elements dropped; two-cell rows with a number as `num  text`."""
    out: list[str] = []
    stack: list[Node | str] = [content_node(parse(html), selectors)]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(" ".join(x.split()) and " " + " ".join(x.split()) if x != "\n\n" else x)
        elif not is_noise(x):
            cells = [c for c in x.children if isinstance(c, Node) and c.tag == "td"] if x.tag == "tr" else []
            if len(cells) == 2:
                num, body = (" ".join(c.text(" ").split()) for c in cells)
                out += ["\n\n", f"{num}  {body}", "\n\n"]
                continue
            edge = ["\n\n"] if x.tag in BLOCKS else []
            stack += [*edge, *reversed(x.children), *edge]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(line.strip() for line in "".join(out).split("\n"))).strip()


def heading_sections(html: str, least: int = 20, most: int = 2000) -> list[dict]:
    """(heading, body) for h1 to h3: the texts of more than `least` characters up to the next heading, joined and cut at `most`; without headings the whole page."""
    found: list[dict] = []
    for b in blocks(html, least + 1):
        if b["heading"] is None or b["heading_level"] > 3:
            continue
        if not found or found[-1]["heading"] != b["heading"]:
            found.append({"heading": b["heading"], "body": b["text"]})
        else:
            found[-1]["body"] += "\n" + b["text"]
    whole = clean(html)
    found = found or ([{"heading": None, "body": whole}] if whole else [])
    return [{"heading": f["heading"], "body": f["body"][:most]} for f in found]


_date = re.compile(r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}[./]\d{1,2}[./]\d{4}\b")


def metadata(html: str) -> dict:
    """(title, published): og:title, else the first h1, else title; a date in the usual meta elements or a time element, else the first date in the text."""
    root = parse(html)
    meta = {n.attrs.get("property") or n.attrs.get("name"): n.attrs.get("content", "") for n in root.walk() if n.tag == "meta"}
    text = lambda tag: next((t for n in root.walk() if n.tag == tag and (t := " ".join(n.text(" ").split()))), None)
    time = next((n.attrs["datetime"] for n in root.walk() if n.tag == "time" and n.attrs.get("datetime")), None)
    seen = _date.search(root.text(" "))
    return {"title": meta.get("og:title") or text("h1") or text("title"), "published": meta.get("article:published_time") or meta.get("date") or time or (seen.group() if seen else None)}


def related_links(html: str, base: str) -> list[str]:
    """Links below the page's own path on its host, without fragment and query, distinct and sorted; the page itself is none."""
    own = urlsplit(base)
    prefix = own.path.rstrip("/") + "/"
    out = set()
    for link in links(html, base):
        u = urlsplit(link)
        if u.netloc == own.netloc and u.path.startswith(prefix) and u.path.rstrip("/") != own.path.rstrip("/"):
            out.add(f"{u.scheme}://{u.netloc}{u.path}")
    return sorted(out)


def accordion(html: str, item: str = "li.accordion-box", title: str = ".accordion-title", content: str = ".accordion-content") -> list[dict]:
    """(heading, body) of the boxes of a page that unfold; boxes without content are left out."""
    out = []
    for box in (n for n in parse(html).walk() if _matches(n, item)):
        part = lambda selector: next((n for n in box.walk() if n is not box and _matches(n, selector)), None)  # noqa: B023, E731
        head, body = part(title), part(content)
        text = " ".join(body.text(" ").split()) if body else ""
        if text:
            out.append({"heading": " ".join(head.text(" ").split()) if head else "", "body": text})
    return out


def section_walk(html: str, least: int = 15, doubled: bool = False) -> list[dict]:
    """(heading, body) of the parts between headings in document order: the texts of more than `least` characters of leaf paragraphs, items and captions,
    and texts that stand in none of these; tables as lines between bars. With doubled, texts inside such a leaf are given out before it as well."""
    leaves = frozenset({"p", "li", "dd", "figcaption"})
    out: list[dict] = []
    heading, body = "", []

    def flush() -> None:
        if joined := " ".join(body).strip():
            out.append({"heading": heading, "body": joined})

    stack: list[tuple[Node | str, bool]] = [(parse(html), False)]
    while stack:
        x, inside = stack.pop()
        if isinstance(x, str):
            if len(x.strip()) > least and (doubled or not inside):
                body.append(x.strip())
        elif x.tag in ("script", "style"):
            continue
        elif x.tag == "table":
            if len(text := table_text(x).strip()) > least:
                body.append(text)
        elif x.tag[:1] == "h" and x.tag[1:] in set("123456"):
            if text := " ".join(x.text(" ").split()):
                flush()
                heading, body = text, []
        else:
            leaf = x.tag in leaves and not any(isinstance(c, Node) and c.tag in ("p", "li") for c in x.children)
            if leaf and len(text := " ".join(x.text(" ").split())) > least:
                body.append(text)
            stack += [(c, inside or leaf) for c in reversed(x.children)]
    flush()
    return out


def teaser_links(html: str, base: str, classes: tuple[str, ...] = ("teaser",), host: str = "") -> list[str]:
    """Targets of anchors with all the classes, absolute, whose host ends with `host`; distinct, in order; jumps within the page are left out."""
    found = []
    for n in parse(html).walk():
        href = n.attrs.get("href", "").strip()
        if n.tag == "a" and href and not href.startswith("#") and set(classes) <= set(n.attrs.get("class", "").split()):
            link = urljoin(base, href)
            if urlsplit(link).netloc.endswith(host):
                found.append(link)
    return list(dict.fromkeys(found))


def celex_of(url: str) -> str:
    query = parse_qs(urlsplit(url).query)
    values = (query.get(k, [""])[0] for k in ("uri", "from"))
    return next((v.split(":", 1)[1] for v in values if v.upper().startswith("CELEX:")), "")


def same_document_links(html: str, base: str, path: str = "/legal-content/EN/") -> list[str]:
    """Links of the page's host below a path that name the page's own legal document, without fragment; distinct and sorted, the page itself left out."""
    own, name = urlsplit(base), celex_of(base)
    out = set()
    for link in links(html, base):
        u = urlsplit(link)
        if u.netloc == own.netloc and u.path.startswith(path) and (not name or celex_of(link) == name):
            out.add(u._replace(fragment="").geturl())
    return sorted(out - {base})


def legal_metadata(html: str) -> dict:
    """(title, published, reference) of a page of an official journal: the first two title lines, the header's date and reference, with the usual fallbacks."""
    root = parse(html)
    texts = lambda selector: [t for n in root.walk() if _matches(n, selector) and (t := " ".join(n.text(" ").split()))]
    usual = metadata(html)
    return {"title": " — ".join(texts(".oj-doc-ti")[:2]) or (usual["title"] or ""), "published": next(iter(texts(".oj-hd-date")), usual["published"] or ""), "reference": next(iter(texts(".oj-hd-oj")), "")}


def plain_text(html: str) -> str:
    """All strings of a fragment, stripped, a line each."""
    out: list[str] = []
    stack: list[Node | str] = [parse(html)]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out += [x.strip()] if x.strip() else []
        elif x.tag not in ("script", "style"):
            stack += reversed(x.children)
    return "\n".join(out)


def _mapped(df: DataFrame, key: str, html: str, others: list[str], kind: str, arrow: pa.DataType, f: Callable) -> DataFrame:
    """(key, out, problem): f of each page's html and other columns; null html gives null. One unreadable page doesn't end the job: it gives null, and its
    problem names the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, problems = [], []
            for row in zip(*(batch.column(i).to_pylist() for i in range(1, batch.num_columns))):
                try:
                    out.append(None if row[0] is None else f(*row))
                    problems.append(None)
                except (AssertionError, ValueError, RecursionError) as e:
                    out.append(None)
                    problems.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow), pa.array(problems, pa.string())], names=[key, "out", "problem"])

    return spread(df.select(key, F.col(html), *others)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, out {kind}, problem string")


_SECTIONS = pa.list_(pa.struct([("heading", pa.string()), ("body", pa.string())]))


def page_sections_by(df: DataFrame, key: str, how: Callable[[str], list[dict]], html: str = "html") -> DataFrame:
    """(key, pos, heading, body) by accordion, section_walk or another function of a page."""
    found = _mapped(df, key, html, [], "array<struct<heading:string,body:string>>", _SECTIONS, how)
    return found.select(key, F.posexplode("out").alias("pos", "s")).select(key, "pos", "s.*")


def page_links_by(df: DataFrame, key: str, how: Callable[[str, str], list[str]], html: str = "html", base: str = "url") -> DataFrame:
    """(key, pos, link) by teaser_links, same_document_links, related_links or another function of a page and its URL."""
    return _mapped(df, key, html, [base], "array<string>", pa.list_(pa.string()), lambda h, b: how(h, b or "")).select(key, F.posexplode("out").alias("pos", "link"))


def page_legal_metadata(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, title, published, reference)."""
    item = pa.struct([("title", pa.string()), ("published", pa.string()), ("reference", pa.string())])
    return _mapped(df, key, html, [], "struct<title:string,published:string,reference:string>", item, legal_metadata).select(key, "out.*")


def page_plain(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, text): the strings of a fragment; null and '' give ''."""
    return _mapped(df, key, html, [], "string", pa.string(), plain_text).select(key, F.coalesce("out", F.lit("")).alias("text"))


def page_problems(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, problem) of the pages that can't be read."""
    return _mapped(df, key, html, [], "string", pa.string(), clean).where("problem is not null").select(key, "problem")


def clean_records(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, text): escapes decoded, JSON unwrapped, the blocks of what is left as HTML, the first of equal blocks kept, headings given out where they
    change. Keys must be unique; a row without blocks gives ''."""
    rows = spread(df.select(key, text)).select(key, J.unwrap(T.decode_text(F.col(text))).alias("html"))
    found = C.dedupe_blocks(page_blocks(rows, key), [key], "pos")
    marked = found.withColumn("heading", F.concat(F.repeat(F.lit("#"), F.col("heading_level")), F.lit(" "), "heading"))
    flat = C.flatten_blocks(marked, [key], "pos")
    return rows.select(key).join(flat, key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"))


def clean_pages(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    return _mapped(df, key, html, [], "string", pa.string(), clean).select(key, F.col("out").alias("text"))


def page_blocks(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, heading, heading_level, text)."""
    item = pa.struct([("heading", pa.string()), ("heading_level", pa.int32()), ("text", pa.string())])
    found = _mapped(df, key, html, [], "array<struct<heading:string,heading_level:int,text:string>>", pa.list_(item), blocks)
    return found.select(key, F.posexplode("out").alias("pos", "b")).select(key, "pos", "b.*")


def page_links(df: DataFrame, key: str, html: str = "html", base: str = "url") -> DataFrame:
    """(key, pos, link)."""
    found = _mapped(df, key, html, [base], "array<string>", pa.list_(pa.string()), lambda h, b: links(h, b or ""))
    return found.select(key, F.posexplode("out").alias("pos", "link"))


def page_tables(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, text)."""
    return _mapped(df, key, html, [], "array<string>", pa.list_(pa.string()), tables).select(key, F.posexplode("out").alias("pos", "text"))


def page_content(df: DataFrame, key: str, html: str = "html", selectors: tuple[str, ...] = CONTENT) -> DataFrame:
    """(key, text, title, published)."""
    item = pa.struct([("text", pa.string()), ("title", pa.string()), ("published", pa.string())])
    found = _mapped(df, key, html, [], "struct<text:string,title:string,published:string>", item, lambda h: {"text": content_text(h, selectors), **metadata(h)})
    return found.select(key, "out.*")


def page_heading_sections(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, heading, body)."""
    item = pa.struct([("heading", pa.string()), ("body", pa.string())])
    return _mapped(df, key, html, [], "array<struct<heading:string,body:string>>", pa.list_(item), heading_sections).select(key, F.posexplode("out").alias("pos", "s")).select(key, "pos", "s.*")


def page_related(df: DataFrame, key: str, html: str = "html", base: str = "url") -> DataFrame:
    """(key, link)."""
    return _mapped(df, key, html, [base], "array<string>", pa.list_(pa.string()), lambda h, b: related_links(h, b or "")).select(key, F.explode("out").alias("link"))
