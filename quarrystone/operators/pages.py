"""Stored pages: extraction with small per-row helpers on the standard library's HTML parser, in batches of mapInPandas."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

from quarrystone.operators.tree import Node, parsed

SKIPPED = {"script", "style", "noscript", "template"}
LAYOUT = {"nav", "header", "footer", "aside", "form"}
BLOCKS = {"p", "div", "li", "br", "tr", "h1", "h2", "h3", "h4", "section", "article", "td", "dt", "dd"}
HEADINGS = {"h1", "h2", "h3"}
BUSINESS_TYPES = {"Organization", "LocalBusiness", "Corporation", "Store", "ProfessionalService"}
VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}


class Page(HTMLParser):
    """What a page shows: text, title, metas, links, headings, JSON-LD blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.text, self.main, self.links, self.heads, self.jsonld, self.meta = [], [], [], [], [], {}
        self.title = ""
        self._open: list[str] = []
        self._head: list[str] | None = None
        self._link: list | None = None
        self._ld: list[str] | None = None
        self.feed(html or "")
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.setdefault((a.get("property") or a.get("name") or "").lower(), a.get("content", ""))
        if tag in BLOCKS:
            self.text.append("\n")
            self.main.append("\n")
        if tag in VOID:
            return
        self._open.append(tag)
        if tag == "a" and "href" in a:
            self._link = [a["href"], []]
        if tag in HEADINGS:
            self._head = []
        if tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self._ld = []

    def handle_endtag(self, tag: str) -> None:
        if tag in self._open:
            while self._open and self._open.pop() != tag:
                pass
        if tag == "a" and self._link:
            self.links.append((self._link[0], squeezed(self._link[1])))
            self._link = None
        if tag in HEADINGS and self._head is not None:
            self.heads.append((tag, squeezed(self._head)))
            self._head = None
        if tag == "script" and self._ld is not None:
            self.jsonld.append("".join(self._ld))
            self._ld = None

    def handle_data(self, data: str) -> None:
        if self._ld is not None:
            self._ld.append(data)
        if SKIPPED.intersection(self._open):
            return
        if "title" in self._open:
            self.title += data
            return
        self.text.append(data)
        if not LAYOUT.intersection(self._open):
            self.main.append(data)
        for part in (self._head, self._link[1] if self._link else None):
            if part is not None:
                part.append(data)


def squeezed(parts: list[str] | str) -> str:
    return re.sub(r"\s+", " ", "".join(parts)).strip()


def _distinct(values: list) -> list:
    return list(dict.fromkeys(values))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _page(html: str, url: str) -> dict:
    page = Page(html)
    own = _host(url).removeprefix("www.")
    links = _distinct([x for x in (_joined(url, h) for h, _ in page.links) if x.startswith("http")])
    same = lambda x: bool(own) and (_host(x).removeprefix("www.") == own or _host(x).endswith("." + own))
    worded = lambda pattern: [x for x in links if same(x) and re.search(pattern, urlsplit(x).path.lower())]
    return {
        "text": squeezed(page.text), "title": squeezed(page.meta.get("og:title") or page.title), "description": page.meta.get("description", ""), "generator": page.meta.get("generator", ""),
        "jsonld": page.jsonld, "h1": _distinct([t for h, t in page.heads if h == "h1" and 0 < len(t) < 200])[:5], "internal": [x for x in links if same(x)], "external": [x for x in links if not same(x)],
        "contact": worded("contat|contact|chi-siam"), "privacy": worded("privacy|cookie|legal"),
        "emails": _distinct(re.findall(r"[a-zA-Z0-9._-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,6}", html)), "vats": _distinct([v for v in re.findall(r"\b[0-9]{11}\b", html) if _luhn(v)]),
    }


def _joined(base: str, href: str) -> str:
    try:
        return urljoin(base or "", href)
    except ValueError:
        return ""


def _host(url: str) -> str:
    try:
        return urlsplit(url).hostname or ""
    except ValueError:
        return ""


def extract_page(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, title, description, generator, jsonld, h1, internal, external, contact, privacy, emails, vats):
    links are resolved against the page's url; contact and privacy links are internal ones; VAT numbers pass their check."""
    lists = ["jsonld", "h1", "internal", "external", "contact", "privacy", "emails", "vats"]
    schema = "page_id long, url string, text string, title string, description string, generator string, " + ", ".join(f"{x} array<string>" for x in lists)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"page_id": p, "url": u} | _page(h or "", u or "") for p, u, h in zip(b["page_id"], b["url"], b["html"], strict=True)]
            yield pd.DataFrame(rows, columns=["page_id", "url", "text", "title", "description", "generator", *lists])

    return pages.select("page_id", "url", "html").mapInPandas(run, schema)


def html_to_text(pages: DataFrame, most: int = 30_000) -> DataFrame:
    """(page_id, text): text without tags, cut at ``most`` characters with a mark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [squeezed(Page(h or "").text) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "text": [t if len(t) <= most else t[:most] + " [truncated]" for t in texts]})

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, text string")


def clean_html(pages: DataFrame, most: int = 8_000) -> DataFrame:
    """(page_id, text): title, description, headings, contact lines, body without layout, and one business JSON-LD node."""

    def one(html: str) -> str:
        page = Page(html)
        body = squeezed(page.main)
        contact = _distinct([x for x in map(str.strip, "".join(page.text).split("\n")) if re.search(r"@|p\.?\s?iva|tel|via ", x, re.I)])[:20]
        business = next((n for n in _nodes(page.jsonld) if BUSINESS_TYPES.intersection(_types(n))), None)
        parts = [("TITLE", squeezed(page.title)), ("META", page.meta.get("description", "")), ("HEADINGS", " | ".join(t for _, t in page.heads)), ("CONTACT", " | ".join(contact)), ("BODY", body), ("JSONLD", json.dumps(business, ensure_ascii=False) if business else "")]
        return "\n".join(f"{k}: {v}" for k, v in parts if v)[:most]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"page_id": b["page_id"], "text": [one(h or "") for h in b["html"]]})

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, text string")


def _nodes(blocks: list[str]) -> list[dict]:
    """All objects of JSON-LD blocks at any depth, outer ones first; what is no JSON is skipped."""
    out, queue = [], []
    for block in blocks:
        try:
            queue.append(json.loads(block))
        except ValueError:
            continue
    while queue:
        node = queue.pop(0)
        if isinstance(node, dict):
            out.append(node)
            queue.extend(node.values())
        elif isinstance(node, list):
            queue.extend(node)
    return out


def _types(node: dict) -> set[str]:
    kind = node.get("@type", [])
    return {kind} if isinstance(kind, str) else {x for x in kind if isinstance(x, str)}


def jsonld_walk(df: DataFrame, keys: list[str], key: str = "page_id", blocks: str = "jsonld") -> DataFrame:
    """(key, one column per name): the first plain value of each name at any depth, names without case."""

    def first(nodes: list[dict], name: str) -> str | None:
        for node in nodes:
            for k, v in node.items():
                if k.lower() == name.lower() and isinstance(v, str | int | float):
                    return str(v)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [_nodes(list(x) if x is not None else []) for x in b[blocks]]
            yield pd.DataFrame({key: b[key]} | {k: [first(n, k) for n in found] for k in keys})

    return df.select(key, blocks).mapInPandas(run, f"{key} long, " + ", ".join(f"{k} string" for k in keys))


def schema_org_signals(df: DataFrame) -> DataFrame:
    """(page_id, is_business, url_match, phone_match, vat_match) from columns page_id, jsonld, website, phone, vat."""
    digits = lambda x: re.sub(r"\D", "", str(x or ""))

    def one(blocks: list[str], website: str, phone: str, vat: str) -> tuple[bool, bool, bool, bool]:
        nodes = [n for n in _nodes(blocks) if BUSINESS_TYPES.intersection(_types(n))]
        urls = {_host(str(n.get("url", ""))).removeprefix("www.") for n in nodes} - {""}
        phones = {digits(n.get("telephone"))[-8:] for n in nodes} - {""}
        vats = {digits(n.get(k)) for n in nodes for k in ("vatID", "taxID", "identifier") if isinstance(n.get(k), str | int)} - {""}
        return bool(nodes), _host(website or "").removeprefix("www.") in urls, bool(digits(phone)) and digits(phone)[-8:] in phones, bool(digits(vat)) and digits(vat) in vats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [one(list(j) if j is not None else [], w, p, v) for j, w, p, v in zip(b["jsonld"], b["website"], b["phone"], b["vat"], strict=True)]
            yield pd.DataFrame([(k, *r) for k, r in zip(b["page_id"], rows, strict=True)], columns=["page_id", "is_business", "url_match", "phone_match", "vat_match"])

    return df.select("page_id", "jsonld", "website", "phone", "vat").mapInPandas(run, "page_id long, is_business boolean, url_match boolean, phone_match boolean, vat_match boolean")


# Classes of the blocks or links that hold one result each, by engine.
RESULT_BLOCKS = {"google": ["yuRUbf", "kCrYT"], "bing": ["b_algo", "b_header"], "duckduckgo": ["result__a"]}
# Parameters in which an engine's redirect names its target.
TARGETS = ["q", "uddg", "url"]


def _target(href: str) -> str:
    """What a link of a result page leads to, redirects resolved."""
    try:
        named = parse_qs(urlsplit(href).query)
    except ValueError:
        return href
    return next((named[n][0] for n in TARGETS if named.get(n, [""])[0].startswith("http")), href)


def _results(root: Node) -> tuple[str, list[Node]]:
    """The engine whose blocks the page has, and the link of each; else all links."""
    nodes = list(root.walk())
    for engine, classes in RESULT_BLOCKS.items():
        blocks = [n for n in nodes if not set(classes).isdisjoint(n.classes())]
        links = [x for n in blocks for x in [next((y for y in n.walk() if y.tag == "a" and "href" in y.attrs), n.up("a"))] if x is not None and "href" in x.attrs]
        if links:
            return engine, links
    return "", [n for n in nodes if n.tag == "a" and "href" in n.attrs]


def serp_rows(pages: DataFrame, own: list[str], most: int = 10) -> DataFrame:
    """(page_id, place, url, title, engine) of stored result pages, by the blocks of the engine that made them: the link of each
    block, redirects resolved and taken from the page's url, to a site that is not in ``own`` nor below it; the title is
    the link's heading, else its text. Pages without such blocks (engine '') give all their links. Distinct, the first ``most``."""
    listed = lambda host: any(host == o or host.endswith("." + o) for o in own)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, base, html in zip(b["page_id"], b["url"], b["html"], strict=True):
                seen: dict[str, str] = {}
                engine, links = _results(parsed(html or ""))
                for link in links:
                    url = _target(_joined(base or "", link.attrs["href"]))
                    title = next((t for n in link.walk() if n.tag == "h3" and (t := n.text())), link.text())
                    if url.startswith("http") and title and not listed(_host(url)):
                        seen.setdefault(url, title)
                rows += [(page_id, i + 1, u, t, engine) for i, (u, t) in enumerate(list(seen.items())[:most])]
            yield pd.DataFrame(rows, columns=["page_id", "place", "url", "title", "engine"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, place int, url string, title string, engine string")


# Labels of a company's profile.
PROFILE_LABELS = {
    "legal_name": "Ragione sociale", "vat": "Partita IVA", "fiscal_code": "Codice Fiscale", "rea": "REA", "legal_form": "Forma giuridica", "founded": "Anno Fondazione", "status": "Stato Attività", "address": "Indirizzo", "city": "Città",
    "province": "Provincia", "region": "Regione", "revenue": "Fatturato", "employees": "Dipendenti", "profit": "Utile", "personnel_cost": "Costo del personale", "activity": "Attività prevalente",
}
ADDRESS = re.compile(r"(?P<street>[^,\n|]*(?:,\s*[0-9]+[a-zA-Z/]*)?)[\s,-]*\b(?P<zip>[0-9]{5})\b[\s,-]*(?P<city>[^()\n|]*?)\s*\((?P<province>[A-Z]{2})\)")


def _address(lines: str) -> tuple[str | None, str | None, str | None, str | None]:
    """Street, zip, city and province of the first line with a postal code and a province in brackets."""
    for line in lines.split("\n"):
        if m := ADDRESS.search(squeezed(line)):
            return tuple(m[k].strip(" ,-") or None for k in ("street", "zip", "city", "province"))
    return None, None, None, None


def _record(heading: Node, headings: set[int]) -> list[Node | str]:
    """What belongs to a heading: what stands behind it, within the largest element around it that has no other heading, and if
    others stand beside that one, what comes before the next."""
    own, at = [], heading
    while at.parent is not None:
        beside = at.parent.children
        behind = beside[next(i for i, x in enumerate(beside) if x is at) + 1 :]
        for node in behind:
            if isinstance(node, Node) and any(id(n) in headings for n in node.walk()):
                return own
            own.append(node)
        if any(id(n) in headings and n is not heading for n in at.parent.walk()):
            return own
        at = at.parent
    return own


def listing_rows(pages: DataFrame, levels: str = "23") -> DataFrame:
    """(page_id, place, name, phone, website, street, zip, city, province): a row for each heading (of these ``levels``) of a
    stored listing, with what belongs to it by the tree of the page."""
    names = ["page_id", "place", "name", "phone", "website", "street", "zip", "city", "province"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, html in zip(b["page_id"], b["html"], strict=True):
                found = [n for n in parsed(html or "").walk() if n.tag in {"h" + x for x in levels}]
                ids = set(map(id, found))
                for i, heading in enumerate(found):
                    record = _record(heading, ids)
                    lines = "".join(x if isinstance(x, str) else x.lines() for x in record)
                    phone = re.search(r"(?<!\d)(?:\+39|0)[\d ./-]{6,}", squeezed(lines))
                    links = (n.attrs["href"] for x in record if isinstance(x, Node) for n in x.walk() if n.tag == "a" and n.attrs.get("href", "").startswith("http"))
                    rows.append((page_id, i + 1, heading.text(), re.sub(r"[^\d+]", "", phone[0]) if phone else None, next(links, None), *_address(lines)))
            yield pd.DataFrame(rows, columns=names)

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, place int, " + ", ".join(f"{n} string" for n in names[2:]))


def _column(cell: Node) -> Node | None:
    """The cell below a header cell, in the next row of its table."""
    row = cell.up("tr")
    place = next((i for i, x in enumerate(row.elements()) if x is cell), None) if row is not None else None
    below = next((r for r in row.after() if r.tag == "tr"), None) if row is not None else None
    if below is None and row is not None and row.parent is not None and row.parent.tag == "thead":
        below = next((r for part in row.parent.after() for r in part.walk() if r.tag == "tr"), None)
    return below.elements()[place] if below is not None and place is not None and place < len(below.elements()) else None


def _value(label: Node, name: str) -> str | None:
    """The value beside a label's element: the rest of its own text, the element behind it, the cell below a header cell, the next cell
    of the row, or the rest of the text around it, whichever comes first."""
    rest = lambda text: text[text.lower().find(name.lower()) + len(name) :].strip(" :\t-\n") if name.lower() in text.lower() else ""
    if own := rest(label.text()):
        return own
    cell = label.up("td", "th")
    header = cell is not None and cell.tag == "th" and all(x.tag == "th" for x in cell.parent.elements())
    if header and (below := _column(cell)) is not None:
        return below.text() or None
    behind = next((t for x in label.after() if (t := x.text())), None)
    if behind:
        return behind
    if cell is not None and (t := next((t for x in cell.after() if (t := x.text())), None)):
        return t
    around = rest(label.parent.text()) if label.parent is not None and label.parent.parent is not None else ""
    return around or None


def labelled_fields(pages: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(page_id, one column per label): the value beside a label, by the tree of the page. Of elements that hold the label's words (in
    any case) the innermost ones whose text begins with them count, else the innermost; of several the first with a value."""

    def fields(html: str) -> list[str | None]:
        spoken = lambda n: any(isinstance(c, str) and c.strip() for c in n.children)
        texts = [(n, n.text()) for n in parsed(html).walk() if n.tag not in SKIPPED and n.parent is not None and spoken(n)]
        out = []
        for name in labels.values():
            word = re.compile(rf"(?<!\w){re.escape(name)}(?!\w)", re.I)
            holds = [(n, t) for n, t in texts if word.search(t)]
            outer: set[int] = set()
            for n, _ in holds:
                while (n := n.parent) is not None and id(n) not in outer:
                    outer.add(id(n))
            inner = sorted(((n, t) for n, t in holds if id(n) not in outer), key=lambda x: not x[1].lower().startswith(name.lower()))
            out.append(next((v for n, _ in inner if (v := _value(n, name))), None))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [fields(h or "") for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"]} | {k: [f[i] for f in found] for i, k in enumerate(labels)})

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, " + ", ".join(f"{k} string" for k in labels))
