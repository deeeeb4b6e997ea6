"""Pages to records: names, texts, specifications and image addresses."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DETAIL = "name string, manufacturer_name string, intro string, detail string, specs array<struct<label:string,raw:string>>, hero_images array<string>"


class Node:
    """An element with its children; texts are str children."""

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """Elements below this one in the order of the page, however deep they are."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def first(self, tag: str) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag), None)

    def texts(self):
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if not isinstance(c, Node):
                    if c.strip():
                        yield c.strip()
                elif c.tag not in ("script", "style"):
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def text(self, between: str = " ") -> str:
        return between.join(self.texts())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open = Counter()  # tags of the elements that are open now

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def _close(self) -> str:
        tag = self.at.tag
        self.open[tag] -= 1
        self.at = self.at.parent
        return tag

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self._close() != tag:
                pass

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """A tree of any markup; elements that are never closed end with what holds them."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def meta(root: Node, name: str) -> str | None:
    found = next((n.attrs.get("content", "").strip() for n in root.all("meta") if n.attrs.get("property") == name), "")
    return found or None


def intro_and_detail(root: Node, ignored: tuple[str, ...] = ()) -> tuple[str | None, str | None]:
    """A longer fourth-level heading and the first paragraph beside it; else the first two longer paragraphs without phrases of the site itself."""
    for h in root.all("h4"):
        p = h.parent.first("p") if len(h.text()) >= 20 and h.parent else None
        if p is not None:
            return h.text(), p.text() or None
    long = [t for p in (root.first("main") or root).all("p") if len(t := p.text()) > 20 and not any(x in t for x in ignored)]
    return (long + [None, None])[0], (long + [None, None])[1]


def specifications(root: Node) -> list[dict]:
    """The first two cells of table rows; without any, terms with their definitions."""
    pairs = [(c[0].text(), c[1].text()) for t in root.all("table") for r in t.all("tr") if len(c := r.all("th", "td")) >= 2]
    pairs = [p for p in pairs if all(p)]
    if not pairs:
        pairs = [p for d in root.all("dl") for p in ((a.text(), b.text()) for a, b in zip(d.all("dt"), d.all("dd"), strict=False)) if all(p)]
    return [{"label": a, "raw": b} for a, b in pairs]


def looks_like_image(url: str) -> bool:
    return bool(re.search(r"\.(jpg|jpeg|png|webp)$|image", url, re.IGNORECASE))


def hero_images(root: Node, html: str, car_id: str | None, thumbs: str) -> list[str]:
    """Addresses of images of the car, thumbnails left out, each once; those of tags, then of the page's text, else the page's own."""
    found = [s for n in root.all("img") if looks_like_image(s := n.attrs.get("src", "")) and (not car_id or (car_id in s and thumbs not in s))]
    if car_id:
        found += re.findall(rf"""/[^"'\s]*/{re.escape(car_id)}_[^"'\s]+\.(?:jpg|jpeg|png|webp)""", html, re.IGNORECASE)
    if not found and (own := meta(root, "og:image")) and (not car_id or car_id in own):
        found = [own]
    return list(dict.fromkeys(found))


def detail(html: str | None, car_id: str | None = None, ignored: tuple[str, ...] = (), thumbs: str = "/thumbnails/") -> dict:
    root = parse(html)
    intro, more = intro_and_detail(root, ignored)
    name = lambda tag: (n.text("") or None) if (n := root.first(tag)) else None
    return {"name": name("h1"), "manufacturer_name": name("h2"), "intro": intro or meta(root, "og:description"), "detail": more, "specs": specifications(root), "hero_images": hero_images(root, html or "", car_id, thumbs)}


def with_details(pages: DataFrame, html: str = "html", car_id: str = "car_id", ignored: tuple[str, ...] = ()) -> DataFrame:
    """pages with a struct column detail; pages are parsed in Arrow batches.

    Rows are dealt to all cores first: parsing takes a thousand times longer than reading, and a file of some MB is read by one task.
    """

    @F.pandas_udf(DETAIL)
    def parsed(h: pd.Series, c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([detail(x, y or None, ignored) for x, y in zip(h, c, strict=True)], columns=["name", "manufacturer_name", "intro", "detail", "specs", "hero_images"])

    dealt = pages.repartition(4 * pages.sparkSession.sparkContext.defaultParallelism)
    return dealt.withColumn("detail", parsed(F.col(html), F.col(car_id).cast("string")))


def thumbnails(html: str | None) -> list[tuple[str, str]]:
    """(car id, address), each once, of a list page: thumbnail images, then images or backgrounds at links to a car."""
    root, out = parse(html), []
    for n in root.all("img"):
        src = n.attrs.get("src", "")
        if "thumbnails/" in src and (m := re.search(r"car\d+", src)):
            out.append((m[0], src))
    for a in root.all("a"):
        if m := re.search(r"/id/(car\d+)", a.attrs.get("href", "")):
            img = next((i.attrs["src"] for scope in (a, a.parent) if scope and (i := scope.first("img")) and i.attrs.get("src")), None)
            style = a.attrs.get("style") or (a.parent.attrs.get("style") if a.parent else None) or ""
            if not img and (u := re.search(r"""url\(["']?([^"')]+)""", style)):
                img = u[1]
            if img:
                out.append((m[1], img))
    return list(dict.fromkeys(out))


@F.udtf(returnType=T.StructType([T.StructField("car_id", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("url", T.StringType())]))
class Thumbnails:
    """Rows of a list page's thumbnails."""

    def eval(self, html: str):
        seen: dict[str, int] = {}
        for car, url in thumbnails(html):
            seen[car] = seen.get(car, 0) + 1
            yield car, seen[car], url


def first_script(html: Column, pattern: str) -> Column:
    """The first address in a page that matches a pattern, null if none."""
    return F.nullif(F.regexp_extract(html, f"({pattern})", 1), F.lit(""))


def site_total(html: Column) -> Column:
    """The largest number before the word Car; null if there is none."""
    return F.array_max(F.transform(F.regexp_extract_all(html, F.lit(r"(?i)(\d{1,5})\s*Car"), F.lit(1)), lambda x: x.cast("int")))


def hero_modules(script: Column, car_id: str) -> Column:
    """Names of the modules that an index script loads for a car's images, each once."""
    return F.array_distinct(F.regexp_extract_all(script, F.lit(rf'(?i){car_id}_[0-9]+_[0-9]+\.(?:jpg|jpeg|png|webp)"\s*:\s*\(\)\s*=>\s*e\(\(\)\s*=>\s*import\("\./([^"]+\.js)"\)'), F.lit(1)))


def hero_urls(script: Column, car_id: str) -> Column:
    """Image addresses of a module script, the first of each car_N_N."""
    urls = F.regexp_extract_all(script, F.lit(rf"""(?i)(/[^"'\s]*/{car_id}_[0-9]+_[0-9]+-[^"']+?\.(?:jpg|jpeg|png|webp))"""), F.lit(1))
    keys = F.transform(urls, lambda u: F.lower(F.regexp_extract(u, rf"(?i)({car_id}_[0-9]+_[0-9]+)", 1)))
    return F.transform(F.array_distinct(keys), lambda k: F.element_at(urls, F.array_position(keys, k).cast("int")))
