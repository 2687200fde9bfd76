"""HTML extraction over a table of raw pages.

Links, titles and article bodies need element structure (quoting styles,
upper case, tags inside anchors, elements over many lines), so they run a
small ``html.parser`` helper per Arrow batch in ``mapInPandas``."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the crawler: ordered content selectors (first hit wins)
# and ordered date selectors.
CONTENT_SELECTORS = ["div.article-content", "div#artibody", "div.article", "div.content", "div#content",
                     "div.text"]
DATE_SELECTORS = ["span.date", "span.time", "div.date", "time", "span.pub_time"]


# The same for titles.
TITLE_SELECTORS = ["h1", "title"]


class _Anchors(HTMLParser):
    """(href, text) of every anchor in document order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.href, self.parts = [], None, []

    def _close(self):
        if self.href is not None:
            self.found.append((self.href, "".join(self.parts).strip()))
        self.href, self.parts = None, []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close()           # anchors do not nest
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag == "a":
            self._close()

    def handle_data(self, data):
        if self.href is not None:
            self.parts.append(data)

    def close(self):
        super().close()
        self._close()


def page_links(html: str | None, base: str | None) -> list[tuple[int, str, str]]:
    """(position among the anchors, text, absolute link) of the anchors with
    text that lead to an http(s) address."""
    p = _Anchors()
    p.feed(html or "")
    p.close()
    out = []
    for pos, (href, text) in enumerate(p.found):
        href = href.strip()
        if not text or not href or href.startswith("#"):
            continue
        try:
            link = urljoin(base or "", href)
        except ValueError:          # no valid address
            continue
        if link.startswith(("http://", "https://")):
            out.append((pos, text, link))
    return out


def links(pages: DataFrame) -> DataFrame:
    """Every anchor with text and an absolute http(s) link after
    resolution; one row per (page, anchor position)."""
    find, split = page_links, urlsplit

    def run(it):
        for pdf in it:
            rows = [(i, pos, text, link, split(url).hostname if url else None)
                    for i, url, h in zip(pdf["page_id"], pdf["url"], pdf["html"]) for pos, text, link in find(h, url)]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "title", "link", "source"])
    return pages.select("page_id", "url", "html").mapInPandas(
        run, "page_id long, pos int, title string, link string, source string")


def titles(pages: DataFrame, selectors=None) -> DataFrame:
    """Text of the first of the ordered selectors that has any."""
    chosen, first = list(selectors or TITLE_SELECTORS), first_match

    def run(it):
        for pdf in it:
            yield pd.DataFrame({"page_id": pdf["page_id"], "title": [first(h, chosen, "") for h in pdf["html"]]})
    return pages.select("page_id", "html").mapInPandas(run, "page_id long, title string")


class _Extractor(HTMLParser):
    """Collects the text of the first element matching each selector
    (tag[.class|#id]); script / style / img content is skipped."""

    SKIP = {"script", "style", "img"}
    VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}

    def __init__(self, selectors, joiner="\n"):
        super().__init__(convert_charrefs=True)
        self.joiner = joiner
        self.selectors = [self._parse(s) for s in selectors]
        self.found = {}
        self.stack = []        # (tag, [selector indexes opened here])
        self.open = {}         # selector index -> list of text pieces
        self.skip = 0

    @staticmethod
    def _parse(sel):
        if "#" in sel:
            t, i = sel.split("#", 1)
            return t or None, None, i
        if "." in sel:
            t, c = sel.split(".", 1)
            return t or None, c, None
        return sel, None, None

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        opened = []
        for i, (t, c, id_) in enumerate(self.selectors):
            if i in self.found or i in self.open:
                continue
            if (t is None or t == tag) and (c is None or c in classes) and (id_ is None or a.get("id") == id_):
                self.open[i] = []
                opened.append(i)
        self.stack.append((tag, opened))
        if tag in self.SKIP:
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in self.VOID:
            return
        while self.stack:
            t, opened = self.stack.pop()
            if t in self.SKIP:
                self.skip -= 1
            for i in opened:
                self._done(i)
            if t == tag:
                break

    def _done(self, i):
        parts = self.open.pop(i)
        if self.joiner:
            self.found[i] = self.joiner.join(p.strip() for p in parts if p.strip())
        else:
            self.found[i] = "".join(parts).strip()

    def close(self):
        super().close()
        for i in list(self.open):   # elements that the page leaves open
            self._done(i)

    def handle_data(self, data):
        if self.skip:
            return
        for pieces in self.open.values():
            pieces.append(data)


def first_match(html: str | None, selectors, joiner: str = "\n") -> str | None:
    """Text of the first selector whose first element has any; its pieces
    joined by ``joiner`` (as they stand if empty)."""
    p = _Extractor(selectors, joiner)
    p.feed(html or "")
    p.close()
    return next((p.found[i] for i in range(len(selectors)) if p.found.get(i)), None)


def articles(pages: DataFrame, content_selectors=None, date_selectors=None) -> DataFrame:
    """Article body (first matching container of the ordered selector
    list, ``article`` as the last resort) and publish date per page."""
    cs = list(content_selectors or CONTENT_SELECTORS) + ["article"]
    ds = list(date_selectors or DATE_SELECTORS)
    first = first_match

    def run(it):
        for pdf in it:
            yield pd.DataFrame({"page_id": pdf["page_id"],
                                "content": [first(h, cs) for h in pdf["html"]],
                                "publish_time": [first(h, ds) for h in pdf["html"]]})
    return pages.select("page_id", "html").mapInPandas(run, "page_id long, content string, publish_time string")
