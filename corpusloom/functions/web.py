"""Web-page functions: boilerplate removal, block text, links."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from corpusloom.functions import text as X

# Elements and classes that carry no content.
IGNORED_ELEMENTS = ("nav", "footer", "meta", "script", "style", "symbol", "aside")
IGNORED_CLASSES = ("sidebar", "footer", "sticky", "hidden")
IGNORED_ROLES = ("banner", "contentinfo")
VOID_ELEMENTS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
)
BLOCK_ELEMENTS = (
    "h1", "h2", "h3", "h4", "h5", "h6", "p", "div", "article", "section", "aside", "ul", "ol", "li", "table", "pre",
    "code", "blockquote", "figure", "figcaption",
)


class _Cleaner(HTMLParser):
    """Collects the text outside dropped elements, whatever the nesting."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open_dropped: list[str] = []
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID_ELEMENTS:
            self.parts.append(" ")
            return
        given = {k: v or "" for k, v in attrs}
        drop = (
            tag in IGNORED_ELEMENTS + ("title", "header")
            or given.get("role") in IGNORED_ROLES
            or any(c in IGNORED_CLASSES for c in given.get("class", "").split())
        )
        if self.open_dropped:
            if tag == self.open_dropped[0]:
                self.open_dropped.append(tag)
        elif drop:
            self.open_dropped.append(tag)
        self.parts.append(" ")

    def handle_endtag(self, tag):
        if self.open_dropped and tag == self.open_dropped[0]:
            self.open_dropped.pop()
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.open_dropped:
            self.parts.append(data)


def _clean_one(page):
    if page is None:
        return None
    parser = _Cleaner()
    parser.feed(page)
    parser.close()
    return " ".join("".join(parser.parts).replace("\u200b", "").split())


@F.pandas_udf(T.StringType())
def _clean_nested(pages: pd.Series) -> pd.Series:
    return pages.map(_clean_one)


def page_title(c: Column) -> Column:
    return F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)


def drop_elements(c: Column, elements) -> Column:
    """Remove flat elements, tags and content."""
    for name in elements:
        c = F.regexp_replace(c, rf"(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>", " ")
    return c


def drop_comments(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->", " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<[^>]*>", " ")


def flat_clean_text(c: Column) -> Column:
    """Boilerplate removal in the JVM for pages whose dropped elements do not nest."""
    body = drop_elements(drop_comments(c), ("title", "header") + tuple(e for e in IGNORED_ELEMENTS if e != "meta"))
    plain = X.unescape_entities(strip_tags(body))
    plain = F.replace(plain, F.lit("\u200b"), F.lit(""))
    return X.strip(F.regexp_replace(plain, r"[\s\u00a0]+", " "))


def needs_parser(c: Column) -> Column:
    """Pages with ignored classes or roles, or an ignored element inside one of the same name."""
    names = "|".join(e for e in IGNORED_ELEMENTS if e not in ("meta", "script", "style")) + "|header"
    nested = rf"(?is)<({names})(?:\s[^>]*)?>(?:(?!</\1).)*<\1[\s>]"
    marked = rf"""(?is)<[a-z][^>]*\b(?:class=["'][^"']*\b(?:{'|'.join(IGNORED_CLASSES)})\b|role=["'](?:{'|'.join(IGNORED_ROLES)}))"""
    return c.rlike(nested) | c.rlike(marked)


def clean_text(c: Column) -> Column:
    """Page text without boilerplate; only pages that need a real parser take the Python path."""
    hard = needs_parser(c)
    return F.coalesce(_clean_nested(F.when(hard, c)), flat_clean_text(c))


def hyperlinks(c: Column) -> Column:
    """Distinct link targets of a page."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"""(?i)<a\s[^>]*?href=["']([^"']+)["']"""), F.lit(1)))


def image_urls(line: Column) -> Column:
    """Distinct image targets of one line, markdown or HTML."""
    marked = F.regexp_extract_all(line, F.lit(r"!\[[^\]]*\]\(([^)\s]+)"), F.lit(1))
    tagged = F.regexp_extract_all(line, F.lit(r"""(?i)src=["']([^"'>\s]+)"""), F.lit(1))
    return F.array_distinct(F.concat(marked, tagged))


def block_texts(c: Column) -> Column:
    """Ordered texts of the block elements of a page; headings keep a ``#`` prefix, tables are separate."""
    body = drop_comments(drop_elements(c, ("script", "style", "head")))
    body = F.regexp_replace(body, r"(?is)<table(?:\s[^>]*)?>.*?</table\s*>", " ")
    for level in range(1, 7):
        body = F.regexp_replace(body, rf"(?i)<h{level}(?:\s[^>]*)?>", "\u0001" + "#" * level + " ")
    body = F.regexp_replace(body, rf"(?i)</?(?:{'|'.join(BLOCK_ELEMENTS)})(?:\s[^>]*)?/?>", "\u0001")
    texts = F.transform(
        F.split(body, "\u0001"),
        lambda b: X.strip(F.regexp_replace(X.strip(strip_tags(b)), r"[ \t\r\n]+", " ")),
    )
    return F.filter(texts, lambda b: (b != "") & ~b.rlike("^#+$"))


def tables(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(?is)<table(?:\s[^>]*)?>.*?</table\s*>"), F.lit(0))
