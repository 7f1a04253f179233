"""Fields of HTML pages by element and attribute, with the standard library's parser over Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = re.compile("[ \\t\\n\\r\\f]+")  # HTML's white space; a no-break space is text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Fields(HTMLParser):
    """Texts of wanted elements and values of ``itemprop`` elements, in page order. With ``references`` (name and character), only
    these are decoded, in turn and with their semicolon; by default all that HTML knows are."""

    def __init__(self, wanted: frozenset[str], references: tuple[tuple[str, str], ...] | None = None):
        super().__init__(convert_charrefs=True)
        self.wanted, self.references = wanted, references
        self.texts: list[tuple[str, str]] = []
        self.props: list[tuple[str, str]] = []
        self.open: list[tuple[str, str | None, list[str]]] = []

    def read(self, page: str) -> None:
        """The whole page; elements that nothing closes end with it."""
        self.feed(page if self.references is None else page.replace("&", "&amp;"))  # so that the parser gives back what is written
        self.close()
        while self.open:
            self.done(*self.open.pop())

    def plain(self, text: str) -> str:
        for name, char in self.references or ():
            text = text.replace(f"&{name};", char)
        return text

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        prop = own.get("itemprop")
        if prop and tag == "meta":
            self.props.append((prop, self.plain(own.get("content") or "")))
        elif tag not in VOID and (prop or tag in self.wanted):
            self.open.append((tag, prop, []))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for at in range(len(self.open) - 1, k - 1, -1):
                    self.done(*self.open.pop(at))
                return

    def done(self, tag, prop, parts):
        text = _SPACE.sub(" ", self.plain("".join(parts))).strip(" ")
        if tag in self.wanted:
            self.texts.append((tag, text))
        if prop:
            self.props.append((prop, text))

    def handle_data(self, data):
        if self.references is not None and self.cdata_elem and not getattr(self, "_escapable", False):
            data = data.replace("&amp;", "&")  # scripts and styles are not decoded
        for _, _, parts in self.open:
            parts.append(data)


def html_fields(c: Column, elements: tuple[str, ...] = ("title", "h1", "li"), references: tuple[tuple[str, str], ...] | None = None) -> Column:
    """``struct(texts, props)``: the texts of the elements as ``map<string,array<string>>``, in the order in which they end, and the first
    value of each ``itemprop``. Null pages have no fields. ``references``: see ``Fields``."""
    wanted = frozenset(elements)

    @F.pandas_udf("struct<texts:map<string,array<string>>,props:map<string,string>>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            own = Fields(wanted, references)
            own.read(page)
            texts: dict[str, list[str]] = {}
            for tag, text in own.texts:
                texts.setdefault(tag, []).append(text)
            props: dict[str, str] = {}
            for name, text in own.props:
                props.setdefault(name, text)
            rows.append((texts, props))
        return pd.DataFrame(rows, columns=["texts", "props"])

    return run(F.coalesce(c, F.lit("")))
