"""Main text of HTML pages from streaming parser events.

The standard library's parser gives tags and text in page order. Text is gathered into lines, one for each block. What the
result leaves out by name (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) is known by
element, role, or a word of class or id, and is no line's text. Each other line has a ratio of text to tags: the logarithm
of its characters outside links for each tag since the line before; named boilerplate counts as lines of ratio zero. The ratios
are smoothed by a Gaussian along the page, and lines at or above the threshold form clusters. A region is the outermost
``article`` or ``main``, or else the innermost ``div``, ``section`` or table cell; every region with a clustered line is content. Of
such a region all lines are kept, in page order, short ones too; but outside ``article`` and ``main``, lines of links alone are kept
only if they are in a cluster. The threshold is ``PROSE``, or ``SHARE`` of the page's highest smoothed ratio if that is less, so that
short pages are judged by their own text.

Null pages are empty; pages without markup are one line; pages without content give an empty string. Repeated rows keep their
own result rows, an empty table gives an empty result, extra columns, whatever their names, are ignored. Very long pages are parsed as
a whole, in one pass.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul head".split())
#: Elements that the result leaves out.
OUT_TAGS = frozenset("head script style noscript template nav aside footer form menu dialog button select textarea iframe object embed svg canvas audio video map datalist label input".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id for the same.
ADVERTS = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo cookie cookies consent gdpr notice notices alert alerts banner popup modal newsletter subscribe".split())
OUT_WORDS = ADVERTS | frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside comment comments commentlist disqus respond".split())
CONTAINERS = ("article", "main")
REGIONS = frozenset("body div section td th center details fieldset".split())
OUT, ADVERT = 1, 2
SIGMA, PROSE, SHARE = 1.0, 3.0, 0.6
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Lines(HTMLParser):
    """Lines of a page: text, ratio, region (negative for ``article`` and ``main``), whether there is text outside links. Text is null
    for boilerplate."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str | None, float, int, bool]] = []
        self.open: list[tuple[str, int, int]] = []  # tag, boilerplate, region
        self.parts: list[str] = []
        self.noise = False
        self.links = 0
        self.linked = 0
        self.tags = 0
        self.regions = 0

    @property
    def state(self) -> tuple[int, int]:
        return self.open[-1][1:] if self.open else (0, 0)

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip() if self.parts else ""
        if text:
            plain = max(0, len(text) - self.linked)
            self.lines.append((text, np.log2(1 + plain / max(1, self.tags)), self.state[1], plain > 0))
        elif self.noise:
            self.lines.append((None, 0.0, 0, False))
        if text or self.noise:
            self.tags = 0
        self.parts.clear()
        self.noise, self.linked = False, 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS or tag in OUT_TAGS and tag not in ("input", "label", "button"):
            self.flush()
        elif tag == "br" and not self.state[0]:
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            self.closed(tag)
        out, region = self.state
        if tag in CONTAINERS:
            if out == ADVERT and not any(r < 0 for _, _, r, _ in self.lines) and region >= 0:  # an advert that never ends
                out = 0
            if region >= 0:
                self.regions += 1
                region = -self.regions
        elif tag in REGIONS and region >= 0:
            self.regions += 1
            region = self.regions
        self.links += tag == "a"
        self.open.append((tag, out or self.unwanted(tag, attrs, region < 0), region))

    def closed(self, tag: str) -> None:
        """Elements whose end tag may be left out end at the next of their kind, within the same parent."""
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                self.end(k)
                return
            if name in BLOCKS and name != "p" or name in OUT_TAGS:
                return

    def end(self, k: int) -> None:
        self.links -= sum(t == "a" for t, *_ in self.open[k:])
        del self.open[k:]

    def unwanted(self, tag: str, attrs, inside: bool) -> int:
        """0: content, or else ``OUT``; ``ADVERT`` for adverts and notices."""
        if tag in OUT_TAGS:
            return OUT
        if tag == "header":
            return 0 if inside else OUT  # an article's own header holds its title
        if tag in ("html", "body", "main"):
            return 0
        for k, v in attrs:
            if k == "hidden" or k == "aria-hidden" and v == "true" or v and k == "role" and v.lower() in OUT_ROLES:
                return OUT
            if v and k in ("class", "id"):
                names = [v.lower()] if tag == "article" else [w.lower() for w in _NAME.findall(v)]
                if words := OUT_WORDS.intersection(names):
                    return ADVERT if words & ADVERTS else OUT
                if "header" in names and not inside:
                    return OUT
        return 0

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        elif tag == "br" and not self.state[0]:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if tag in OUT_TAGS:
                    self.flush()
                self.end(k)
                return

    def handle_data(self, data):
        if not self.state[0]:
            self.parts.append(data)
            if self.links:
                self.linked += len(_SPACE.sub(" ", data).strip())
        elif not self.noise and data.strip():
            self.noise = True

    def close(self):
        super().close()
        self.flush()


def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """``x`` under a Gaussian of ``sigma`` lines; as it is for zero."""
    if not sigma or not len(x):
        return x
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def extracted(html: str | None, sigma: float = SIGMA, prose: float = PROSE, share: float = SHARE) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    if not page.lines:
        return ""
    smooth = smoothed(np.array([x[1] for x in page.lines]), sigma)
    least = min(prose, share * smooth.max(initial=0.0, where=np.array([x[0] is not None for x in page.lines])))
    inside = [x[0] is not None and s >= least and s > 0 for x, s in zip(page.lines, smooth.tolist(), strict=True)]
    content = {x[2] for x, c in zip(page.lines, inside, strict=True) if c}
    return "\n".join(t for (t, _, region, plain), c in zip(page.lines, inside, strict=True) if t is not None and region in content and (c or plain or region < 0))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each page."""

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return html.map(extracted, na_action=None)

    out = pages.select("page_id", "url", run(F.coalesce(F.col("html"), F.lit(""))).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
