"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser turns a page into *lines*, one per block of text,
with the number of tags met in it and the elements it stands in. Elements that never hold
article text (menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) are left out by tag, role, class or id. Of the other lines the
ratio of letters to tags is smoothed by a Gaussian along the page, and lines above the
standard deviation cluster as content, the highest line at least. The innermost element
that holds all of them, or the ``article`` or ``main`` around it, is the article; its lines
are the result, short ones too. Where no ``article`` or ``main`` says where it begins and ends,
lines at either end of it are left out that are a copyright line, or no heading, half of links
and below the threshold by their own ratio (menus without a name), unless there is nothing else.

A class or id token names its element by its last part that is no size, number or part of a
page (``PARTS``): ``user-comments``, ``ad-300x250``, ``leftSidebar`` and ``comments-section``
are what ``NAMES`` lists, ``social-science`` is not. Tokens with a part in ``MODIFIERS``
(``has-sidebar``, ``page-with-menu``) say something about what is around, those that begin with
one in ``SUBJECTS`` (``category-advertising``) what the text is about. Page-header names do not
count within ``article`` and ``main``.

Extraction is local to a row: one pass, no shuffle. Unclosed and stray tags are taken as
browsers take them: a new block ends an open paragraph, an end tag closes what it can.

A null or empty page has the empty text, as has a page with nothing but what is named above. Pages of any length are read whole; repeated rows give repeated results;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0
RADIUS = 2

# Names of HTML and customary class names (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog fieldset footer form head iframe math menu nav noscript"
    " object option script select style svg template textarea title".split()
)
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar"
    " navigation newsletter notice notification overlay pagination pager popup promo promoted related"
    " replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar"
    " widget".split()
)
#: What may follow a name in a compound: it is then still that kind of element.
PARTS = frozenset(
    "area bar block box button buttons container content feed form inner item items link links list main"
    " message page panel post posts primary secondary section site slot text top bottom left right"
    " thread title unit wrap wrapper".split()
)
#: Compounds with one of these tell of a page's parts, not that the element is one.
MODIFIERS = frozenset("has no non not with without is hide show free".split())
#: Compounds that begin so tell what the text is about.
SUBJECTS = frozenset("category tag topic format type status".split())
#: Names of comments and adverts: an article within them is none.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising comment comments commentlist disqus replies".split()
)
#: Names that an article's own head may bear.
HEADS = frozenset(("header", "masthead", "banner"))
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
    " toolbar".split()
)
ARTICLE = frozenset(("article", "main"))
#: What an article within them does not bring back.
NEVER = frozenset(("script", "style", "template", "noscript", "head", "form", "nav", "footer", "aside"))
#: Tags that end an open element of the same kind within the same parent.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

TEXT, LINKS, COPYRIGHT = range(3)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_PARTS = re.compile(r"[a-z]+|\d+x\d+|\d+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z][a-z])")
_COPYRIGHT = re.compile(r"©|(\(c\)|copyright)\s*(©|\(c\)|\d{4})", re.IGNORECASE)


@lru_cache(4096)
def _names(value: str) -> frozenset[str]:
    """The names in ``NAMES`` that a class or id gives its element."""
    found = set()
    for token in value.split():
        parts = _PARTS.findall(_HUMP.sub("-", token).lower())
        if not parts or parts[0] in SUBJECTS or not MODIFIERS.isdisjoint(parts):
            continue
        while len(parts) > 1 and (parts[-1] in PARTS or parts[-1][0].isdigit()):
            parts.pop()
        if parts[-1] in NAMES:
            found.add(parts[-1])
    return frozenset(found)


class Lines(HTMLParser):
    """Lines of a page: text, number of tags, and the elements around, outermost first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, element number, left out
        self.elements = 1
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        #: What each line would be at an end of the text.
        self.edges: list[int] = []
        self.text: list[str] = []
        self.tags = 0
        self.linked = 0
        #: Elements left out by name; true for those of comments and adverts.
        self.named: dict[int, bool] = {}
        #: Elements that are an article or main part.
        self.regions: set[int] = set()

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text and not self.open[-1][2]:
                self.lines.append((text, self.tags + 1, tuple(e for _, e, _ in self.open)))
                letters = sum(len("".join(part.split())) for part in self.text)
                head = any(tag in HEADINGS for tag, _, _ in self.open)
                self.edges.append(
                    COPYRIGHT if _COPYRIGHT.match(text) else LINKS if 2 * self.linked >= letters and not head else TEXT
                )
            self.text = []
        self.tags = 0
        self.linked = 0

    def _pop_to(self, index: int) -> None:
        if any(tag in BLOCKS for tag, _, _ in self.open[index:]) or any(
            left_out != self.open[index - 1][2] for _, _, left_out in self.open[index:]
        ):
            self._flush()
        del self.open[index:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
            for i in range(len(self.open) - 1, 0, -1):
                name = self.open[i][0]
                if name == "p" or name in SIBLINGS.get(tag, ()):
                    self._pop_to(i)
                    break
                if name in BLOCKS:
                    break
        elif tag == "br":
            self.text.append("\n")
        if tag in VOID:
            return
        left_out = self.open[-1][2]
        named = foreign = False
        if tag not in ("html", "body"):
            heads = not any(t in ARTICLE for t, _, _ in self.open)
            for key, value in attrs:
                if value and key in ("class", "id") and (names := _names(value)):
                    named = named or heads or not HEADS.issuperset(names)
                    foreign = foreign or not FOREIGN.isdisjoint(names)
                elif value and key == "role" and value.lower() in ROLES:
                    named = True
                elif key in ("hidden", "aria-hidden") and value in (None, "", "hidden", "true"):
                    named = True
        if tag in ARTICLE and not named and not any(t in NEVER or n for t, n in self._around()):
            left_out = False
        elif named or tag in LEFT_OUT or tag == "header" and not any(t in ARTICLE for t, _, _ in self.open):
            left_out = True
        if left_out != self.open[-1][2]:
            self._flush()
        self.open.append((tag, self.elements, left_out))
        self.elements += 1
        if tag in ARTICLE:
            self.regions.add(self.elements - 1)
        if named:
            self.named[self.elements - 1] = foreign

    def _around(self):
        """Tags around, and whether they are named as comments or adverts."""
        return [(tag, self.named.get(element, False)) for tag, element, _ in self.open]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1][0] == tag and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self._pop_to(i)
                return
            # A stray end tag within a table cell or the like does not close what is around it.
            if self.open[i][0] in ("td", "th", "article", "main", "body") and tag not in BLOCKS:
                return

    def handle_data(self, data):
        self.text.append(data)
        if any(tag == "a" for tag, _, _ in self.open):
            self.linked += len("".join(data.split()))

    def close(self):
        super().close()
        self._flush()


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean along the page, over the lines that exist."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    pad = np.pad(values, RADIUS)
    weight = np.pad(np.ones(len(values)), RADIUS)
    return np.convolve(pad, kernel, "valid") / np.convolve(weight, kernel, "valid")


def article(
    lines: list[tuple[str, int, tuple[int, ...]]], regions: set[int] = frozenset(), edges: list[int] = ()
) -> list[str]:
    """The lines of the innermost element that holds the whole content cluster, or of the region around it.

    ``edges`` tells what each line would be at an end of the text.
    """
    ratios = np.array([len(text) / tags for text, tags, _ in lines])
    smooth = _smoothed(ratios)
    threshold = min(smooth.std(), smooth.max())
    shared = None
    for (_, _, around), taken in zip(lines, smooth >= threshold):
        if taken:
            shared = around if shared is None else tuple(a for a, b in zip(shared, around) if a == b)
    # A paragraph alone is not an article: its parent is.
    members: dict[int, int] = {}
    for _, _, around in lines:
        for element in around:
            members[element] = members.get(element, 0) + 1
    whole = [e for e in shared if members[e] > 1] or shared[:1]
    region = next((e for e in whole if e in regions), None)
    best = whole[-1] if region is None else region
    inside = [i for i, (_, _, around) in enumerate(lines) if best in around]
    if region is None and edges:
        kept = [i for i in inside if edges[i] == TEXT or edges[i] == LINKS and ratios[i] >= threshold]
        if kept:
            inside = [i for i in inside if kept[0] <= i <= kept[-1]]
    return [lines[i][0] for i in inside]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    if not parser.lines:
        return ""
    return "\n".join(article(parser.lines, parser.regions, parser.edges))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def texts(batches):
        for batch in batches:
            found = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    )
