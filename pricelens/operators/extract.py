"""Page table to raw page fields: one Arrow pass over the HTML.

The Python part only finds the elements a site's selectors name and hands over
their text nodes and position; which one counts and what it means is decided in
Catalyst afterwards. Pages are independent, so there is no shuffle.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

# Executors need no installed copy of this module: its code travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ``parts``: the stripped, non-empty text nodes; ``text``: all text as it stands.
NODE = "field string, start int, end int, parts array<string>, text string, href string"

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}
_SILENT = {"script", "style", "template"}


def _step(selector: str) -> tuple:
    """One compound selector: tag, id, classes, attributes."""
    attributes = dict(re.findall(r"\[([\w-]+)=([\w-]+)\]", selector))
    plain = re.sub(r"\[[^\]]*\]", "", selector)
    tag = re.match(r"[\w-]*", plain).group()
    ids = re.findall(r"#([\w-]+)", plain)
    return tag, ids[0] if ids else None, set(re.findall(r"\.([\w-]+)", plain)), attributes


def _fits(element: dict, step: tuple) -> bool:
    tag, ident, classes, attributes = step
    return (
        (not tag or element["tag"] == tag)
        and (ident is None or element["attrs"].get("id") == ident)
        and classes <= element["classes"]
        and all(element["attrs"].get(k) == v for k, v in attributes.items())
    )


class _Finder(HTMLParser):
    """Collects the elements that match any selector, with their text nodes."""

    def __init__(self, fields: dict[str, str], base_url: str):
        super().__init__(convert_charrefs=True)
        self.rules = [(name, [_step(s) for s in path.split()]) for name, path in fields.items()]
        self.base_url = base_url
        self.open: list[dict] = []
        self.found: list[dict] = []
        self.count = 0
        self.text: list[str] = []

    def _flush(self) -> None:
        if self.text:
            node, self.text = "".join(self.text), []
            for element in self.open:
                for match in element["matches"]:
                    match["text"].append(node)

    def _matches(self, element: dict, steps: list[tuple]) -> bool:
        if not _fits(element, steps[-1]):
            return False
        wanted = len(steps) - 2
        for ancestor in reversed(self.open):
            if wanted < 0:
                break
            if _fits(ancestor, steps[wanted]):
                wanted -= 1
        return wanted < 0

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.count += 1
        attrs = {k: v or "" for k, v in attrs}
        element = {
            "tag": tag, "attrs": attrs, "classes": set(attrs.get("class", "").split()),
            "matches": [],
        }
        href = attrs.get("href")
        for name, steps in self.rules:
            if self._matches(element, steps):
                element["matches"].append({
                    "field": name, "start": self.count, "end": None, "text": [],
                    "href": None if href is None else urljoin(self.base_url, href),
                })
        self.found.extend(element["matches"])
        if tag in _VOID:
            self._close(element)
        else:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close(self.open.pop())

    def handle_endtag(self, tag):
        self._flush()
        if any(element["tag"] == tag for element in self.open):
            while True:
                element = self.open.pop()
                self._close(element)
                if element["tag"] == tag:
                    break

    def handle_data(self, data):
        if not (self.open and self.open[-1]["tag"] in _SILENT):
            self.text.append(data)

    def handle_comment(self, data):
        self._flush()

    def _close(self, element: dict) -> None:
        for match in element["matches"]:
            stripped = (node.strip() for node in match["text"])
            match["parts"] = [node for node in stripped if node]
            match["text"] = "".join(match["text"])
            match["end"] = self.count

    def finish(self) -> list[dict]:
        self.close()
        self._flush()
        while self.open:
            self._close(self.open.pop())
        return self.found


def raw_fields(
    pages: DataFrame,
    fields: dict[str, dict[str, str]],
    site: str = "site",
    html: str = "html",
    url: str = "url",
) -> DataFrame:
    """Replace ``html`` by ``nodes`` (matched elements in document order) and ``error``.

    ``fields`` maps a site to its selectors; key ``"*"`` serves every other
    site. A page that cannot be parsed yields a row with ``error`` set and no
    nodes, so one bad page never fails the job. Columns other than ``html`` are
    passed through; select only those you need. ``pages`` is parsed where it is.
    """
    kept = [c for c in pages.columns if c != html]
    schema = T.StructType(
        [f for f in pages.schema if f.name != html]
        + [
            T.StructField("nodes", T.ArrayType(T.StructType.fromDDL(NODE))),
            T.StructField("error", T.StringType()),
        ]
    )

    def parse(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        node_type = target.field("nodes").type
        for batch in batches:
            names = batch.column(batch.schema.get_field_index(site)).to_pylist()
            bases = batch.column(batch.schema.get_field_index(url)).to_pylist()
            nodes, errors = [], []
            sources = batch.column(batch.schema.get_field_index(html))
            for name, base, source in zip(names, bases, sources):
                try:
                    finder = _Finder(fields.get(name, fields.get("*", {})), base or "")
                    finder.feed(source.as_py() or "")
                    nodes.append(finder.finish())
                    errors.append(None)
                except Exception as problem:
                    nodes.append([])
                    errors.append(f"{type(problem).__name__}: {problem}")
            passed = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            arrays = passed + [pa.array(nodes, node_type), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, target)], schema=target
            )

    return pages.select(*kept, html).mapInArrow(parse, schema)


def all_of(nodes: Column, field: str) -> Column:
    return F.filter(nodes, lambda n: n["field"] == field)


def first_of(nodes: Column, field: str) -> Column:
    """First matched element of a field, NULL when the page has none."""
    return F.get(all_of(nodes, field), F.lit(0))


def within(nodes: Column, outer: Column) -> Column:
    """Matched elements that lie inside (or are) ``outer``."""
    return F.filter(nodes, lambda n: n["start"].between(outer["start"], outer["end"]))


def listing_links(raw: DataFrame) -> DataFrame:
    """One row per usable hit of a result page, ``rank`` in page order.

    Cards without link or address, sponsored links and links without text on
    the site that leaves empty cards are skipped.
    """
    cards = F.transform(
        all_of(F.col("nodes"), "card"),
        lambda card: F.get(all_of(within(F.col("nodes"), card), "link"), F.lit(0)),
    )
    text = F.col("link.text")
    return (
        raw.select("*", F.posexplode(cards).alias("rank", "link"))
        .filter(F.col("link.href").isNotNull())
        .filter(~((F.col("site") == "amazon") & F.contains(F.col("link.href"), F.lit("spons"))))
        .filter((F.col("site") != "saco") | (F.trim(text) != ""))
        .withColumns({"product_url": F.col("link.href"), "link_text": F.trim(text)})
        .drop("nodes", "link", "error")
    )
